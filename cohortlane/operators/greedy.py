"""Sequential greedy choice over one bounded set of cells: the helper run inside matching tasks.

A *cell* holds the free controls that share every matching value, in ``person_id`` order; a *type* is the
matching values of a case. Controls of one cell are interchangeable but for their id, so a cell is always
used up in id order and a pointer is all its state.
"""

from __future__ import annotations

import heapq

import numpy as np


class CellMarket:
    """Cells of one stratum, sorted on their first coordinate (the axis)."""

    def __init__(self, coordinates, supply, truncated, dimensions, calipers, weights=(), floor=1.0):
        order = np.argsort(coordinates[:, 0], kind="stable")
        self.coordinates = coordinates[order]
        self.supply = [supply[i] for i in order]
        self.truncated = [truncated[i] for i in order]
        self.used = [0] * len(order)
        self.dimensions = dimensions
        self.calipers = calipers
        self.weights = weights
        self.floor = floor
        self.axis = self.coordinates[:, 0]
        self.reach = min([width for column, width in calipers if column == 0], default=np.inf)

    def distance(self, gaps):
        """Column by column, so that mirrored gaps give exactly equal distances."""
        if not self.weights:
            return np.abs(gaps[:, 0])
        total = np.zeros(len(gaps))
        for row in self.weights:
            part = np.zeros(len(gaps))
            for column, weight in enumerate(row):
                if weight:
                    part = part + gaps[:, column] * weight
            total = total + part * part
        return np.sqrt(total)

    def preference(self, values, radius):
        """Eligible cells nearer than ``radius`` by increasing distance, as (distance, cells) groups."""
        reach = min(self.reach, radius)
        # The slice is a superset; the exact tests below decide.
        slack = 1e-9 * (1.0 + abs(values[0]))
        lo = np.searchsorted(self.axis, values[0] - reach - slack, "left")
        hi = np.searchsorted(self.axis, values[0] + reach + slack, "right")
        gaps = self.coordinates[lo:hi] - values
        keep = np.ones(hi - lo, dtype=bool)
        for column, width in self.calipers:
            keep &= np.abs(gaps[:, column]) <= width
        distance = self.distance(gaps)
        keep &= distance < radius * self.floor
        cells = np.flatnonzero(keep)
        distance = distance[cells]
        ranked = np.argsort(distance, kind="stable")
        cells, distance = cells[ranked] + lo, distance[ranked]
        bounds = np.flatnonzero(np.diff(distance)) + 1
        return np.split(cells, bounds) if len(cells) else []


class Chooser:
    """Where one type stands in its preference: the nearest distance that still has a free control."""

    def __init__(self, market: CellMarket, values, radius):
        self.market = market
        # Whoever fetched the cells gives an infinite radius where a caliper or the end of the cells leaves none out.
        self.complete = np.isinf(radius)
        self.groups = iter(market.preference(values, np.inf if self.complete else radius))
        self.heads: list = []

    def next(self):
        """A cell index, ``None`` when nothing is left, or ``False`` when more data must be fetched."""
        market = self.market
        while True:
            while self.heads:
                head, cell = self.heads[0]
                used, ids = market.used[cell], market.supply[cell]
                if used < len(ids):
                    if ids[used] == head:
                        return cell
                    heapq.heapreplace(self.heads, (ids[used], cell))
                elif market.truncated[cell]:
                    return False
                else:
                    heapq.heappop(self.heads)
            group = next(self.groups, None)
            if group is None:
                return None if self.complete else False
            for cell in group:
                used, ids = market.used[cell], market.supply[cell]
                if used < len(ids):
                    self.heads.append((ids[used], int(cell)))
                elif market.truncated[cell]:
                    return False
            heapq.heapify(self.heads)


def choose(market: CellMarket, types, radii, agent_types):
    """Serve agents in order. Returns (picks, served): one control id or None per served agent.

    Serving stops before the first agent whose nearest control may not be among the fetched ones, so the
    agents served so far are exactly those of the sequential greedy over all controls.
    """
    choosers: dict = {}
    finished = set()
    picks, cells = [], []
    for kind in agent_types:
        if kind in finished:
            picks.append(None)
            cells.append(-1)
            continue
        chooser = choosers.get(kind)
        if chooser is None:
            chooser = choosers[kind] = Chooser(market, types[kind], radii[kind])
        cell = chooser.next()
        if cell is False:
            break
        if cell is None:
            finished.add(kind)
            picks.append(None)
            cells.append(-1)
            continue
        picks.append(market.supply[cell][market.used[cell]])
        cells.append(cell)
        market.used[cell] += 1
    return picks, cells


def nearest_ids(market: CellMarket, values, count: int) -> list:
    """The ``count`` nearest controls of one type, none of them used up."""
    found: list = []
    for group in market.preference(values, np.inf):
        found += sorted(i for cell in group for i in market.supply[cell][:count])[: count - len(found)]
        if len(found) == count:
            break
    return found
