"""Matching controls to cases: exact strata, calipers, nearest distance, propensity, ratio, replacement.

Definitions used here, where the literature leaves a choice:

* cases are served in ``person_id`` order (as text), all first controls before any second one;
* equal distances are broken by the control's ``person_id``;
* with several distance columns the metric is Mahalanobis with the covariance pooled within roles, and
  factors enter as indicators of all but their first level;
* the propensity distance is the difference in the logit, its caliper a multiple of the pooled standard
  deviation ``sqrt((s1^2 + s0^2) / 2)`` of the logit.

How it scales: people with equal matching values are interchangeable but for their id, so the state of the
sequential greedy is one pointer per *cell* of equal values, not one flag per control. Strata do not
interact. A stratum that is small enough is one task; a large one is served in bounded chunks of its
priority order, each chunk seeing only its own cases and the next free controls of the cells it can reach.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..config import MatchSpec
from ..errors import DataContractError
from ..functions.scalars import is_missing, number_of
from ..session import all_true, any_true, broadcast_if_small, cut, numbered
from .estimation import fit_logistic, row_patterns, standardised
from .greedy import CellMarket, choose, nearest_ids

EDGES = "stratum string, case_id string, slot int, control_id string"
#: Coordinates of the grid that finds near cells: a block is a box and those around it, 27 with three axes.
GRID_AXES = 3


@dataclass(frozen=True)
class MatchLimits:
    """What one task may hold. Beyond these a stratum is served in chunks."""

    stratum_rows: int = 200_000
    stratum_pairs: int = 20_000_000
    #: Agents of a stratum's first round; rounds that go well take four times as many, up to ``chunk_most``.
    chunk: int = 200_000
    chunk_most: int = 200_000
    #: Cells that a block of the grid holds if they are spread evenly.
    window: int = 32


@dataclass
class MatchResult:
    pool: DataFrame
    members: DataFrame
    unmatched: DataFrame
    spec: MatchSpec
    summary: DataFrame = None
    ratios: DataFrame = None
    balance: DataFrame = None


@dataclass(frozen=True)
class Geometry:
    """Coordinates of the matching space: first the distance space, then further calipered columns."""

    coordinates: Column
    dimensions: int
    calipers: tuple
    axis_reach: float
    #: Rows of the whitening matrix; without it the distance is the difference in the first coordinate.
    weights: tuple = ()
    facts: dict = field(default_factory=dict)

    @property
    def floor(self) -> float:
        """Distance per unit of the first coordinate at least; a hair less than exact, for rounding."""
        return self.weights[0][0] * (1 - 1e-12) if self.weights else 1.0


# --- the pool -------------------------------------------------------------------------------------------


def match_pool(people: DataFrame, spec: MatchSpec) -> DataFrame:
    """Cases and controls with numeric matching columns made finite, and whether each row can be matched."""
    missing = set(spec.columns()) - set(people.columns)
    if missing:
        raise DataContractError(f"Matching columns are missing: {sorted(missing)}")
    frame = people
    for name in spec.numeric_columns():
        if not isinstance(people.schema[name].dataType, T.IntegralType):
            frame = frame.withColumn(name, number_of(people, name))
    complete = all_true([~is_missing(frame, name) for name in spec.columns()])
    return frame.withColumn("valid", complete)


def with_stratum(frame: DataFrame, spec: MatchSpec) -> DataFrame:
    parts = []
    for name in spec.exact:
        value = F.col(name)
        if isinstance(frame.schema[name].dataType, T.FractionalType):
            value = value + F.lit(0.0)
        parts.append(value.cast("string"))
    key = F.to_json(F.array(*parts)) if parts else F.lit("[]")
    return frame.withColumn("stratum", key)


def factor_levels(frame: DataFrame, names: list[str]) -> dict[str, list]:
    """Sorted levels of each factor: as many columns of the distance, so they belong on the driver."""
    if not names:
        return {}
    entries = F.array(*[
        F.struct(F.lit(n).alias("name"), F.col(n).cast("string").alias("level")) for n in names
    ])
    found = frame.select(F.inline(entries)).filter("level is not null").distinct().collect()
    return {n: sorted(r["level"] for r in found if r["name"] == n) for n in names}


def distance_columns(pool: DataFrame, spec: MatchSpec) -> list[Column]:
    """Numeric distance columns, calipered ones first, then factor indicators without the first level."""
    factors = [n for n in spec.distance if n in (*spec.exact, *spec.categorical)]
    numeric = [n for n in spec.distance if n not in factors]
    numeric.sort(key=lambda n: n not in spec.calipers)
    columns = [F.col(n).cast("double") for n in numeric]
    levels = factor_levels(pool, factors)
    for name in factors:
        columns += [(F.col(name).cast("string") == level).cast("double") for level in levels[name][1:]]
    return columns


def pooled_covariance(pool: DataFrame, columns: list[Column]) -> np.ndarray:
    """Within-role covariance pooled over roles.

    Values are taken from a centre near the mean and kept where they are not zero; products are summed per pair
    of columns. With many indicators a row has few entries, and the plan does not grow with the pairs.
    """
    p = len(columns)
    values = pool.select("is_case", F.array(*columns).alias("x"))
    means = {r["i"]: r["m"] for r in values.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m")).collect()}
    # Indicators stay as they are, so that their zeros drop out.
    centre = [0.0 if 0.0 <= means.get(i, 0.0) <= 1.0 else float(means[i]) for i in range(p)]
    shifted = F.zip_with("x", F.lit(centre), lambda v, c: v - c)
    entries = F.filter(F.transform(shifted, lambda v, i: F.struct(i.alias("i"), v.alias("v"))), lambda e: e["v"] != 0)
    sparse = values.select("is_case", entries.alias("e"))
    ones = F.array(F.struct(F.lit(p).alias("i"), F.lit(1.0).alias("v")))  # column p: the count and the sums
    left = sparse.select("is_case", F.concat("e", ones).alias("e"), F.explode(F.concat("e", ones)).alias("a"))
    pairs = left.select("is_case", "a", F.explode("e").alias("b")).filter("a.i <= b.i")
    sums = pairs.groupBy("is_case", F.col("a.i").alias("i"), F.col("b.i").alias("j")).agg(F.sum(F.col("a.v") * F.col("b.v")).alias("s"))
    raw: dict = {}
    for r in sums.collect():
        matrix = raw.setdefault(r["is_case"], np.zeros((p + 1, p + 1)))
        matrix[r["i"], r["j"]] = matrix[r["j"], r["i"]] = r["s"]
    total, weight = np.zeros((p, p)), 0.0
    for _, matrix in sorted(raw.items()):
        n = matrix[p, p]
        if n >= 2:
            total += matrix[:p, :p] - np.outer(matrix[:p, p], matrix[:p, p]) / n
            weight += n - 1
    return total / max(weight, 1)


def whitening(covariance: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Columns that add a direction, and lower triangular W with W S W' = I over them."""
    p = len(covariance)
    lower = np.zeros((p, p))
    kept = []
    for i in range(p):
        residual = covariance[i, i] - lower[i, :i] @ lower[i, :i]
        if residual > 1e-10 * max(covariance[i, i], 1e-300):
            lower[i, i] = np.sqrt(residual)
            for j in range(i + 1, p):
                lower[j, i] = (covariance[j, i] - lower[j, :i] @ lower[i, :i]) / lower[i, i]
            kept.append(i)
    if not kept:
        return [0], np.ones((1, 1))
    inverse = np.linalg.inv(lower[np.ix_(kept, kept)])
    # Rounded, so that partial sums added up in another order give the same distances.
    scale = 10.0 ** (11 - np.floor(np.log10(np.abs(inverse).max())))
    return kept, np.round(inverse * scale) / scale


def linear(columns: list[Column], weights: np.ndarray) -> Column:
    total = F.lit(0.0)
    for column, weight in zip(columns, weights):
        if weight:
            total = total + column * F.lit(float(weight))
    return total


def geometry(pool: DataFrame, spec: MatchSpec) -> Geometry:
    """The matching space over the valid pool, with calipers as (coordinate, width)."""
    columns = distance_columns(pool, spec)
    raw = dict(spec.calipers)
    if spec.method == "propensity":
        space, width, facts = propensity(pool, columns, spec)
        calipers, reach, dimensions = [(0, width)], width, 1
        further = list(raw)
        return Geometry(
            F.array(space, *[F.col(n).cast("double") for n in further]),
            dimensions,
            tuple(calipers + [(1 + i, raw[n]) for i, n in enumerate(further)]),
            reach,
            facts=facts,
        )
    numeric = [n for n in spec.distance if n not in (*spec.exact, *spec.categorical)]
    if len(columns) == 1 and numeric:
        name = numeric[0]
        further = [n for n in raw if n != name]
        own = [(0, raw[name])] if name in raw else []
        return Geometry(
            F.array(columns[0], *[F.col(n).cast("double") for n in further]),
            1,
            tuple(own + [(1 + i, raw[n]) for i, n in enumerate(further)]),
            raw.get(name, np.inf),
        )
    # Without columns (factors of a single level) every distance is zero.
    columns = columns or [F.lit(0.0)]
    kept, weights = whitening(pooled_covariance(pool, columns))
    space = [columns[i] for i in kept]
    # Calipered numeric columns come first among the columns.
    first = sorted(numeric, key=lambda n: n not in raw)[0] if numeric and kept[0] == 0 else None
    further = [n for n in raw if n != first]
    own = [(0, raw[first])] if first in raw else []
    return Geometry(
        F.array(*space, *[F.col(n).cast("double") for n in further]),
        len(space),
        tuple(own + [(len(space) + i, raw[n]) for i, n in enumerate(further)]),
        raw.get(first, np.inf),
        tuple(tuple(float(w) for w in row) for row in weights),
    )


def propensity(pool: DataFrame, columns: list[Column], spec: MatchSpec):
    """The logit of an unpenalised logistic fit of role on the distance columns, and its caliper."""
    p = len(columns) + 1
    design = F.array(F.lit(1.0), *columns)
    patterns = row_patterns(pool.select(F.col("is_case").cast("double").alias("y"), design.alias("x")))
    sums, centre, scale, _ = standardised(patterns, p)
    fit = fit_logistic(sums, p)
    if not fit.converged:
        raise DataContractError("The propensity model did not converge.")
    beta = fit.beta / scale
    intercept = beta[0] - beta[1:] @ centre[1:]
    logit = F.round(F.lit(float(intercept)) + linear(columns, beta[1:]), 9)
    spread = {
        r["is_case"]: r["v"]
        for r in pool.groupBy("is_case").agg(F.var_samp(logit).alias("v")).collect()
    }
    pooled = np.sqrt((spread[1] + spread[0]) / 2)
    width = float(np.round(spec.propensity_caliper * pooled, 9))
    return logit, width, {"coefficients": [intercept, *beta[1:]], "caliper": width}


# --- joins within reach -----------------------------------------------------------------------------------


def caliper_bands(x: Column, width: float, *, copied: bool) -> Column:
    """Bands of twice the caliper: the one a value lies in, or the one or two that its reach touches."""
    band = 2.0 * width
    if not copied:
        return F.floor(x / F.lit(band))
    # A hair more than the caliper, for rounding; the caliper itself is tested afterwards.
    slack = width * (1 + 1e-9) + F.abs(x) * 1e-12
    return F.explode(F.sequence(F.floor((x - slack) / F.lit(band)), F.floor((x + slack) / F.lit(band))))


def caliper_join(
    cases: DataFrame, controls: DataFrame, exact: list[str], calipers: dict[str, float], *, suffix: str = "_control",
    copied: str | None = None,
) -> DataFrame:
    """Pairs with equal ``exact`` columns and every calipered column within its width.

    Every calipered column is cut into bands of twice its width and all bands are keys of one equi-join, so a value
    that many share in one column is still split by the others; a width of 0 is plain equality. The rows of one side
    are copied to the bands they reach, 1.5 a column on average: of ``copied`` ("cases" or "controls"), otherwise of
    the side with fewer rows, which are then counted. Rows with a missing calipered value meet nothing. Run it on
    distinct values with counts when the people themselves need not be paired.
    """
    if copied not in (None, "cases", "controls"):
        raise DataContractError("Copy the rows of cases or of controls.")
    renamed = controls.select(*[F.col(c).alias(f"{c}{suffix}") for c in controls.columns])
    condition = [F.col(c).eqNullSafe(F.col(f"{c}{suffix}")) for c in exact]
    equal = [c for c, width in calipers.items() if width == 0]
    ranged = {c: width for c, width in calipers.items() if width > 0}
    condition += [F.col(c) == F.col(f"{c}{suffix}") for c in equal]
    condition += [F.abs(F.col(c) - F.col(f"{c}{suffix}")) <= width for c, width in ranged.items()]
    if ranged and copied is None:
        copied = "cases" if cases.count() <= controls.count() else "controls"
    left, right, made = cases, renamed, []
    for i, (column, width) in enumerate(ranged.items()):
        left = left.withColumn(f"_band{i}", caliper_bands(F.col(column), width, copied=copied == "cases"))
        other = caliper_bands(F.col(f"{column}{suffix}"), width, copied=copied == "controls")
        right = right.withColumn(f"_other_band{i}", other)
        condition.append(F.col(f"_band{i}") == F.col(f"_other_band{i}"))
        made += [f"_band{i}", f"_other_band{i}"]
    return left.join(right, all_true(condition)).drop(*made)


def grid_axes(space: Geometry, values: Column) -> list[Column]:
    """Coordinates in which the distance is Euclidean, the first ``GRID_AXES`` of them.

    A distance is at least the gap in any one of them, so columns beyond the grid cost pruning but no control.
    """
    if not space.weights:
        return [values[0]]
    return [linear([values[i] for i in range(space.dimensions)], row) for row in space.weights[:GRID_AXES]]


def grid_sides(cells: DataFrame, space: Geometry, want: int) -> DataFrame:
    """(stratum, low, high, base): extent of each stratum's cells, and the box side at which a block of
    neighbouring boxes holds about ``want`` cells if they are spread evenly."""
    axes = grid_axes(space, F.col("values"))
    found = cells.groupBy("stratum").agg(
        F.count("*").alias("n"),
        F.array(*[F.min(y) for y in axes]).alias("low"), F.array(*[F.max(y) for y in axes]).alias("high"),
    )
    wide = F.filter(F.zip_with("high", "low", lambda high, low: high - low), lambda e: e > 0)
    per_box = F.log(F.lit(float(want)) / F.col("n")) / F.size("wide") - F.log(F.lit(3.0))
    size = F.aggregate("wide", F.lit(0.0), lambda total, e: total + F.log(e)) / F.size("wide")
    return found.withColumn("wide", wide).select(
        "stratum", "low", "high", F.when(F.size("wide") > 0, F.exp(size + per_box)).otherwise(1.0).alias("base")
    )


def grid_radii(types: DataFrame, sides: DataFrame, space: Geometry) -> DataFrame:
    """(stratum, values, side, box, radius): the box of each type, and how far its block of boxes vouches.

    Cells outside the block are at least ``radius`` away, in units of the first coordinate. A face of the block
    with no cells behind it, or none within the first caliper, limits nothing; without such faces, and in a
    stratum without cells, the radius is infinite.
    """
    axes = grid_axes(space, F.col("values"))
    free, gaps = F.lit(float("inf")), []
    for i, y in enumerate(axes):
        # The slack is far above the rounding of a box number and far below anything a caliper tells apart.
        slack = F.col("side") * 1e-9 + F.abs(y) * 1e-12
        beyond = float(space.axis_reach) * space.floor * (1 + 1e-9) if i == 0 else float("inf")
        below = y - (F.col("box")[i] - 1) * F.col("side") - slack
        above = (F.col("box")[i] + 2) * F.col("side") - y - slack
        gaps.append(F.when((F.col("low")[i] >= y - below) | (below > beyond), free).otherwise(below))
        gaps.append(F.when((F.col("high")[i] <= y + above) | (above > beyond), free).otherwise(above))
    joined = types.select("stratum", "values").join(broadcast_if_small(sides), "stratum", "left")
    placed = joined.withColumn("box", F.array(*[F.floor(y / F.col("side")) for y in axes]))
    nearest = F.least(*gaps) / F.lit(space.floor)
    return placed.select(
        "stratum", "values", "side", "box", F.when(F.col("side").isNull(), free).otherwise(nearest).alias("radius")
    )


def grid_meetings(placed: DataFrame, cells: DataFrame, sides: DataFrame, space: Geometry) -> DataFrame:
    """Each type of ``grid_radii`` with the cells of its box and the boxes around, by an equi-join on the box."""
    axes = grid_axes(space, F.col("values"))
    around = [
        F.array(*[F.col("box")[i] + step for i, step in enumerate(steps)])
        for steps in itertools.product((-1, 0, 1), repeat=len(axes))
    ]
    boxed = cells.join(broadcast_if_small(sides.select("stratum", "side")), "stratum").withColumn(
        "box", F.array(*[F.floor(y / F.col("side")) for y in axes])
    )
    asked = placed.filter("side is not null").select("stratum", "values", "radius", F.explode(F.array(*around)).alias("box"))
    return asked.join(boxed.drop("side").withColumnRenamed("values", "cell"), ["stratum", "box"]).drop("box")


def reachable(space: Geometry, mine: Column, other: Column) -> Column:
    return all_true([F.abs(mine[i] - other[i]) <= F.lit(width) for i, width in space.calipers])


def distance_between(space: Geometry, mine: Column, other: Column) -> Column:
    """Computed from differences, so that mirrored gaps give exactly equal distances."""
    gaps = [mine[i] - other[i] for i in range(space.dimensions)]
    if not space.weights:
        return F.abs(gaps[0])
    total = F.lit(0.0)
    for row in space.weights:
        part = linear(gaps, row)
        total = total + part * part
    return F.sqrt(total)


def core_pool(pool: DataFrame, spec: MatchSpec, space: Geometry) -> DataFrame:
    """The few columns matching works on: stratum, id, role and coordinates of the valid pool."""
    return with_stratum(pool.filter("valid"), spec).select(
        "stratum", "person_id", "is_case", space.coordinates.alias("values")
    )


# --- with replacement ---------------------------------------------------------------------------------------


def replacement_edges(core: DataFrame, spec: MatchSpec, space: Geometry, limits: MatchLimits) -> DataFrame:
    """Each case's ``ratio`` nearest controls; small strata in a task each, large ones over the cluster."""
    small, large = split_strata(core, limits)
    edges = replacement_small_strata(small, spec, space)
    if large is None:
        return edges
    return edges.unionByName(nearest_with_replacement(large, spec, space, limits))


def replacement_small_strata(core: DataFrame, spec: MatchSpec, space: Geometry) -> DataFrame:
    ratio, shape = spec.ratio, _plain(space)

    def serve(stratum: pd.DataFrame) -> pd.DataFrame:
        cases, market = _stratum_market(stratum, shape)
        if market is None:
            return pd.DataFrame(columns=["stratum", "case_id", "slot", "control_id"])
        lists = {key: nearest_ids(market, np.array(key), ratio) for key in set(cases["key"])}
        rows = [
            (stratum["stratum"].iloc[0], case, slot, control)
            for case, key in zip(cases["person_id"], cases["key"])
            for slot, control in enumerate(lists[key], start=1)
        ]
        return pd.DataFrame(rows, columns=["stratum", "case_id", "slot", "control_id"])

    return core.groupBy("stratum").applyInPandas(serve, EDGES)


def nearest_with_replacement(core: DataFrame, spec: MatchSpec, space: Geometry, limits: MatchLimits) -> DataFrame:
    """Replacement for strata of any size. Lists are made once per distinct case value.

    From a cell only its ``ratio`` smallest ids can ever be used; that cut is a ranked filter Spark applies
    before the shuffle. Types then meet the cells of their block in a grid, and the ``ratio`` nearest of them are
    again a ranked filter, so that tasks keep ``ratio`` rows a type and not what they met. A list is final when
    it is full within the radius of its block; the others go on with boxes of twice the side.
    """
    by_id = Window.partitionBy("stratum", "values").orderBy("person_id")
    heads = cut(
        core.filter("is_case = 0")
        .withColumn("place", F.row_number().over(by_id))
        .filter(F.col("place") <= spec.ratio)
        .groupBy("stratum", "values")
        .agg(F.array_sort(F.collect_list("person_id")).alias("ids"))
    )
    pending = cut(core.filter("is_case = 1").select("stratum", "values").distinct())
    sides = cut(grid_sides(heads, space, max(spec.ratio + 1, limits.window)).withColumn("side", F.col("base")))
    nearest_first = Window.partitionBy("stratum", "values").orderBy("distance", "control_id")
    lists = None
    while True:
        placed = cut(grid_radii(pending, sides, space))
        far = distance_between(space, F.col("values"), F.col("cell"))
        near = (
            grid_meetings(placed, heads, sides, space)
            .filter(reachable(space, F.col("values"), F.col("cell")))
            .withColumn("distance", far)
            .filter(F.col("distance") < F.col("radius") * F.lit(space.floor))
            .select("stratum", "values", "distance", F.explode("ids").alias("control_id"))
            .withColumn("place", F.row_number().over(nearest_first))
            .filter(F.col("place") <= spec.ratio)
            .groupBy("stratum", "values")
            .agg(F.array_sort(F.collect_list(F.struct("distance", "control_id"))).alias("options"))
        )
        found = cut(
            placed.select("stratum", "values", "radius").join(near, ["stratum", "values"], "left").withColumn(
                "final", (F.col("radius") == float("inf")) | (F.coalesce(F.size("options"), F.lit(0)) >= spec.ratio)
            )
        )
        done = found.filter("final and options is not null").select("stratum", "values", "options")
        lists = done if lists is None else lists.unionByName(done)
        pending = found.filter("not final").select("stratum", "values")
        if pending.limit(1).count() == 0:
            break
        sides = sides.withColumn("side", F.col("side") * 2)
    cases = core.filter("is_case = 1").select("stratum", "values", F.col("person_id").alias("case_id"))
    return (
        cases.join(broadcast_if_small(lists), ["stratum", "values"])
        .select("stratum", "case_id", F.posexplode("options").alias("at", "option"))
        .select(
            "stratum", "case_id", (F.col("at") + 1).alias("slot"), F.col("option.control_id").alias("control_id")
        )
    )


# --- without replacement ------------------------------------------------------------------------------------


def _market(cells: pd.DataFrame, space: Geometry) -> CellMarket:
    market = CellMarket(
        np.array(cells["values"].tolist(), dtype=float),
        cells["ids"].tolist(),
        cells["truncated"].tolist(),
        space.dimensions,
        list(space.calipers),
        space.weights,
        space.floor,
    )
    market.reach = min(market.reach, space.axis_reach)
    return market


def _plain(space: Geometry) -> Geometry:
    return Geometry(None, space.dimensions, space.calipers, space.axis_reach, space.weights)


def _stratum_market(stratum: pd.DataFrame, shape: Geometry):
    """Cases in id order with their values as ``key``, and the market of all controls of one stratum."""
    stratum = stratum.assign(key=[tuple(v) for v in stratum["values"]]).sort_values("person_id")
    cases = stratum[stratum["is_case"] == 1]
    controls = stratum[stratum["is_case"] == 0]
    if cases.empty or controls.empty:
        return cases, None
    grouped = controls.groupby("key", sort=True)["person_id"].agg(list)
    cells = pd.DataFrame({"values": list(grouped.index), "ids": list(grouped), "truncated": False})
    return cases, _market(cells, shape)


def greedy_small_strata(core: DataFrame, spec: MatchSpec, space: Geometry) -> DataFrame:
    """One task per stratum, in parallel over strata. Only for strata within the limits."""
    ratio, shape = spec.ratio, _plain(space)

    def serve(stratum: pd.DataFrame) -> pd.DataFrame:
        cases, market = _stratum_market(stratum, shape)
        if market is None:
            return pd.DataFrame(columns=["stratum", "case_id", "slot", "control_id"])
        kinds, labels = np.unique(np.array(cases["key"].tolist(), dtype=float), axis=0, return_inverse=True)
        agents = np.tile(labels.ravel(), ratio).tolist()
        picks, _ = choose(market, kinds, [np.inf] * len(kinds), agents)
        result = pd.DataFrame({
            "stratum": stratum["stratum"].iloc[0],
            "case_id": np.tile(cases["person_id"].to_numpy(), ratio),
            "slot": np.repeat(np.arange(1, ratio + 1), len(cases)).astype("int32"),
            "control_id": picks,
        })
        return result[result["control_id"].notna()]

    return core.groupBy("stratum").applyInPandas(serve, EDGES)


def greedy_large_strata(core: DataFrame, spec: MatchSpec, space: Geometry, limits: MatchLimits) -> DataFrame:
    """Chunked greedy for strata no single task should hold; equal to serving all agents one after another.

    Agents are (slot, case) in priority order. A round serves the next chunk of every stratum: its task gets
    the chunk's agents, the cells they can reach, and from each cell the next free ids. Serving stops before
    an agent whose nearest control may lie outside what was fetched; the next round starts there. Each stratum's
    chunk grows from ``limits.chunk`` to ``limits.chunk_most`` while its rounds serve at least half of what they
    take, so a small first chunk costs a few rounds, not as many as it fits into the agents.
    """
    most = max(limits.chunk, limits.chunk_most)
    ratio, shape = spec.ratio, _plain(space)
    spark = core.sparkSession
    cases = numbered(core.filter("is_case = 1"), ["stratum"], [F.col("person_id").asc()], "seat")
    cases = cut(cases.select("stratum", F.col("person_id").alias("case_id"), "values", "seat"))
    controls = numbered(core.filter("is_case = 0"), ["stratum", "values"], [F.col("person_id").asc()], "place")
    controls = cut(controls.select("stratum", "values", "place", F.col("person_id").alias("control_id")))
    cells = cut(
        controls.groupBy("stratum", "values").agg(F.count("*").alias("supply")).withColumn("taken", F.lit(0).cast("long"))
    )
    state = cut(
        cases.groupBy("stratum").agg(F.count("*").alias("n")).select(
            "stratum", "n", F.lit(0).cast("long").alias("cursor"), F.lit(1).cast("long").alias("growth"),
            F.lit(limits.chunk).cast("long").alias("chunk"),
        )
    )
    edges, rounds = None, 0
    while True:
        open_strata = broadcast_if_small(state.filter(F.col("cursor") < F.col("n") * ratio))
        slots = F.explode(F.sequence(F.lit(1), F.lit(ratio)))
        agents = (
            cases.join(open_strata, "stratum")
            .select("*", slots.alias("slot"))
            .withColumn("turn", (F.col("slot") - 1) * F.col("n") + F.col("seat") - 1)
            .filter(F.col("turn").between(F.col("cursor"), F.col("cursor") + F.col("chunk") - 1))
        )
        kinds = cut(agents.groupBy("stratum", "values").agg(
            F.count("*").alias("wanting"), F.first("growth").alias("growth"), F.first("chunk").alias("chunk")))
        if kinds.limit(1).count() == 0:
            return edges
        free = cut(cells.filter("supply > taken").join(broadcast_if_small(kinds.select("stratum").distinct()), "stratum"))
        reached, radii = _cells_in_reach(kinds, free, shape, limits)
        chosen = _slices(reached, kinds, free, controls)
        agent_rows = agents.join(broadcast_if_small(radii), ["stratum", "values"]).select(
            "stratum", "turn", "case_id", "slot", "values", "radius"
        )

        def serve(key, mine: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
            mine = mine.sort_values("turn")
            columns = ["stratum", "case_id", "slot", "control_id", "cell", "served"]
            if mine.empty:
                return pd.DataFrame(columns=columns)
            keys = np.array(mine["values"].tolist(), dtype=float)
            types, first, labels = np.unique(keys, axis=0, return_index=True, return_inverse=True)
            radius = mine["radius"].to_numpy()[first]
            if offered.empty:
                # No free control is left within anybody's proven reach.
                served = len(mine) if np.isinf(radius).all() else 0
                done = pd.DataFrame([[key[0], None, 0, None, None, served]], columns=columns)
                return done
            market = _market(offered, shape)
            picks, at = choose(market, types, radius, labels.ravel().tolist())
            served = mine.iloc[: len(picks)]
            result = pd.DataFrame({
                "stratum": key[0], "case_id": served["case_id"].to_numpy(), "slot": served["slot"].to_numpy(),
                "control_id": picks, "cell": [market.coordinates[i].tolist() if i >= 0 else None for i in at],
                "served": 0,
            })
            result = result[result["control_id"].notna()]
            mark = pd.DataFrame([[key[0], None, 0, None, None, len(picks)]], columns=columns)
            return pd.concat([result, mark], ignore_index=True)

        served = cut(
            agent_rows.groupBy("stratum")
            .cogroup(chosen.groupBy("stratum"))
            .applyInPandas(serve, EDGES + ", cell array<double>, served long")
        )
        made = served.filter("case_id is not null")
        progress = broadcast_if_small(served.filter("case_id is null").select("stratum", "served"))
        new = made.select("stratum", "case_id", "slot", "control_id")
        edges = new if edges is None else edges.unionByName(new)
        used = made.groupBy("stratum", F.col("cell").alias("values")).agg(F.count("*").alias("more"))
        cells = cut(
            cells.join(broadcast_if_small(used), ["stratum", "values"], "left").select(
                "stratum", "values", "supply", (F.col("taken") + F.coalesce("more", F.lit(0))).alias("taken")
            )
        )
        poor = 2 * F.col("served") < F.least(F.col("chunk"), F.col("n") * ratio - F.col("cursor"))
        state = cut(
            state.join(progress, "stratum", "left").select(
                "stratum", "n", (F.col("cursor") + F.coalesce("served", F.lit(0))).alias("cursor"),
                # Too little was fetched when few could be served: fetch more next time, until a round goes well.
                F.when(F.col("served") == 0, F.col("growth") * 4).when(poor, F.col("growth") * 2).otherwise(1).alias("growth"),
                F.when(poor, F.col("chunk")).otherwise(F.least(F.col("chunk") * 4, F.lit(most))).alias("chunk"),
            )
        )
        rounds += 1
        if rounds % 16 == 0:
            # Keep the union of many rounds short.
            edges = cut(edges)


def _cells_in_reach(kinds: DataFrame, free: DataFrame, space: Geometry, limits: MatchLimits):
    """Distinct cells each stratum's chunk may need, and per type the radius they vouch for.

    Where types times cells is small all free cells go; elsewhere only those of the grid's blocks around each type.
    """
    sizes = kinds.groupBy("stratum").agg(F.count("*").alias("types")).join(
        free.groupBy("stratum").agg(F.count("*").alias("cells")), "stratum", "left"
    )
    few = F.coalesce(F.col("types") * F.col("cells"), F.lit(0)) <= limits.stratum_pairs
    sized = cut(sizes.select("stratum", few.alias("few"), F.coalesce("cells", F.lit(0)).alias("cells")))
    small = broadcast_if_small(sized.filter("few").select("stratum"))
    everything = free.join(small, "stratum").select("stratum", "values")
    infinite = kinds.join(small, "stratum").select("stratum", "values", F.lit(float("inf")).alias("radius"))
    if sized.filter("not few").limit(1).count() == 0:
        return everything, infinite
    wide = kinds.join(small, "stratum", "left_anti")
    others = free.join(small, "stratum", "left_anti").select("stratum", "values")
    pace = wide.groupBy("stratum").agg(F.max("growth").alias("growth"))
    sides = cut(
        grid_sides(others, space, limits.window)
        .join(broadcast_if_small(pace), "stratum")
        .withColumn("side", F.col("base") * F.col("growth"))
    )
    placed = cut(grid_radii(wide, sides, space))
    near = grid_meetings(placed, others, sides, space).select("stratum", F.col("cell").alias("values")).distinct()
    return everything.unionByName(near), infinite.unionByName(placed.select("stratum", "values", "radius"))


def _slices(reached: DataFrame, kinds: DataFrame, free: DataFrame, controls: DataFrame):
    """(stratum, values, ids, truncated): the next free ids of each reached cell.

    A cell offers twice what its own value's agents want plus an even share of the chunk, times the growth of
    its stratum, which doubles while rounds end early because a cell ran dry. Cells that no case stands on
    grow as well, so the rounds for one far cell are logarithmic in what is wanted of it.
    """
    growth = kinds.groupBy("stratum").agg(F.max("growth").alias("pace"), F.max("chunk").alias("chunk"))
    counted = reached.groupBy("stratum").agg(F.count("*").alias("reached")).join(growth, "stratum")
    offer = (
        free.join(broadcast_if_small(reached), ["stratum", "values"], "left_semi")
        .join(broadcast_if_small(counted), "stratum")
        .join(broadcast_if_small(kinds.select("stratum", "values", "wanting")), ["stratum", "values"], "left")
    )
    even = F.ceil(4 * F.col("chunk") / F.col("reached"))
    length = F.least(
        F.col("supply") - F.col("taken"), F.col("chunk"),
        (F.coalesce("wanting", F.lit(0)) * 2 + even + 16) * F.col("pace"),
    )
    offer = cut(
        offer.select(
            "stratum", "values", "taken", length.alias("length"),
            (length < F.col("supply") - F.col("taken")).alias("truncated"),
        )
    )
    return (
        controls.join(broadcast_if_small(offer), ["stratum", "values"])
        .filter((F.col("place") > F.col("taken")) & (F.col("place") <= F.col("taken") + F.col("length")))
        .groupBy("stratum", "values")
        .agg(F.array_sort(F.collect_list("control_id")).alias("ids"), F.first("truncated").alias("truncated"))
    )


def stratum_shapes(core: DataFrame, limits: MatchLimits) -> DataFrame:
    """People, distinct case values and cells per stratum, and whether one task may hold the stratum."""
    shapes = core.groupBy("stratum", "values", "is_case").agg(F.count("*").alias("n")).groupBy("stratum").agg(
        F.sum("n").alias("rows"),
        F.count_if(F.col("is_case") == 1).alias("types"),
        F.count_if(F.col("is_case") == 0).alias("cells"),
    )
    fits = (F.col("rows") <= limits.stratum_rows) & (F.col("types") * F.col("cells") <= limits.stratum_pairs)
    return shapes.withColumn("fits", fits)


def split_strata(core: DataFrame, limits: MatchLimits) -> tuple[DataFrame, DataFrame | None]:
    """The pool of strata that fit into a task, and the pool of the others if there are any."""
    shapes = stratum_shapes(core, limits)
    facts = shapes.agg(
        F.count_if(~F.col("fits")).alias("large"), F.count_if(F.col("types") > 0).alias("cases"),
        F.count_if(F.col("cells") > 0).alias("controls"),
    ).first()
    if not facts["cases"] or not facts["controls"]:
        raise DataContractError("Matching needs valid cases and valid controls.")
    if not facts["large"]:
        return core, None
    large = broadcast_if_small(cut(shapes.filter("not fits").select("stratum")))
    return core.join(large, "stratum", "left_anti"), cut(core.join(large, "stratum", "left_semi"))


def greedy_edges(core: DataFrame, spec: MatchSpec, space: Geometry, limits: MatchLimits) -> DataFrame:
    """(stratum, case_id, slot, control_id) of the sequential greedy without replacement."""
    small, large = split_strata(core, limits)
    edges = greedy_small_strata(small, spec, space)
    if large is None:
        return edges
    more = greedy_large_strata(large, spec, space, limits)
    return edges if more is None else edges.unionByName(more)


# --- the result -----------------------------------------------------------------------------------------------


def layout_members(edges: DataFrame, pool: DataFrame, spec: MatchSpec) -> DataFrame:
    """One row per set and person with weights, carried columns and differences to the set's case.

    Sets below the minimum are dropped; their controls stay used.
    """
    controls = edges.select(
        "case_id", F.col("control_id").alias("person_id"), F.lit(0).alias("is_case"),
        F.col("slot").alias("control_order"),
    )
    cases = edges.filter("slot = 1").select(
        "case_id", F.col("case_id").alias("person_id"), F.lit(1).alias("is_case"), F.lit(0).alias("control_order")
    )
    carried = pool.filter("valid").drop("is_case", "valid")
    rows = cases.unionByName(controls).join(carried, "person_id")
    rows = rows.withColumn("match_set_id", F.concat(F.lit("set_"), F.col("case_id")))
    # A set has at most ratio + 1 rows, so this window has no hot partition.
    in_set = Window.partitionBy("match_set_id")
    of_case = {c: F.max(F.when(F.col("is_case") == 1, F.col(c))).over(in_set) for c in spec.calipers}
    rows = rows.withColumn("_m", F.count("*").over(in_set) - 1)
    for column, value in of_case.items():
        rows = rows.withColumn(f"match_difference_{column}", F.col(column) - value)
    weight = F.when(F.col("is_case") == 1, F.lit(1.0)).otherwise(F.lit(1.0) / F.col("_m"))
    rows = rows.filter(F.col("_m") >= spec.minimum_controls).withColumn("weight", weight)
    first = ["person_id", "match_set_id", "is_case", "control_order", "weight"]
    return rows.select(*first, *[c for c in rows.columns if c not in (*first, "_m", "case_id")])


def unmatched_cases(pool: DataFrame, members: DataFrame) -> DataFrame:
    cases = pool.filter("is_case = 1")
    dropped = cases.filter("not valid").select("person_id", F.lit("missing_match_feature").alias("reason"))
    left = cases.filter("valid").join(members.filter("is_case = 1"), "person_id", "left_anti")
    return dropped.unionByName(
        left.select("person_id", F.lit("no_sufficient_eligible_controls").alias("reason"))
    )


def set_checks(spec: MatchSpec) -> list[tuple[Column, str]]:
    """Aggregates over one set that tell whether it breaks the ratio, an exact column or a caliper."""
    case, control = F.col("is_case") == 1, F.col("is_case") == 0
    checks = [
        (F.count_if(case) != 1, "cases"),
        (~F.count_if(control).between(spec.minimum_controls, spec.ratio), "controls"),
    ]
    for name in spec.exact:
        text = F.col(name).cast("string")
        own = F.max(F.when(case, text))
        differs = (F.min(F.when(control, text)) != own) | (F.max(F.when(control, text)) != own)
        checks.append((F.coalesce(differs, F.lit(False)), f"exact {name}"))
    for name, width in spec.calipers.items():
        value = F.col(name).cast("double")
        own = F.max(F.when(case, value))
        far = F.greatest(F.max(F.when(control, value)) - own, own - F.min(F.when(control, value)))
        checks.append((F.coalesce(far > width + 1e-10, F.lit(False)), f"caliper {name}"))
    return checks


def criteria_violations(members: DataFrame, spec: MatchSpec) -> DataFrame:
    """(match_set_id, problem) for sets that break the ratio, an exact column or a caliper."""
    named = F.array(*[F.when(test, F.lit(name)) for test, name in set_checks(spec)])
    return members.groupBy("match_set_id").agg(F.array_compact(named).alias("problems")).select(
        "match_set_id", F.explode("problems").alias("problem")
    )


def broken_rules(members: DataFrame, spec: MatchSpec) -> DataFrame:
    """(problem, n) with the number of sets: one pass per set, and one per person or per set and person."""
    checks = set_checks(spec)
    sets = members.groupBy("match_set_id").agg(*[test.alias(f"c{i}") for i, (test, _) in enumerate(checks)])
    totals = sets.agg(
        F.count("*").alias("sets"), *[F.count_if(f"c{i}").alias(name) for i, (_, name) in enumerate(checks)]
    )
    key = ["match_set_id", "person_id"] if spec.replace else ["person_id"]
    repeated = members.groupBy(*key).agg(F.count("*").alias("c")).agg(F.count_if(F.col("c") > 1).alias("n"))
    return totals.unpivot([], totals.columns, "problem", "n").unionByName(
        repeated.select(F.lit("repeated people").alias("problem"), "n")
    )


def membership_violations(members: DataFrame, *, replacement: bool = False) -> DataFrame:
    """(problem, n) over all rows: nulls, roles, repeats within a set, reuse, and set composition."""
    nulls = any_true([F.col(c).isNull() for c in ("person_id", "match_set_id", "is_case")])
    people = members.groupBy("match_set_id", "person_id").agg(
        F.count("*").alias("size"),
        F.sum("is_case").alias("cases"),
        F.count_if(nulls).alias("nulls"),
        F.count_if(~F.col("is_case").isin(0, 1)).alias("roles"),
    )
    sets = people.groupBy("match_set_id").agg(
        *[F.sum(c).alias(c) for c in ("size", "cases", "nulls", "roles")],
        F.count_if(F.col("person_id").isNotNull() & (F.col("size") > 1)).alias("repeated"),
    )
    composed = F.coalesce((F.col("cases") == 1) & (F.col("size") >= 2), F.lit(False))
    totals = sets.agg(
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("null identifiers"),
        F.coalesce(F.sum("roles"), F.lit(0)).alias("roles"),
        F.coalesce(F.sum("repeated"), F.lit(0)).alias("repeated in a set"),
        F.count_if(~composed).alias("set composition"),
    )
    rows = totals.unpivot([], totals.columns, "problem", "n")
    if replacement:
        return rows
    reused = members.groupBy("person_id").count().filter("count > 1").agg(F.count("*").alias("n"))
    return rows.unionByName(reused.select(F.lit("reused").alias("problem"), "n"))


def achieved_ratios(members: DataFrame) -> DataFrame:
    sizes = members.groupBy("match_set_id").agg((F.count("*") - 1).alias("controls"))
    return sizes.groupBy("controls").agg(F.count("*").alias("sets"))


def matching_summary(pool: DataFrame, members: DataFrame, unmatched: DataFrame) -> DataFrame:
    roles = members.agg(
        F.count_if(F.col("is_case") == 1).alias("matched_cases"), F.count_if(F.col("is_case") == 0).alias("controls")
    )
    dropped = pool.agg(
        F.count_if((F.col("is_case") == 1) & ~F.col("valid")).alias("missing_case_match_features"),
        F.count_if((F.col("is_case") == 0) & ~F.col("valid")).alias("missing_control_match_features"),
    )
    left = unmatched.agg(F.count("*").alias("unmatched_cases"))
    # Three frames of one row each, stacked and read back as one row.
    parts = [f.unpivot([], f.columns, "name", "n") for f in (roles, dropped, left)]
    names = [*roles.columns, *dropped.columns, *left.columns]
    stacked = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return stacked.agg(*[F.max(F.when(F.col("name") == n, F.col("n"))).alias(n) for n in names])


def match_edges(core: DataFrame, spec: MatchSpec, space: Geometry, limits: MatchLimits = MatchLimits()) -> DataFrame:
    if spec.replace:
        return replacement_edges(core, spec, space, limits)
    return greedy_edges(core, spec, space, limits)


def match_groups(
    people: DataFrame, spec: MatchSpec, *, limits: MatchLimits = MatchLimits(), checked: bool = False,
    stored: bool = False,
) -> MatchResult:
    """Match, lay out the sets, verify them, and report what was achieved.

    ``checked`` says that every person is known to be there once; ``stored`` that ``people`` is read from
    files, so that the pool, a projection of it, need not be written again.
    """
    if not checked and people.groupBy("person_id").count().filter("count > 1").limit(1).count():
        raise DataContractError("Somebody appears twice, or in both roles.")
    pool = match_pool(people, spec)
    pool = pool if stored else cut(pool)
    space = geometry(pool.filter("valid"), spec)
    core = core_pool(pool, spec, space)
    edges = cut(match_edges(core, spec, space, limits))  # the layout reads them twice
    members = cut(layout_members(edges, pool, spec))
    found = {r["problem"]: r["n"] for r in broken_rules(members, spec).collect()}
    if not found.pop("sets"):
        raise DataContractError("No set meets the matching rules.")
    if any(found.values()):
        raise DataContractError(f"Matched sets break their rules: {found}")
    unmatched = unmatched_cases(pool, members)
    from .balance import balance_table

    return MatchResult(
        pool=pool,
        members=members,
        unmatched=unmatched,
        spec=spec,
        summary=matching_summary(pool, members, unmatched),
        ratios=achieved_ratios(members),
        balance=balance_table(pool, members, spec),
    )
