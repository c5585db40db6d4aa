"""Likelihood sums over distinct data patterns, and the small solves made from them.

Rows with equal values are first counted together on Spark. The sums a Newton step needs (log-likelihood,
score, information) are then computed over that pattern table: by tasks when it is large, and in numpy on
the driver once it was counted and found small. Only vectors and matrices of model size are solved here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import cut

#: Pattern tables of at most this many rows are summed on the driver.
LOCAL_PATTERNS = 50_000
CHI2_95 = 3.841458820694124


def logistic_sums(data: dict, beta: np.ndarray) -> np.ndarray:
    x, y, n = data["x"], data["y"], data["n"]
    eta = x @ beta
    p = 0.5 * (1.0 + np.tanh(0.5 * eta))
    value = np.sum(n * (y * eta - np.logaddexp(0.0, eta)))
    score = x.T @ (n * (y - p))
    information = (x * (n * p * (1 - p))[:, None]).T @ x
    return np.concatenate([[value], score, information.ravel()])


def firth_scores(data: dict, beta: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    x, y, n = data["x"], data["y"], data["n"]
    p = 0.5 * (1.0 + np.tanh(0.5 * (x @ beta)))
    leverage = p * (1 - p) * np.einsum("ij,jk,ik->i", x, inverse, x)
    return x.T @ (n * (y - p + leverage * (0.5 - p)))


def conditional_sums(data: dict, beta: np.ndarray) -> np.ndarray:
    """Sets hold the controls' values minus their case's, so the case contributes exp(0)."""
    p = len(beta)
    value, score, information = 0.0, np.zeros(p), np.zeros((p, p))
    for gaps, n in data["sets"]:
        eta = gaps @ beta
        top = np.maximum(eta.max(axis=1), 0.0)
        share = np.exp(eta - top[:, None])
        total = np.exp(-top) + share.sum(axis=1)
        share /= total[:, None]
        mean = np.einsum("sj,sjk->sk", share, gaps)
        value -= np.sum(n * (top + np.log(total)))
        score -= n @ mean
        information += np.einsum("s,sj,sjk,sjl->kl", n, share, gaps, gaps) - (mean * n[:, None]).T @ mean
    return np.concatenate([[value], score, information.ravel()])


def centred_gram(data: dict, width: int) -> np.ndarray:
    """Cross products of the design centred within each set."""
    gram = np.zeros((width, width))
    for gaps, n in data["sets"]:
        members = np.concatenate([np.zeros((len(gaps), 1, width)), gaps], axis=1)
        members -= members.mean(axis=1, keepdims=True)
        gram += np.einsum("s,sjk,sjl->kl", n, members, members)
    return gram.ravel()


def squares(data: dict, width: int) -> np.ndarray:
    total, rows = np.zeros(width), 0.0
    for gaps, n in data["sets"]:
        total += np.einsum("s,sjk->k", n, gaps * gaps)
        rows += gaps.shape[1] * n.sum()
    return np.concatenate([[rows], total])


def moments(data: dict, width: int) -> np.ndarray:
    x, n = data["x"], data["n"]
    return np.concatenate([[n.sum()], n @ x, (x * n[:, None]).T.dot(x).ravel()])


def row_arrays(batch: pd.DataFrame) -> dict:
    return {
        "x": np.array(batch["x"].tolist(), dtype=float),
        "y": batch["y"].to_numpy(dtype=float),
        "n": batch["n"].to_numpy(dtype=float),
    }


def set_arrays(batch: pd.DataFrame, width: int) -> dict:
    sets = []
    for size, rows in batch.groupby(batch["x"].map(len)):
        gaps = np.array(rows["x"].tolist(), dtype=float).reshape(len(rows), size // width, width)
        sets.append((gaps, rows["n"].to_numpy(dtype=float)))
    return {"sets": sets}


@dataclass
class PatternSums:
    """Evaluates a sum kernel over a pattern table, in tasks or on the driver depending on its row count."""

    patterns: DataFrame
    arrays: object
    scale: np.ndarray | None = None
    shift: np.ndarray | None = None
    index: np.ndarray | None = None
    limit: int = LOCAL_PATTERNS
    local: dict | None = field(default=None, init=False)

    def __post_init__(self):
        # Never more than limit + 1 rows come to the driver; a larger table is written and stays on the cluster.
        rows = self.patterns.limit(self.limit + 1).toPandas()
        if len(rows) <= self.limit:
            # A fixed order makes repeated runs add up to the same last digit.
            order = rows.apply(lambda r: tuple(tuple(v) if hasattr(v, "__len__") else (v,) for v in r), axis=1)
            self.local = self.arrays(rows.loc[order.sort_values().index] if len(rows) else rows)
        else:
            self.patterns = cut(self.patterns)

    def __call__(self, kernel, *arguments) -> np.ndarray:
        if self.local is not None:
            return kernel(scaled(self.local, self.scale, self.shift, self.index), *arguments)
        arrays, scale, shift, index = self.arrays, self.scale, self.shift, self.index

        def partial_sums(batches):
            total = None
            for batch in batches:
                if len(batch):
                    sums = kernel(scaled(arrays(batch), scale, shift, index), *arguments)
                    total = sums if total is None else total + sums
            if total is not None:
                yield pd.DataFrame({"at": np.arange(len(total)), "part": total})

        summed = self.patterns.mapInPandas(partial_sums, "at long, part double").groupBy("at")
        rows = summed.agg(F.sum("part").alias("total")).orderBy("at").collect()
        return np.array([r["total"] for r in rows])


def scaled(data: dict, scale, shift, index) -> dict:
    if scale is None:
        return data
    if "sets" in data:
        return {"sets": [(gaps[:, :, index] / scale, n) for gaps, n in data["sets"]]}
    return {**data, "x": (data["x"] - shift) / scale}


def unpack(sums: np.ndarray, p: int):
    return sums[0], sums[1 : p + 1], sums[p + 1 :].reshape(p, p)


@dataclass
class Fit:
    beta: np.ndarray
    value: float
    score: np.ndarray
    information: np.ndarray
    converged: bool
    iterations: int


def newton(evaluate, p: int, iterations: int, tolerance: float = 1e-10, start=None) -> Fit:
    """Maximise with halved Newton steps. ``evaluate(beta)`` gives (value, score, information)."""
    beta = np.zeros(p) if start is None else np.array(start, dtype=float)
    value, score, information = evaluate(beta)
    for step_count in range(1, iterations + 1):
        if np.max(np.abs(score), initial=0.0) <= tolerance * (1.0 + abs(value)):
            return Fit(beta, value, score, information, True, step_count - 1)
        try:
            step = np.linalg.solve(information, score)
        except np.linalg.LinAlgError:
            return Fit(beta, value, score, information, False, step_count)
        size = 1.0
        while True:
            trial = evaluate(beta + size * step)
            if np.isfinite(trial[0]) and trial[0] >= value - 1e-12 * (1.0 + abs(value)):
                break
            size /= 2
            if size < 1e-10:
                return Fit(beta, value, score, information, False, step_count)
        moved = np.max(np.abs(size * step))
        beta = beta + size * step
        gained = trial[0] - value
        value, score, information = trial
        if moved < 1e-11 and gained <= 1e-11:
            return Fit(beta, value, score, information, True, step_count)
    return Fit(beta, value, score, information, False, iterations)


def fit_logistic(sums: PatternSums, p: int, iterations: int = 100) -> Fit:
    return newton(lambda b: unpack(sums(logistic_sums, b), p), p, iterations)


def fit_conditional(sums: PatternSums, p: int, iterations: int) -> Fit:
    return newton(lambda b: unpack(sums(conditional_sums, b), p), p, iterations)


def penalised(sums: PatternSums, beta: np.ndarray):
    """Jeffreys-penalised log-likelihood, its score, and the information matrix."""
    p = len(beta)
    value, _, information = unpack(sums(logistic_sums, beta), p)
    sign, logdet = np.linalg.slogdet(information)
    if sign <= 0 or not np.isfinite(logdet):
        return -np.inf, np.full(p, np.nan), information
    score = sums(firth_scores, beta, np.linalg.inv(information))
    return value + 0.5 * logdet, score, information


def fit_firth(sums: PatternSums, p: int, iterations: int, fixed: tuple | None = None, start=None) -> Fit:
    """Firth estimate; ``fixed=(index, value)`` holds one coefficient and keeps the full penalty."""
    free = [i for i in range(p) if fixed is None or i != fixed[0]]

    def full(part):
        beta = np.zeros(p)
        beta[free] = part
        if fixed is not None:
            beta[fixed[0]] = fixed[1]
        return beta

    def evaluate(part):
        value, score, information = penalised(sums, full(part))
        return value, score[free], information[np.ix_(free, free)]

    part = np.zeros(len(free)) if start is None else np.asarray(start)[free]
    fit = newton(evaluate, len(free), iterations, tolerance=1e-9, start=part)
    return Fit(full(fit.beta), fit.value, fit.score, fit.information, fit.converged, fit.iterations)


class NotConverged(Exception):
    """A profile fit, or the search for a bound, ended before it met its tolerance."""


def many_logistic_sums(data: dict, betas: list) -> np.ndarray:
    return np.concatenate([logistic_sums(data, beta) for beta in betas])


def many_firth_scores(data: dict, betas: list, inverses: list) -> np.ndarray:
    return np.concatenate([firth_scores(data, beta, inverse) for beta, inverse in zip(betas, inverses)])


def penalised_many(sums: PatternSums, betas: list) -> list[tuple]:
    """``penalised`` at several points, in two passes over the patterns whatever their number."""
    p = len(betas[0])
    parts = sums(many_logistic_sums, betas).reshape(len(betas), -1)
    found, sound = [], []
    for i, part in enumerate(parts):
        value, _, information = unpack(part, p)
        sign, logdet = np.linalg.slogdet(information)
        found.append((-np.inf, np.full(p, np.nan), information))
        if sign > 0 and np.isfinite(logdet):
            sound.append((i, value + 0.5 * logdet, information))
    if sound:
        inverses = [np.linalg.inv(information) for _, _, information in sound]
        scores = sums(many_firth_scores, [betas[i] for i, _, _ in sound], inverses).reshape(len(sound), p)
        for (i, value, information), score in zip(sound, scores):
            found[i] = (value, score, information)
    return found


def newton_many(evaluate, starts: list, iterations: int, tolerance: float) -> list[Fit]:
    """``newton`` from many points at once. ``evaluate(which, betas)`` serves the points that still move together."""
    beta = [np.array(start, dtype=float) for start in starts]
    state = evaluate(list(range(len(beta))), beta)
    fits: dict[int, Fit] = {}

    def settle(i, converged, steps):
        fits[i] = Fit(beta[i], *state[i], converged, steps)

    for steps in range(1, iterations + 1):
        moves, size = {}, {}
        for i in range(len(beta)):
            if i in fits:
                continue
            value, score, information = state[i]
            if np.max(np.abs(score), initial=0.0) <= tolerance * (1.0 + abs(value)):
                settle(i, True, steps - 1)
                continue
            try:
                moves[i], size[i] = np.linalg.solve(information, score), 1.0
            except np.linalg.LinAlgError:
                settle(i, False, steps)
        waiting = sorted(moves)
        while waiting:
            trials = evaluate(waiting, [beta[i] + size[i] * moves[i] for i in waiting])
            again = []
            for i, trial in zip(waiting, trials):
                value = state[i][0]
                if np.isfinite(trial[0]) and trial[0] >= value - 1e-12 * (1.0 + abs(value)):
                    moved, gained = np.max(np.abs(size[i] * moves[i]), initial=0.0), trial[0] - value
                    beta[i], state[i] = beta[i] + size[i] * moves[i], trial
                    if moved < 1e-11 and gained <= 1e-11:
                        settle(i, True, steps)
                    continue
                size[i] /= 2
                if size[i] < 1e-10 or not np.isfinite(value):
                    settle(i, False, steps)
                else:
                    again.append(i)
            waiting = again
        if len(fits) == len(beta):
            break
    for i in range(len(beta)):
        if i not in fits:
            settle(i, False, iterations)
    return [fits[i] for i in range(len(beta))]


def fit_profiles(sums: PatternSums, p: int, iterations: int, index: int, values: list, starts: list) -> list[Fit]:
    """Firth estimates with coefficient ``index`` held at each of ``values``, all moving together."""
    free = [i for i in range(p) if i != index]

    def full(part, value):
        beta = np.zeros(p)
        beta[free], beta[index] = part, value
        return beta

    def evaluate(which, parts):
        found = penalised_many(sums, [full(part, values[i]) for i, part in zip(which, parts)])
        return [(value, score[free], information[np.ix_(free, free)]) for value, score, information in found]

    fits = newton_many(evaluate, [np.asarray(start)[free] for start in starts], iterations, tolerance=1e-9)
    return [
        Fit(full(f.beta, v), f.value, f.score, f.information, f.converged, f.iterations) for f, v in zip(fits, values)
    ]


def profile_interval(sums: PatternSums, best: Fit, index: int, width: float, iterations: int) -> tuple[float, float]:
    """Both values at which twice the drop of the profile reaches the 95 % quantile; infinite where it never does.

    Trial values of both ends are fitted in one batch and start from the nearest fit known. Steps widen 40 times at
    most; then values around the root that the known points suggest, and the middle, close in on it. A batch costs
    two passes over the patterns a Newton step, so an interval takes tens of jobs at most and no fit runs alone.
    """
    p, centre = len(best.beta), float(best.beta[index])
    known = {centre: best.beta}
    points: dict[int, dict] = {side: {centre: -CHI2_95} for side in (-1, 1)}
    bounds: dict[int, float] = {}
    bracket: dict[int, tuple] = {}

    def excesses(asked: list) -> list:
        """(side, value, excess or None where the fit did not end), in the order asked."""
        starts = [known[min(known, key=lambda k: abs(k - value))] for _, value in asked]
        fits = fit_profiles(sums, p, iterations, index, [value for _, value in asked], starts)
        result = []
        for (side, value), fit in zip(asked, fits):
            sound = np.isfinite(fit.value)
            if sound and fit.converged:
                known[value] = fit.beta
                points[side][value] = 2.0 * (best.value - fit.value) - CHI2_95
            result.append((side, value, points[side].get(value) if sound else np.inf))
        return result

    for first in range(0, 40, 4):
        asked = [
            (side, centre + side * width * 1.6**k) for side in (-1, 1) if side not in bracket and side not in bounds
            for k in range(first, first + 4)
        ]
        if not asked:
            break
        for side, value, high in excesses(asked):
            if side in bracket or side in bounds:
                continue
            if high is None:
                raise NotConverged
            if np.isinf(high):
                bounds[side] = side * np.inf
            elif high >= 0:
                inner = max((v for v, e in points[side].items() if e < 0), key=lambda v: side * v)
                bracket[side] = (inner, value)
    for side in (-1, 1):
        if side not in bracket:
            bounds.setdefault(side, side * np.inf)
    for _ in range(60):
        asked = []
        for side, (inner, outer) in bracket.items():
            if side not in bounds:
                asked += [(side, value) for value in _around_root(points[side], inner, outer)]
        if not asked:
            return bounds[-1], bounds[1]
        for side, value, now in excesses(asked):
            if now is None or np.isinf(now):
                raise NotConverged
            inner, outer = bracket[side]
            if now >= 0 and side * value < side * outer:
                bracket[side] = (inner, value)
            elif now < 0 and side * value > side * inner:
                bracket[side] = (value, outer)
        for side in {side for side, _ in asked}:
            inner, outer = bracket[side]
            nearest = min(points[side], key=lambda v: abs(points[side][v]))
            if abs(points[side][nearest]) < 1e-10:
                bounds[side] = nearest
            elif abs(outer - inner) <= 1e-10 * (1.0 + abs(outer)):
                bounds[side] = outer
    raise NotConverged


def _around_root(points: dict, inner: float, outer: float) -> list[float]:
    """Trial values inside the bracket: the middle, and closely around the root by inverse interpolation."""
    wide, middle = outer - inner, (inner + outer) / 2
    near = sorted(points, key=lambda v: abs(points[v]))[:4]
    drops = np.array([points[v] for v in near])
    with np.errstate(all="ignore"):
        root = sum(v * np.prod(np.delete(drops, i) / (np.delete(drops, i) - drops[i])) for i, v in enumerate(near))
    low, high = min(inner, outer), max(inner, outer)
    if not np.isfinite(root) or not low < root < high:
        root = middle
    tried = {middle, *(root + share * wide for share in (-1e-2, -1e-4, 0.0, 1e-4, 1e-2))}
    return sorted(float(v) for v in tried if low < v < high and v not in points)


def row_patterns(frame: DataFrame) -> DataFrame:
    """(y, x, n) counts of equal rows; ``frame`` has ``y`` and an array column ``x``."""
    return frame.groupBy("y", "x").agg(F.count("*").alias("n"))


def standardised(patterns: DataFrame, p: int) -> tuple[PatternSums, np.ndarray, np.ndarray, np.ndarray]:
    """Sums over [1, x] patterns with columns centred and scaled; also the centre, scale and Gram matrix."""
    sums = PatternSums(patterns, row_arrays)
    raw = sums(moments, p)
    n, totals, cross = raw[0], raw[1 : p + 1], raw[p + 1 :].reshape(p, p)
    centre = totals / n
    centre[0] = 0.0
    spread = np.sqrt(np.maximum(np.diag(cross) / n - centre**2, 0.0))
    spread[0] = 1.0
    usable = np.where(spread > 1e-12 * (1.0 + np.abs(centre)), spread, 1.0)
    sums.scale, sums.shift = usable, centre
    gram = sums(moments, p)[p + 1 :].reshape(p, p) / n
    return sums, centre, usable, gram


def full_rank(gram: np.ndarray, tolerance: float = 1e-9) -> bool:
    values = np.linalg.eigvalsh(gram)
    return bool(len(values)) and values.min() > tolerance * max(values.max(), 1e-300)


def original_scale(fit: Fit, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Coefficients, score and information for the columns before scaling."""
    return fit.beta / scale, fit.score * scale, fit.information * np.outer(scale, scale)
