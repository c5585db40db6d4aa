"""Association models over matched sets: samples, attrition, conditional and Firth fits, Holm adjustment."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import ModelSpec
from ..errors import DataContractError
from ..functions.predicates import predicate_mask
from ..functions.scalars import is_missing, number_of
from ..session import all_true, cut
from . import estimation as est

RESULT = (
    "model string, predictor string, method string, formula string, primary boolean, family string, "
    "status string, reason string, odds_ratio double, ci_lower double, ci_upper double, p_value double, "
    "coefficient double, standard_error double, rows_before long, rows_analyzed long, sets_before long, "
    "sets_analyzed long, rows_removed long, sets_removed long, rows_removed_by_restriction long, "
    "cases_analyzed long, controls_analyzed long, case_with_condition long, case_without_condition long, "
    "control_with_condition long, control_without_condition long, discordant_sets long, "
    "conditioned_out_terms array<string>, score_max double, information_min_eigenvalue double, "
    "converged boolean, iterations int, ci_method string, test_method string, optimizer string, "
    "warnings array<string>"
)
FIELDS = [f.split()[0] for f in RESULT.split(", ")]

ATTRITION = (
    "rows_before", "rows_analyzed", "sets_before", "sets_analyzed", "rows_removed", "sets_removed",
    "rows_removed_by_restriction",
)

SCORE_LIMIT = 1e-3
EIGENVALUE_LIMIT = 1e-8


def terms_of(model: ModelSpec, predictor: str) -> list[str]:
    return [predictor, *model.covariates]


def packed_sets(members: DataFrame, model: ModelSpec, predictor: str) -> DataFrame:
    """One row per matched set with its row counts and its complete rows as small structs.

    One shuffle on the set id serves attrition, counts and the fit. A set has at most ratio + 1 rows.
    """
    terms = terms_of(model, predictor)
    if not set(terms) <= set(members.columns):
        raise DataContractError(f"Model columns are missing: {sorted(set(terms) - set(members.columns))}")
    kept = predicate_mask(members, model.restriction) if model.restriction else F.lit(True)
    numeric = [t for t in terms if t not in model.categorical]
    values = {t: number_of(members, t) for t in numeric}
    complete = all_true(
        [values[t].isNotNull() for t in numeric] + [~is_missing(members, t) for t in model.categorical]
    )
    row = F.struct(
        F.col("is_case").cast("int").alias("is_case"),
        F.array(*[values[t] for t in numeric]).alias("x"),
        (F.array(*[F.col(t).cast("string") for t in model.categorical]) if model.categorical
         else F.array().cast("array<string>")).alias("levels"),
    )
    usable = kept & complete
    packed = members.groupBy("match_set_id").agg(
        F.count("*").alias("n"),
        F.count_if(kept).alias("n_kept"),
        F.collect_list(F.when(usable, row)).alias("rows"),
    )
    cases = F.aggregate("rows", F.lit(0), lambda total, r: total + r["is_case"])
    return packed.withColumn("good", (cases == 1) & (F.size("rows") >= 2))


def attrition(packed: DataFrame) -> DataFrame:
    """Rows and sets before, analysed and removed, counted from the members before any restriction."""
    counts = packed.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.count("*").alias("sets_before"),
        F.coalesce(F.sum(F.col("n") - F.col("n_kept")), F.lit(0)).alias("rows_removed_by_restriction"),
        F.coalesce(F.sum(F.when(F.col("good"), F.size("rows"))), F.lit(0)).alias("rows_analyzed"),
        F.count_if("good").alias("sets_analyzed"),
    )
    return counts.select(
        "rows_before", "rows_analyzed", "sets_before", "sets_analyzed",
        (F.col("rows_before") - F.col("rows_analyzed")).alias("rows_removed"),
        (F.col("sets_before") - F.col("sets_analyzed")).alias("sets_removed"),
        "rows_removed_by_restriction",
    )


def sample_counts(packed: DataFrame) -> DataFrame:
    """Cases, controls, the 2x2 table, discordant sets, and rows whose predictor is not 0/1."""

    def counted(test) -> Column:
        return F.coalesce(F.sum(F.size(F.filter("rows", test))), F.lit(0))

    def cell(role: int, value: int):
        return lambda r: (r["is_case"] == role) & (r["x"][0] == value)

    predictors = F.transform("rows", lambda r: r["x"][0])
    return packed.filter("good").agg(
        counted(lambda r: r["is_case"] == 1).alias("cases_analyzed"),
        counted(lambda r: r["is_case"] == 0).alias("controls_analyzed"),
        counted(cell(1, 1)).alias("case_with_condition"),
        counted(cell(1, 0)).alias("case_without_condition"),
        counted(cell(0, 1)).alias("control_with_condition"),
        counted(cell(0, 0)).alias("control_without_condition"),
        F.count_if(F.array_min(predictors) < F.array_max(predictors)).alias("discordant_sets"),
        counted(lambda r: ~r["x"][0].isin(0.0, 1.0)).alias("not_binary"),
    )


def level_lists(packed: DataFrame, model: ModelSpec) -> list[list[str]]:
    """Sorted levels of each categorical term in the analysed rows: as many terms of the model."""
    if not model.categorical:
        return []
    rows = packed.filter("good").select(F.explode("rows").alias("r"))
    found = rows.select(F.posexplode("r.levels").alias("at", "level")).distinct().collect()
    return [sorted(r["level"] for r in found if r["at"] == i) for i in range(len(model.categorical))]


def design(packed: DataFrame, model: ModelSpec, predictor: str, levels: list[list[str]]):
    """Good sets with numeric rows only (indicators after the numeric terms), and the column names."""
    names = [t for t in terms_of(model, predictor) if t not in model.categorical]
    indicators = []
    for i, term in enumerate(model.categorical):
        for level in levels[i][1:]:
            indicators.append((i, level))
            names.append(f"{term}_{level}")

    def numeric(row):
        x = row["x"]
        if indicators:
            marks = F.array(*[(row["levels"][i] == level).cast("double") for i, level in indicators])
            x = F.concat(x, marks)
        return F.struct(row["is_case"].alias("is_case"), x.alias("x"))

    return packed.filter("good").select(F.transform("rows", numeric).alias("rows")), names


def set_patterns(sets: DataFrame) -> DataFrame:
    """Equal sets counted together: the controls' values minus the case's, in sorted order, flattened."""
    case = F.filter("rows", lambda r: r["is_case"] == 1)[0]["x"]
    controls = F.filter("rows", lambda r: r["is_case"] == 0)
    gaps = F.transform(controls, lambda r: F.zip_with(r["x"], case, lambda a, b: a - b))
    return sets.select(F.flatten(F.array_sort(gaps)).alias("x")).groupBy("x").agg(F.count("*").alias("n"))


def _estimated(beta, low, high, p, **more) -> dict:
    return {
        "status": "estimated", "coefficient": beta, "odds_ratio": math.exp(beta), "ci_lower": math.exp(low),
        "ci_upper": math.exp(high), "p_value": p, **more,
    }


def _bounded(*values) -> bool:
    return all(math.isfinite(v) and abs(v) < 709.0 for v in values)


def conditional_result(sets: DataFrame, names: list[str], predictor: str, iterations: int) -> dict:
    width = len(names)
    sums = est.PatternSums(set_patterns(sets), lambda rows: est.set_arrays(rows, width))
    rows, *squared = sums(est.squares, width)
    squared = np.array(squared)
    invariant = [name for name, value in zip(names, squared) if value == 0]
    result = {"conditioned_out_terms": invariant}
    if predictor in invariant:
        return {**result, "reason": "predictor_conditioned_out"}
    keep = [i for i in range(width) if squared[i] > 0]
    scale = np.sqrt(squared[keep] / rows)
    # Invariant terms are zero everywhere: leave their columns out of the sums.
    sums.index, sums.scale = np.array(keep), scale
    p = len(keep)
    gram = sums(est.centred_gram, p).reshape(p, p)
    if not est.full_rank(gram):
        return {**result, "reason": "rank_deficient_conditional_design"}
    fit = est.fit_conditional(sums, p, iterations)
    beta, score, information = est.original_scale(fit, scale)
    eigenvalues = np.linalg.eigvalsh(information) if np.isfinite(information).all() else np.array([-1.0])
    at = keep.index(names.index(predictor))
    result.update(
        score_max=float(np.abs(score).max()),
        information_min_eigenvalue=float(eigenvalues.min()),
        converged=fit.converged,
        iterations=fit.iterations,
        ci_method="wald_pointwise",
        test_method="wald",
        optimizer="newton",
        warnings=[],
    )
    unstable = {**result, "reason": "unstable_or_nonconverged_conditional_fit"}
    if not fit.converged or result["score_max"] > SCORE_LIMIT or eigenvalues.min() <= EIGENVALUE_LIMIT:
        return unstable
    variance = np.linalg.inv(information)[at, at]
    if not (np.isfinite(variance) and variance > 0 and np.isfinite(beta[at])):
        return unstable
    estimate, error = float(beta[at]), float(np.sqrt(variance))
    half = NormalDist().inv_cdf(0.975) * error
    if not _bounded(estimate, estimate - half, estimate + half):
        return {**result, "reason": "unbounded_exponentiated_interval"}
    tail = math.erfc(abs(estimate / error) / math.sqrt(2.0))
    return {**result, **_estimated(estimate, estimate - half, estimate + half, tail, standard_error=error)}


def firth_result(sets: DataFrame, names: list[str], predictor: str, iterations: int) -> dict:
    rows = sets.select(F.explode("rows").alias("r")).select(
        F.col("r.is_case").cast("double").alias("y"),
        F.concat(F.array(F.lit(1.0)), F.col("r.x")).alias("x"),
    )
    p = len(names) + 1
    sums, _, scale, gram = est.standardised(est.row_patterns(rows), p)
    if not est.full_rank(gram):
        return {"reason": "rank_deficient_firth_design"}
    at = 1 + names.index(predictor)
    best = est.fit_firth(sums, p, iterations)
    result = {
        "ci_method": "profile_penalized_likelihood",
        "test_method": "penalized_likelihood_ratio",
        "optimizer": "newton",
        "converged": best.converged,
        "iterations": best.iterations,
    }
    if not np.isfinite(best.value) or not np.isfinite(best.beta).all():
        return {**result, "reason": "firth_interval_or_fit_failed"}
    if not best.converged:
        return {**result, "reason": "firth_engine_warning_requires_review"}
    try:
        spread = np.sqrt(np.linalg.inv(best.information)[at, at])
        null = est.fit_firth(sums, p, iterations, fixed=(at, 0.0), start=best.beta)
        low, high = est.profile_interval(sums, best, at, 2 * spread, iterations)
    except np.linalg.LinAlgError:
        return {**result, "reason": "firth_interval_or_fit_failed"}
    except est.NotConverged:
        return {**result, "reason": "firth_engine_warning_requires_review"}
    ratio = max(0.0, 2 * (best.value - null.value))
    beta, low, high = (float(v / scale[at]) for v in (best.beta[at], low, high))
    if not all(map(math.isfinite, (beta, low, high, ratio))):
        return {**result, "reason": "firth_interval_or_fit_failed"}
    if not null.converged:
        return {**result, "reason": "firth_engine_warning_requires_review"}
    if not _bounded(beta, low, high):
        return {**result, "reason": "unbounded_exponentiated_interval"}
    return {**result, **_estimated(beta, low, high, math.erfc(math.sqrt(ratio / 2)))}


def require_single_use(members: DataFrame) -> None:
    if members.groupBy("person_id").count().filter("count > 1").limit(1).count():
        raise DataContractError("People used in several sets cannot be modelled; match without replacement.")


def fit_model(members: DataFrame, model: ModelSpec, predictor: str, *, checked: bool = False) -> dict:
    """One model row as a dict over ``FIELDS``; a model that cannot be estimated carries its reason."""
    if not checked:
        require_single_use(members)
    packed = cut(packed_sets(members, model, predictor))
    # Two frames of one row each, stacked so that one job evaluates both.
    first, second = (f.unpivot([], f.columns, "name", "n") for f in (sample_counts(packed), attrition(packed)))
    counts = {r["name"]: r["n"] for r in first.unionByName(second).collect()}
    lost = {name: counts.pop(name) for name in ATTRITION}
    result = dict.fromkeys(FIELDS)
    result.update(
        model=model.name, predictor=predictor, method=model.method, primary=model.primary, family=model.family,
        formula="is_case ~ " + " + ".join(terms_of(model, predictor)), status="non_estimable",
        **lost,
    )
    if counts.pop("not_binary"):
        raise DataContractError(f"The predictor {predictor} takes values other than 0 and 1.")
    discordant = counts.pop("discordant_sets")
    result.update(counts)
    ones = counts["case_with_condition"] + counts["control_with_condition"]
    zeros = counts["case_without_condition"] + counts["control_without_condition"]
    if not ones or not zeros:
        return {**result, "reason": "empty_sample_or_constant_predictor"}
    result["discordant_sets"] = discordant
    levels = level_lists(packed, model)
    if model.method == "firth" and any(len(found) < 2 for found in levels):
        return {**result, "reason": "constant_categorical_adjustment_term"}
    if model.method == "conditional" and discordant == 0:
        return {**result, "reason": "no_within_set_predictor_information"}
    sets, names = design(packed, model, predictor, levels)
    fit = firth_result if model.method == "firth" else conditional_result
    failed = "firth_interval_or_fit_failed" if model.method == "firth" else "conditional_fit_failed"
    try:
        return {**result, **fit(sets, names, predictor, model.max_iterations)}
    except (np.linalg.LinAlgError, OverflowError, FloatingPointError):
        return {**result, "reason": failed}


def holm(results: DataFrame) -> DataFrame:
    """Step-down adjustment within each family of primary rows.

    A missing p-value counts as 1 and keeps its place, but its own adjusted value stays missing.
    """
    family = Window.partitionBy("family", "primary")
    p = F.coalesce(F.when(~F.isnan("p_value"), F.col("p_value")), F.lit(1.0))
    ranked = results.withColumn("_p", p).withColumn("_m", F.count("*").over(family))
    order = family.orderBy("_p", "model", "predictor")
    ranked = ranked.withColumn("_step", (F.col("_m") - F.row_number().over(order) + 1) * F.col("_p"))
    running = F.max("_step").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    known = F.col("p_value").isNotNull() & ~F.isnan("p_value")
    return ranked.select(
        *results.columns,
        F.when(F.col("primary") & known, F.least(running, F.lit(1.0))).alias("p_holm"),
        F.when(F.col("primary"), F.col("_m")).alias("family_size"),
    )


def fit_models(members: DataFrame, models: tuple, *, threads: int = 4) -> DataFrame:
    """All model and predictor pairs, adjusted. Pairs are independent, so their jobs overlap."""
    require_single_use(members)
    pairs = [(model, predictor) for model in models for predictor in model.predictors]
    with ThreadPoolExecutor(threads) as pool:
        rows = list(pool.map(lambda pair: fit_model(members, *pair, checked=True), pairs))
    table = members.sparkSession.createDataFrame([tuple(r[f] for f in FIELDS) for r in rows], RESULT)
    return holm(table)
