"""Disclosure screening: small counts hide what they could reveal. Hidden numbers become null, with a flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import small_count
from ..session import any_true, local_rows

SUPPRESSED = "Suppressed"
PENDING = "suppressed_pending_disclosure_review"

# What stays visible of a hidden association, and the counts that can hide one.
ASSOCIATION_METADATA = (
    "model", "predictor", "method", "formula", "primary", "family", "status", "reason", "ci_method",
    "test_method", "conditioned_out_terms", "warnings", "engine_version",
)
ASSOCIATION_COUNTS = (
    "cases_analyzed", "controls_analyzed", "discordant_sets", "sets_removed", "rows_removed",
    "case_with_condition", "case_without_condition", "control_with_condition", "control_without_condition",
)
CHARACTERISTIC_METADATA = ("group", "variable", "level", "level_key", "statistic", "position")


def _small(value: Column) -> Column:
    return F.coalesce(small_count(value), F.lit(False))


def _hide(frame: DataFrame, unsafe: Column, keep: tuple) -> list[Column]:
    kind = {f.name: f.dataType for f in frame.schema}
    return [
        F.col(c) if c in keep else F.when(~unsafe, F.col(c)).cast(kind[c]).alias(c) for c in frame.columns
    ]


def screened_characteristics(table: DataFrame) -> DataFrame:
    """Hide a variable in both groups if any cell, complement or missing count of it is small."""
    small = _small(F.col("n")) | _small(F.col("denominator") - F.col("n"))
    if "missing" in table.columns:
        small = small | _small(F.col("missing"))
    # The table has one row per level: a window per variable is small.
    flagged = table.withColumn("suppressed", F.bool_or(small).over(Window.partitionBy("variable")))
    return flagged.select(*_hide(table, F.col("suppressed"), CHARACTERISTIC_METADATA), "suppressed")


def role_tables(members: DataFrame, predictors: list[str]) -> DataFrame:
    """The four cells of role by predictor over all members, every predictor in one pass."""
    entries = F.array(*[
        F.struct(F.lit(p).alias("predictor"), F.col(p).try_cast("double").alias("x")) for p in predictors
    ])
    rows = members.select("is_case", F.inline(entries))
    cells = [
        F.count_if((F.col("is_case") == role) & (F.col("x") == value)).alias(f"cell_{role}{value}")
        for role in (0, 1) for value in (0, 1)
    ]
    return rows.groupBy("predictor").agg(*cells)


def screened_associations(results: DataFrame, members: DataFrame, predictors: list[str]) -> DataFrame:
    """Hide a result if a cell over all members, or a count of its own sample, is small."""
    cells = role_tables(members, predictors)
    names = [c for c in cells.columns if c != "predictor"]
    counts = [c for c in ASSOCIATION_COUNTS if c in results.columns]
    unsafe = any_true([_small(F.col(c)) for c in (*names, *counts)])
    joined = results.join(F.broadcast(cells), "predictor", "left").withColumn("suppressed", unsafe)
    columns = _hide(results, F.col("suppressed"), ASSOCIATION_METADATA)
    at = results.columns.index("status")
    columns[at] = F.when(F.col("suppressed"), F.lit(PENDING)).otherwise(F.col("status")).alias("status")
    return joined.select(*columns, "suppressed")


def screened_flow(flow: DataFrame) -> DataFrame:
    """Hide all stages if any count, or any difference of two counts, is small. A flow has under ten rows."""
    other = flow.select(F.col("n").alias("other"))
    near = flow.join(F.broadcast(other), small_count(F.abs(F.col("n") - F.col("other"))) | small_count(F.col("n")))
    unsafe = near.agg((F.count("*") > 0).alias("suppressed"))
    return flow.join(F.broadcast(unsafe)).select(
        "position", "stage", F.when(~F.col("suppressed"), F.col("n")).alias("n"), "suppressed"
    )


def screened_group_sizes(sizes: DataFrame) -> DataFrame:
    small = _small(F.col("n"))
    return sizes.select("group", F.when(~small, F.col("n")).alias("n"), small.alias("suppressed"))


def screened_balance(balance: DataFrame, summary: DataFrame) -> DataFrame:
    """Absolute differences under display names, all hidden when few cases or controls were matched."""
    few = summary.select(
        (_small(F.col("matched_cases")) | _small(F.col("controls"))).alias("suppressed")
    )
    shown = balance.join(F.broadcast(few))
    open_ = ~F.col("suppressed")
    return shown.select(
        F.col("variable").alias("Variable"),
        F.when(open_, F.col("type")).alias("Type"),
        F.when(open_, F.abs("diff_before")).alias("Absolute SMD before"),
        F.when(open_, F.col("v_ratio_before")).alias("Variance ratio before"),
        F.when(open_, F.abs("diff_after")).alias("Absolute SMD after"),
        F.when(open_, F.col("v_ratio_after")).alias("Variance ratio after"),
        "suppressed",
    )


def full_flow(flow: DataFrame, summary: DataFrame) -> DataFrame:
    """The cohort flow with the two matched counts added at its end."""
    matched = summary.select(
        F.inline(
            F.array(
                F.struct(F.lit(5).alias("position"), F.lit("matched_cases").alias("stage"), F.col("matched_cases").alias("n")),
                F.struct(F.lit(6).alias("position"), F.lit("matched_controls").alias("stage"), F.col("controls").alias("n")),
            )
        )
    )
    return flow.unionByName(matched)


def flow_of(spark, counts: dict[str, int]) -> DataFrame:
    rows = [(i, stage, n) for i, (stage, n) in enumerate(counts.items())]
    return local_rows(spark, rows, "position int, stage string, n long")
