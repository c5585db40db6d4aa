"""Covariate balance before and after matching.

Differences are standardised by the standard deviation of the cases in the full valid pool, before and
after alike. Variance ratios are case over control, for continuous columns only; the weighted variance is
``sum w (x - m)^2 * sum w / ((sum w)^2 - sum w^2)``. A factor has one row per level, a two-level factor one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import MatchSpec
from ..session import cut

SCHEMA = (
    "variable string, type string, diff_before double, v_ratio_before double, diff_after double, "
    "v_ratio_after double"
)


def person_weights(members: DataFrame) -> DataFrame:
    """Total weight per person; a control may sit in several sets."""
    return members.groupBy("person_id").agg(F.sum("weight").alias("w"))


def weighted_pool(pool: DataFrame, members: DataFrame, spec: MatchSpec) -> DataFrame:
    columns = spec.columns()
    rows = pool.filter("valid").select("person_id", "is_case", *columns)
    return rows.join(person_weights(members), "person_id", "left").withColumn("w", F.coalesce("w", F.lit(0.0)))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom != 0, top / bottom)


def _long_numeric(frame: DataFrame, names: list[str]) -> DataFrame:
    entries = F.array(*[
        F.struct(F.lit(n).alias("variable"), F.col(n).cast("double").alias("x")) for n in names
    ])
    return frame.select("is_case", "w", F.inline(entries))


def numeric_balance(frame: DataFrame, names: list[str]) -> DataFrame:
    """One row per numeric column. Values are shifted by the column mean before squaring."""
    rows = _long_numeric(frame, names)
    facts = F.broadcast(rows.groupBy("variable").agg(F.avg("x").alias("centre"), F.min("x").alias("lo"), F.max("x").alias("hi")))
    rows = rows.join(facts, "variable").withColumn("d", F.col("x") - F.col("centre"))
    case, control = F.col("is_case") == 1, F.col("is_case") == 0
    sums = [F.count_if((F.col("x") != F.col("lo")) & (F.col("x") != F.col("hi"))).alias("between")]
    for role, test in (("1", case), ("0", control)):
        d, w = F.when(test, F.col("d")), F.when(test, F.col("w"))
        sums += [
            F.avg(d).alias(f"mean{role}"),
            F.var_samp(d).alias(f"var{role}"),
            F.avg(F.when(test, (F.col("x") == F.col("hi")).cast("double"))).alias(f"share{role}"),
            F.sum(w).alias(f"w{role}"),
            F.sum(w * w).alias(f"ww{role}"),
            F.sum(w * d).alias(f"wd{role}"),
            F.sum(w * d * d).alias(f"wdd{role}"),
        ]
    sums += [F.min("lo").alias("low"), F.max("hi").alias("high")]
    s = rows.groupBy("variable").agg(*sums)
    binary = (F.col("between") == 0) & (F.col("low") < F.col("high"))
    share = F.col("share1")
    spread = F.when(binary, F.sqrt(share * (1 - share)) * (F.col("high") - F.col("low"))).otherwise(F.sqrt("var1"))

    def weighted_variance(role: str) -> Column:
        w, ww, wd, wdd = (F.col(f"{n}{role}") for n in ("w", "ww", "wd", "wdd"))
        return _ratio((wdd - wd * wd / w) * w, w * w - ww)

    return s.select(
        "variable",
        F.when(F.col("low") == F.col("high"), "Constant").when(binary, "Binary").otherwise("Contin.").alias("type"),
        _ratio(F.col("mean1") - F.col("mean0"), spread).alias("diff_before"),
        F.when(~binary, _ratio(F.col("var1"), F.col("var0"))).alias("v_ratio_before"),
        _ratio(_ratio(F.col("wd1"), F.col("w1")) - _ratio(F.col("wd0"), F.col("w0")), spread).alias("diff_after"),
        F.when(~binary, _ratio(weighted_variance("1"), weighted_variance("0"))).alias("v_ratio_after"),
    )


def factor_balance(frame: DataFrame, names: list[str]) -> DataFrame:
    """One row per level, from counts and weight totals per (column, level)."""
    entries = F.array(*[
        F.struct(F.lit(n).alias("name"), F.col(n).cast("string").alias("level")) for n in names
    ])
    rows = frame.select("is_case", "w", F.inline(entries))
    case = F.col("is_case") == 1
    levels = rows.groupBy("name", "level").agg(
        F.count_if(case).alias("n1"), F.count_if(~case).alias("n0"),
        F.sum(F.when(case, F.col("w")).otherwise(0.0)).alias("w1"),
        F.sum(F.when(case, 0.0).otherwise(F.col("w"))).alias("w0"),
    )
    # From here on there is one row per level.
    whole = Window.partitionBy("name")
    share = {c: F.col(c) / F.sum(c).over(whole) for c in ("n1", "n0", "w1", "w0")}
    spread = F.sqrt(share["n1"] * (1 - share["n1"]))
    count = F.count("*").over(whole)
    rank = F.row_number().over(whole.orderBy("level"))
    shown = levels.select(
        "name", "level", count.alias("levels"), rank.alias("rank"),
        _ratio(share["n1"] - share["n0"], spread).alias("before"),
        _ratio(share["w1"] - share["w0"], spread).alias("after"),
    ).filter("levels <> 2 or rank = 2")
    constant = F.col("levels") == 1
    nothing = F.lit(None).cast("double")
    return shown.select(
        F.when(constant, F.col("name")).otherwise(F.concat_ws("_", "name", "level")).alias("variable"),
        F.when(constant, "Constant").otherwise("Binary").alias("type"),
        F.when(~constant, F.col("before")).alias("diff_before"),
        nothing.alias("v_ratio_before"),
        F.when(~constant, F.col("after")).alias("diff_after"),
        nothing.alias("v_ratio_after"),
    )


def balance_table(pool: DataFrame, members: DataFrame, spec: MatchSpec) -> DataFrame:
    """Rows of ``SCHEMA``. The weighted pool is joined once and written; each part then scans only its columns."""
    frame = cut(weighted_pool(pool, members, spec))
    factors = [n for n in spec.columns() if n in (*spec.exact, *spec.categorical)]
    numeric = [n for n in spec.columns() if n not in factors]
    parts = []
    if numeric:
        table = numeric_balance(frame, numeric)
        blank = F.col("type") == "Constant"
        measures = ["diff_before", "v_ratio_before", "diff_after", "v_ratio_after"]
        parts.append(table.select("variable", "type", *[F.when(~blank, F.col(m)).alias(m) for m in measures]))
    if factors:
        parts.append(factor_balance(frame, factors))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
