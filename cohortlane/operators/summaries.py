"""Descriptive summaries of matched people, before any screening.

The long result has one row per group, variable and level. All variables of one kind are summarised by one
aggregate over (variable, value) rows; quantiles come from value counts, so no task holds a whole group.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..config import CharacteristicSpec, ReportSpec, StudySpec, default_report_spec
from ..errors import DataContractError
from ..functions.scalars import FLOATING, parsed
from ..session import BROADCAST_ROWS, cut, local_rows, running_total

SUMMARY = (
    "group string, variable string, total long, level string, level_key string, statistic string, n long, "
    "denominator long, percent double, missing long, mean double, sd double, median double, q1 double, "
    "q3 double, position int"
)
COLUMNS = [f.split()[0] for f in SUMMARY.split(", ")]
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def _shape(frame: DataFrame) -> DataFrame:
    """Bring a partial summary to the common columns and types."""
    fields = T.StructType.fromDDL(SUMMARY).fields
    return frame.select(*[
        (F.col(f.name) if f.name in frame.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields
    ])


def distinct_people(members: DataFrame, columns: list[str]) -> DataFrame:
    """One row per person and role; with replacement a person repeats with equal features."""
    return members.select("person_id", "is_case", *columns).dropDuplicates(["is_case", "person_id"])


def group_name() -> Column:
    return F.when(F.col("is_case") == 1, "Cases").otherwise("Controls")


def _text(frame: DataFrame, name: str) -> Column:
    column = F.col(name)
    if isinstance(frame.schema[name].dataType, FLOATING):
        column = F.when(~F.isnan(column), column)
    return column.cast("string")


def categorical_summary(people: DataFrame, items: dict[str, CharacteristicSpec], positions: dict) -> DataFrame:
    """Counts of each combination of fields, missing values shown, with listed combinations grouped."""
    spark = people.sparkSession
    entries = F.array(*[
        F.struct(
            F.lit(name).alias("variable"),
            F.array(*[_text(people, f) for f in item.fields]).alias("key"),
        )
        for name, item in items.items()
    ])
    counts = (
        people.select(group_name().alias("group"), F.inline(entries))
        .groupBy("group", "variable", "key")
        .agg(F.count("*").alias("n"))
        .withColumn("raw", F.to_json("key"))
    )
    listed = [
        (name, list(value), g.label) for name, item in items.items() for g in item.groups for value in g.values
    ]
    groups = local_rows(spark, listed, "variable string, key array<string>, label string").select(
        "variable", F.to_json("key").alias("raw"), "label"
    )
    spelled = F.array_join(F.transform("key", lambda v: F.coalesce(v, F.lit("Missing"))), " / ")
    labelled = counts.join(F.broadcast(groups), ["variable", "raw"], "left").select(
        "group", "variable", "n",
        F.coalesce("label", spelled).alias("level"),
        F.to_json(
            F.array(F.when(F.col("label").isNotNull(), "group").otherwise("raw"), F.coalesce("label", "raw"))
        ).alias("level_key"),
    )
    levels = cut(labelled.groupBy("group", "variable", "level", "level_key").agg(F.sum("n").alias("n")))
    ambiguous = (
        levels.groupBy("variable", "level").agg(F.count_distinct("level_key").alias("kinds")).filter("kinds > 1")
    ).limit(5).collect()
    if ambiguous:
        raise DataContractError(f"Different source values share a label: {[(r[0], r[1]) for r in ambiguous]}")
    # One row per level from here on.
    whole = F.sum("n").over(Window.partitionBy("group", "variable"))
    return _shape(
        levels.withColumn("total", whole)
        .withColumn("denominator", F.col("total"))
        .withColumn("percent", 100.0 * F.col("n") / F.col("total"))
        .withColumn("statistic", F.lit("n_percent"))
        .withColumn("position", _position(positions))
    )


def _position(positions: dict) -> Column:
    mapping = F.create_map(*[F.lit(v) for pair in positions.items() for v in pair])
    return mapping[F.col("variable")]


def numeric_rows(people: DataFrame, items: dict[str, CharacteristicSpec]) -> DataFrame:
    """(group, variable, kind, x, bad): values as doubles; ``bad`` marks what is neither number nor missing."""
    entries = []
    for name, item in items.items():
        field = item.fields[0]
        text, value = _text(people, field), parsed(F.col(field))
        value = F.when(~F.isnan(value), value)
        infinite = F.abs(value) == float("inf")
        bad = (text.isNotNull() & value.isNull()) | F.coalesce(infinite, F.lit(False))
        if item.kind == "binary":
            bad = bad | F.coalesce(~value.isin(0.0, 1.0), F.lit(False))
        entries.append(
            F.struct(
                F.lit(name).alias("variable"), F.lit(item.kind).alias("kind"), value.alias("x"), bad.alias("bad")
            )
        )
    return people.select(group_name().alias("group"), F.inline(F.array(*entries)))


def quartiles(rows: DataFrame) -> DataFrame:
    """Linear-interpolated quartiles of ``x`` per (group, variable), exact at any size.

    Values are counted first. The running count over sorted values then shows which value holds each
    wanted rank. Few distinct values need only a window; many are summed across range partitions.
    """
    keys = ["group", "variable"]
    counts = cut(rows.filter("x is not null").groupBy(*keys, "x").agg(F.count("*").alias("c")))
    if counts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        upto = Window.partitionBy(*keys).orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = counts.withColumn("upto", F.sum("c").over(upto))
    else:
        ranked = running_total(counts, keys, [F.col("x").asc()], "c", "upto")
    sizes = ranked.groupBy(*keys).agg(F.max("upto").alias("size"))
    ranked = ranked.join(F.broadcast(sizes), keys)
    columns = []
    for name, q in QUARTILES.items():
        place = (F.col("size") - 1) * F.lit(q)
        for side, rank in (("lo", F.floor(place) + 1), ("hi", F.ceil(place) + 1)):
            holds = (F.col("upto") >= rank) & (F.col("upto") - F.col("c") < rank)
            columns.append(F.max(F.when(holds, F.col("x"))).alias(f"{name}_{side}"))
    found = ranked.groupBy(*keys, "size").agg(*columns)
    results = []
    for name, q in QUARTILES.items():
        place = (F.col("size") - 1) * F.lit(q)
        low, high = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        results.append((low + (high - low) * (place - F.floor(place))).alias(name))
    return found.select(*keys, *results)


def numeric_summary(people: DataFrame, items: dict[str, CharacteristicSpec], positions: dict) -> DataFrame:
    rows = numeric_rows(people, items)
    sums = cut(
        rows.groupBy("group", "variable", "kind").agg(
            F.count("*").alias("total"),
            F.count("x").alias("observed"),
            F.count_if(F.col("x") == 1).alias("ones"),
            F.count_if("bad").alias("bad"),
            F.avg("x").alias("mean"),
            F.stddev_samp("x").alias("sd"),
        )
    )
    bad = [r["variable"] for r in sums.filter("bad > 0").select("variable").distinct().collect()]
    if bad:
        raise DataContractError(f"Values that cannot be summarised in {sorted(bad)}")
    missing = (F.col("total") - F.col("observed")).alias("missing")
    empty = F.lit("").alias("level")
    binary = sums.filter("kind = 'binary'").select(
        "group", "variable", "total", empty, F.lit("binary").alias("statistic"), F.col("ones").alias("n"),
        F.col("observed").alias("denominator"), missing,
        F.when(F.col("observed") > 0, 100.0 * F.col("ones") / F.col("observed")).alias("percent"),
        _position(positions).alias("position"),
    )
    if not any(item.kind == "continuous" for item in items.values()):
        return _shape(binary)
    spread = quartiles(rows.filter("kind = 'continuous'"))
    continuous = (
        sums.filter("kind = 'continuous'")
        .join(F.broadcast(spread), ["group", "variable"], "left")
        .select(
            "group", "variable", "total", empty, F.lit("continuous").alias("statistic"),
            F.col("observed").alias("n"), F.col("total").alias("denominator"), missing, "mean",
            F.when(F.col("observed") > 1, F.col("sd")).alias("sd"), "median", "q1", "q3",
            _position(positions).alias("position"),
        )
    )
    return _shape(binary).unionByName(_shape(continuous))


def summarize_characteristics(members: DataFrame, spec: ReportSpec) -> DataFrame:
    """The long summary of every characteristic in the report definition."""
    fields = sorted({f for item in spec.characteristics.values() for f in item.fields})
    if set(fields) - set(members.columns):
        raise DataContractError(f"Summary fields are missing: {sorted(set(fields) - set(members.columns))}")
    people = distinct_people(members, [f for f in fields if f != "is_case"])
    positions = {name: i for i, name in enumerate(spec.characteristics)}
    categorical = {n: i for n, i in spec.characteristics.items() if i.kind == "categorical"}
    numeric = {n: i for n, i in spec.characteristics.items() if i.kind != "categorical"}
    with ThreadPoolExecutor(2) as pool:
        # Two independent passes; their jobs overlap.
        waiting = []
        if categorical:
            waiting.append(pool.submit(categorical_summary, people, categorical, positions))
        if numeric:
            waiting.append(pool.submit(numeric_summary, people, numeric, positions))
        parts = [w.result() for w in waiting]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def characteristics(members: DataFrame, study: StudySpec, spec: ReportSpec | None = None) -> DataFrame:
    return summarize_characteristics(members, spec or default_report_spec(study))


def group_sizes(members: DataFrame) -> DataFrame:
    """Distinct people per role."""
    return distinct_people(members, []).groupBy(group_name().alias("group")).agg(F.count("*").alias("n"))
