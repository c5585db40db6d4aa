"""Publication tables made from screened results, their selection, and the check that nothing is missing.

Everything here works on screened report tables of at most a few hundred rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import PublicationSpec
from ..errors import DataContractError
from ..functions.scalars import (
    count_percent, fixed, fraction_percent, p_text, sentence_label, significant, title_label,
)
from ..session import local_rows
from .provenance import methods_present
from .screening import PENDING, SUPPRESSED

ABSENT = "Not available"
NOT_ESTIMABLE = "Not estimable"
STATUS_TEXT = {"estimated": "Estimated", "non_estimable": NOT_ESTIMABLE, PENDING: "Suppressed"}
CHARACTERISTIC_COLUMNS = ("Characteristic", "Cases", "Controls")

# The summaries each statistic offers, in display order, with their row suffix.
OFFERED = {
    "n_percent": (("n_percent", None),),
    "binary": (("n_percent", "Recorded, n/N (%)"), ("missing", "Observed / missing")),
    "continuous": (
        ("mean_sd", "Mean (SD)"), ("median_iqr", "Median [Q1, Q3]"), ("missing", "Observed / missing"),
    ),
}


def labelled(column: Column, labels: dict[str, str]) -> Column:
    if not labels:
        return title_label(column)
    mapping = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.coalesce(mapping[column], title_label(column))


def _statistic(value: Column, decimals: int) -> Column:
    return F.coalesce(fixed(value, decimals), F.lit(ABSENT))


def _pair(left: Column, right: Column) -> Column:
    return F.concat(left.cast("long").cast("string"), F.lit(" / "), right.cast("long").cast("string"))


def _check_selection(table: DataFrame, summaries: dict) -> None:
    if not summaries:
        return
    rows = table.select("variable", "statistic").distinct().collect()
    offered: dict[str, set] = {}
    for row in rows:
        offered.setdefault(row["variable"], set()).update(s for s, _ in OFFERED[row["statistic"]])
    for variable, wanted in summaries.items():
        if variable not in offered:
            raise DataContractError(f"Unknown characteristic in the summary selection: {variable}")
        if not wanted or set(wanted) - offered[variable]:
            raise DataContractError(f"{variable} does not offer {sorted(set(wanted) - offered[variable])}")


def publication_characteristics(
    table: DataFrame, labels: dict, *, decimals: int = 1, percent_decimals: int = 1, summaries: dict | None = None
) -> DataFrame:
    """One display row per variable, summary and level, cases and controls side by side.

    Keeps the identifying columns ``variable`` and ``summary`` beside the three display columns.
    """
    summaries = summaries or {}
    _check_selection(table, summaries)
    hidden = F.col("suppressed")
    if "level_key" not in table.columns:
        table = table.withColumn("level_key", F.lit(None).cast("string"))
    if "position" not in table.columns:
        table = table.withColumn("position", F.lit(0))

    def stat(name):
        return _statistic(F.col(name), decimals)

    level_text = count_percent(F.col("n"), F.col("percent"), percent_decimals)
    texts = {
        ("n_percent", "n_percent"): level_text,
        ("binary", "n_percent"): F.when(F.col("denominator") == 0, F.lit(ABSENT)).otherwise(
            fraction_percent(F.col("n"), F.col("denominator"), F.col("percent"), percent_decimals)
        ),
        ("continuous", "mean_sd"): F.concat(stat("mean"), F.lit(" ("), stat("sd"), F.lit(")")),
        ("continuous", "median_iqr"): F.concat(
            stat("median"), F.lit(" ["), stat("q1"), F.lit(", "), stat("q3"), F.lit("]")
        ),
        ("binary", "missing"): _pair(F.col("denominator"), F.col("missing")),
        ("continuous", "missing"): _pair(F.col("n"), F.col("missing")),
    }
    known = set(table.columns)
    needs = {"continuous": {"mean", "sd", "median", "q1", "q3", "missing"}, "binary": {"missing"}, "n_percent": set()}
    entries = []
    for statistic, offered in OFFERED.items():
        if not needs[statistic] <= known:
            continue
        for rank, (summary, suffix) in enumerate(offered):
            entries.append(
                F.when(
                    F.col("statistic") == statistic,
                    F.struct(
                        F.lit(summary).alias("summary"), F.lit(rank).alias("rank"),
                        (F.col("level") if suffix is None else F.lit(suffix)).alias("suffix"),
                        F.when(hidden, F.lit(SUPPRESSED)).otherwise(texts[statistic, summary]).alias("text"),
                    ),
                )
            )
    long = table.select(
        "variable", "group", "position", F.coalesce("level_key", "level").alias("level_key"),
        F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull())),
    )
    for variable, wanted in summaries.items():
        long = long.filter((F.col("variable") != variable) | F.col("summary").isin(*wanted))
    key = ["variable", "summary", "level_key", "suffix", "rank", "position"]
    side = {g: F.max(F.when(F.col("group") == g, F.col("text"))) for g in ("Cases", "Controls")}
    most = F.greatest(*[F.count_if(F.col("group") == g) for g in side])
    wide = long.groupBy(*key).agg(*[c.alias(g) for g, c in side.items()], most.alias("repeats"))
    if wide.filter("repeats > 1").limit(1).count():
        raise DataContractError("A characteristic row appears twice in the report.")
    other = F.coalesce("Cases", "Controls")
    fill = F.when(other == SUPPRESSED, SUPPRESSED).otherwise(f"0 ({0:.{percent_decimals}f}%)")
    order = Window.orderBy("position", "variable", "rank", "level_key")
    return wide.select(
        F.row_number().over(order).alias("row"),
        "variable", "summary",
        F.concat(labelled(F.col("variable"), labels), F.lit(": "), F.col("suffix")).alias("Characteristic"),
        F.coalesce("Cases", fill).alias("Cases"),
        F.coalesce("Controls", fill).alias("Controls"),
    )


def _number(value: Column, hidden: Column, decimals: int | None, *, p: bool = False) -> Column:
    shown = p_text(value) if p else (significant(value) if decimals is None else fixed(value, decimals))
    missing = value.isNull() | F.isnan(value)
    return F.when(hidden, SUPPRESSED).when(missing, NOT_ESTIMABLE).otherwise(shown)


def _fraction(n: Column, total: Column, hidden: Column, decimals: int) -> Column:
    text = fraction_percent(n, total, 100.0 * n / F.nullif(total, F.lit(0)), decimals)
    return F.when(hidden, SUPPRESSED).otherwise(F.coalesce(text, F.lit(ABSENT)))


def publication_associations(
    table: DataFrame, labels: dict, *, decimals: int | None = None, percent_decimals: int = 1, numeric: bool = False
) -> DataFrame:
    """Display columns of each model result. ``numeric`` keeps estimates and p-values as numbers."""
    if table.groupBy("model", "predictor").count().filter("count > 1").limit(1).count():
        raise DataContractError("A model result appears twice in the report.")
    hidden = F.col("suppressed")
    ratio, low, high = F.col("odds_ratio"), F.col("ci_lower"), F.col("ci_upper")

    def shown(value, *, p=False):
        return value if numeric else _number(value, hidden, decimals, p=p)

    def text(value):
        return _number(value, hidden, decimals)

    interval = F.when(text(low).isin(SUPPRESSED, NOT_ESTIMABLE), text(low)).otherwise(
        F.concat(text(low), F.lit(" to "), text(high))
    )
    holm = shown(F.col("p_holm"), p=True)
    if not numeric:
        holm = F.when(F.col("primary"), holm).otherwise("Not primary")
    status = F.create_map(*[F.lit(x) for pair in STATUS_TEXT.items() for x in pair])
    columns = [
        F.col("model").alias("model_id"), F.col("predictor").alias("predictor_id"), "primary",
        F.col("status").alias("status_id"),
        labelled(F.col("model"), labels).alias("Model"),
        labelled(F.col("predictor"), labels).alias("Condition"),
        F.coalesce(status[F.col("status")], F.col("status")).alias("Status"),
        shown(ratio).alias("OR"),
        interval.alias("95% CI"),
        shown(F.col("p_value"), p=True).alias("P"),
        holm.alias("Holm P"),
        F.col("cases_analyzed").alias("Cases"),
        F.col("controls_analyzed").alias("Controls"),
        F.col("sets_analyzed").alias("Matched sets"),
        _fraction(F.col("case_with_condition"), F.col("cases_analyzed"), hidden, percent_decimals).alias(
            "Condition in sampled cases"
        ),
        _fraction(F.col("control_with_condition"), F.col("controls_analyzed"), hidden, percent_decimals).alias(
            "Condition in sampled controls"
        ),
    ]
    if numeric:
        both = F.concat(text(ratio), F.lit(" ("), text(low), F.lit(" to "), text(high), F.lit(")"))
        plain = text(ratio)
        columns.append(F.when(plain.isin(SUPPRESSED, NOT_ESTIMABLE), plain).otherwise(both).alias("OR (95% CI)"))
    return table.select(*columns)


def publication_flow(flow: DataFrame) -> DataFrame:
    count = F.when(F.col("suppressed"), SUPPRESSED).otherwise(F.col("n").cast("string"))
    return flow.select(
        (F.col("position") + 1).alias("row"), sentence_label(F.col("stage")).alias("Stage"), count.alias("Participants")
    )


def ordered_by(frame: DataFrame, column: str, order: tuple, position: str) -> DataFrame:
    """Listed values first in the given order, others after them in source order; ``position`` is renewed."""
    if not order:
        return frame
    ranks = local_rows(
        frame.sparkSession, [(v, i) for i, v in enumerate(order)], f"`{column}` string, _rank int"
    )
    ranked = frame.join(F.broadcast(ranks), column, "left")
    place = Window.orderBy(F.coalesce("_rank", F.lit(len(order))), position)
    return ranked.withColumn(position, F.row_number().over(place)).select(*frame.columns)


@dataclass
class Report:
    """Screened tables of one study. ``tables`` are for display, ``screened`` keep numbers for revisions.

    ``methods`` holds what the stages did and the review status, as rows of ``provenance.SCHEMA``.
    """

    tables: dict[str, DataFrame]
    screened: dict[str, DataFrame] = field(default_factory=dict)
    metadata: dict = field(default_factory=dict)
    methods: DataFrame | None = None


@dataclass(frozen=True)
class TableSelection:
    """What one published table shows of a report."""

    name: str
    table: str
    report: str = "main"
    variables: tuple = ()
    models: tuple = ()
    columns: tuple = ()
    summaries: dict = field(default_factory=dict)
    column_labels: dict = field(default_factory=dict)
    group_sizes: bool = False


@dataclass(frozen=True)
class DisplayFormat:
    descriptive_decimals: int = 1
    percent_decimals: int = 1
    estimate_decimals: int = 2
    characteristic_order: tuple = ()
    condition_order: tuple = ()
    labels: dict = field(default_factory=dict)


IDENTITY = ("row", "variable", "summary", "model_id", "predictor_id", "primary", "status_id")


def _missing(frame: DataFrame, column: str, wanted: tuple) -> list:
    found = {r[0] for r in frame.select(column).distinct().collect()}
    return sorted(set(wanted) - found)


def select_table(report: Report, selection: TableSelection, display: DisplayFormat = DisplayFormat()) -> DataFrame:
    """The chosen rows and columns of a screened table. Unknown names are errors; hiding came before."""
    labels = {**report.metadata.get("labels", {}), **display.labels}
    name = selection.table
    if name == "characteristics" and name in report.screened:
        source = report.screened[name]
        if selection.variables:
            absent = _missing(source, "variable", selection.variables)
            if absent:
                raise DataContractError(f"The report has no characteristics {absent}")
            source = source.filter(F.col("variable").isin(*selection.variables))
        if "position" not in source.columns:
            source = source.withColumn("position", F.monotonically_increasing_id())
        source = _ordered_variables(source, display.characteristic_order)
        source = _ordered_variables(source, selection.variables)
        table = publication_characteristics(
            source, labels, decimals=display.descriptive_decimals, percent_decimals=display.percent_decimals,
            summaries=selection.summaries,
        )
    elif name == "associations" and name in report.screened:
        source = report.screened[name]
        if selection.models:
            absent = _missing(source, "model", selection.models)
            if absent:
                raise DataContractError(f"The report has no models {absent}")
            source = source.filter(F.col("model").isin(*selection.models))
        order = Window.orderBy("model", "predictor")
        source = source.withColumn("row", F.row_number().over(order))
        source = ordered_by(source, "model", selection.models, "row")
        source = ordered_by(source, "predictor", display.condition_order, "row")
        table = publication_associations(
            source, labels, decimals=display.estimate_decimals, percent_decimals=display.percent_decimals, numeric=True
        )
        places = source.select(F.col("model").alias("model_id"), F.col("predictor").alias("predictor_id"), "row")
        table = table.join(F.broadcast(places), ["model_id", "predictor_id"])
    elif selection.models or selection.variables or selection.summaries:
        raise DataContractError("This report holds no numbers to select from.")
    else:
        table = report.tables[name]
    if table.limit(1).count() == 0:
        raise DataContractError(f"Nothing is left for {selection.name}.")
    visible = [c for c in table.columns if c not in IDENTITY]
    columns = list(selection.columns or visible)
    unknown = (set(columns) | set(selection.column_labels)) - set(visible)
    if unknown:
        raise DataContractError(f"Unknown report columns {sorted(unknown)}")
    if set(selection.column_labels) - set(columns):
        raise DataContractError("A renamed column is not selected.")
    if len({selection.column_labels.get(c, c) for c in columns}) != len(columns):
        raise DataContractError("Displayed column names repeat.")
    if name == "associations" and "Model" not in columns and "model_id" in table.columns:
        if table.select("model_id").distinct().limit(2).count() > 1:
            raise DataContractError("Several models need the Model column.")
    if selection.group_sizes and set(report.metadata.get("group_sizes", {})) != {"Cases", "Controls"}:
        raise DataContractError("This report has no group sizes.")
    identity = [c for c in table.columns if c in IDENTITY]
    return table.select(*identity, *[F.col(f"`{c}`") for c in columns])


def _ordered_variables(source: DataFrame, order: tuple) -> DataFrame:
    if not order:
        return source
    mapping = F.create_map(*[F.lit(x) for pair in ((v, i) for i, v in enumerate(order)) for x in pair])
    place = F.coalesce(mapping[F.col("variable")], F.lit(len(order)))
    rank = F.dense_rank().over(Window.orderBy(place, "position"))
    return source.withColumn("position", rank)


def combined_methods(reports: dict[str, Report]) -> DataFrame:
    """What the stages of several studies did, under each other; a report without methods is an error."""
    lacking = sorted(k for k, r in reports.items() if r.methods is None)
    if lacking or not reports:
        raise DataContractError(f"Reports without methods: {lacking}")
    parts = [r.methods.select(F.lit(k).alias("report"), "*") for k, r in reports.items()]
    return reduce(DataFrame.unionByName, parts)


def combine_reports(reports: dict[str, Report], name: str) -> DataFrame:
    """One table of several studies under each other, never pooled; synthetic and real do not mix."""
    if not reports:
        raise DataContractError("Give at least one report.")
    if len({bool(r.metadata.get("synthetic")) for r in reports.values()}) > 1:
        raise DataContractError("Synthetic and real reports are published apart.")
    result = None
    for key, report in reports.items():
        part = report.tables[name].select(F.lit(key).alias("report"), "*")
        result = part if result is None else result.unionByName(part, allowMissingColumns=True)
    return result


METHODS_SHEET = "Methods"
LEDGER = (
    "report string, kind string, item string, detail string, sheet string, columns array<string>, "
    "status string, primary boolean"
)


def content_ledger(
    reports: dict[str, Report], prepared: list[tuple[TableSelection, DataFrame]], spark
) -> DataFrame:
    """What the selected tables hold: one row per summary, model result, table and identity fact."""
    parts = []

    def add(frame, report, kind, item, detail, sheet, columns, status=F.lit(None), primary=F.lit(None)):
        parts.append(
            frame.select(
                F.lit(report).alias("report"), F.lit(kind).alias("kind"), item.cast("string").alias("item"),
                detail.cast("string").alias("detail"), F.lit(sheet).alias("sheet"),
                F.array(*[F.lit(c) for c in columns]).cast("array<string>").alias("columns"),
                status.cast("string").alias("status"), primary.cast("boolean").alias("primary"),
            )
        )

    one = spark.range(0, 1, 1, 1)
    for key, report in reports.items():
        for fact in ("study_id", "protocol_version"):
            value = report.metadata.get(fact)
            add(one, key, "fact", F.lit(fact), F.lit(value), "", [])
        if report.methods is not None:
            add(methods_present(report.methods), key, "methods", F.col("item"), F.lit(None), METHODS_SHEET, [])
    for selection, table in prepared:
        visible = [c for c in table.columns if c not in IDENTITY]
        offered = offered_columns(visible)
        add(one, selection.report, "table", F.lit(selection.table), F.lit(None), selection.name, offered)
        if selection.table == "characteristics" and "variable" in table.columns:
            summaries = table.select("variable", "summary").distinct()
            add(
                summaries, selection.report, "characteristic", F.col("variable"), F.col("summary"), selection.name,
                offered,
            )
            sizes = set(reports[selection.report].metadata.get("group_sizes", {})) == {"Cases", "Controls"}
            if selection.group_sizes and sizes and {"Cases", "Controls"} <= set(visible):
                add(one, selection.report, "group sizes", F.lit(""), F.lit(None), selection.name, offered)
        if selection.table == "associations" and "model_id" in table.columns:
            add(
                table, selection.report, "association", F.col("model_id"), F.col("predictor_id"), selection.name, offered,
                F.col("status_id"), F.col("primary"),
            )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def offered_columns(visible: list[str]) -> list[str]:
    """Columns a table answers for: a combined column supplies its parts."""
    columns = set(visible)
    if "OR (95% CI)" in columns:
        columns |= {"OR", "95% CI"}
    if "Condition in sampled cases" in columns:
        columns.add("Cases")
    if "Condition in sampled controls" in columns:
        columns.add("Controls")
    return sorted(columns)


REQUIRED = "report string, kind string, item string, detail string, wanted array<string>, content string, seq int"


def requirement_rows(spec: PublicationSpec) -> list[tuple]:
    rows = []

    def need(report, kind, item, detail, wanted, content):
        rows.append((report, kind, item, detail, sorted(wanted), content, len(rows)))

    for key, r in spec.reports.items():
        need(key, "report", "", None, (), "Report")
        for fact in ("study_id", "protocol_version"):
            expected = getattr(r, fact)
            if expected is not None:
                need(key, "fact", fact, expected, (), fact)
        if r.group_sizes:
            need(key, "group sizes", "", None, (), "Group sizes")
        for variable, summaries in r.characteristics.items():
            for summary in summaries:
                need(key, "characteristic", variable, summary, CHARACTERISTIC_COLUMNS, f"{variable}: {summary}")
        for model, predictors in r.associations.items():
            for predictor in predictors:
                need(key, "association", model, predictor, r.association_columns, f"{model}: {predictor}")
        for table, columns in r.tables.items():
            need(key, "table", table, None, columns, table)
        need(key, "methods", "", None, (), "Methods and review status")
    return rows


def reconcile(ledger: DataFrame, spec: PublicationSpec) -> DataFrame:
    """(Report, Content, Status, Sheets, Details) for each requirement, found or missing.

    A single join of requirements to the ledger. Columns of one result may be spread over several tables;
    diagnostic tables need all their columns in one place. Facts are listed only when they disagree.
    """
    needed = ledger.sparkSession.createDataFrame(requirement_rows(spec), REQUIRED)
    have = ledger.withColumnsRenamed({"report": "h_report", "kind": "h_kind", "item": "h_item", "detail": "h_detail"})
    exact = (
        (F.col("report") == F.col("h_report"))
        & (F.col("kind") == F.col("h_kind"))
        & (F.col("item") == F.col("h_item"))
        & F.col("detail").eqNullSafe(F.col("h_detail"))
    )
    whole_table = (F.col("kind") != "table") | (F.size(F.array_except("wanted", "columns")) == 0)
    same = F.col("report") == F.col("h_report")
    any_table = (F.col("kind") == "report") & same & (F.col("h_kind") == "table")
    any_methods = (F.col("kind") == "methods") & same & (F.col("h_kind") == "methods")
    met = needed.join(have, (exact & whole_table) | any_table | any_methods, "left")
    grouped = met.groupBy("seq", "report", "kind", "content", "wanted").agg(
        F.array_sort(F.collect_set(F.when(F.col("sheet") != "", F.col("sheet")))).alias("sheets"),
        F.count("h_report").alias("found"),
        F.collect_set("h_item").alias("items"),
        F.array_distinct(F.flatten(F.collect_list("columns"))).alias("columns"),
        F.collect_set("status").alias("statuses"),
        F.coalesce(F.bool_or("primary"), F.lit(False)).alias("primary"),
    )
    wanted = F.when(
        (F.col("kind") == "association") & F.col("primary"), F.array_union("wanted", F.array(F.lit("Holm P")))
    ).otherwise(F.col("wanted"))
    grouped = grouped.withColumn("lacking", F.array_sort(F.array_except(wanted, F.col("columns"))))
    known = F.array(*[F.lit(s) for s in STATUS_TEXT])
    valid = F.size(F.array_except("statuses", known)) == 0
    unstated = F.array_except(F.array(F.lit("methods"), F.lit("review")), F.col("items"))
    stated = (F.col("kind") != "methods") | (F.size(unstated) == 0)
    ok = (F.col("found") > 0) & (F.size("lacking") == 0) & valid & stated
    state = (
        F.when(~ok, "Missing")
        .when(F.array_contains("statuses", PENDING), "Included, suppressed")
        .when(F.array_contains("statuses", "non_estimable"), "Included, not estimable")
        .otherwise("Included")
    )
    absent_report = Window.partitionBy("report")
    present = F.max(F.when((F.col("kind") == "report") & (F.col("found") > 0), 1).otherwise(0)).over(absent_report)
    details = (
        F.when(F.col("kind") == "report", "The selection shows no table of this report")
        .when(F.col("kind") == "fact", "The report belongs to another study or version")
        .when(~valid, "The analysis has no recognised status")
        .when(~stated, F.concat(F.lit("The report does not state: "), F.array_join(unstated, ", ")))
        .when(F.size("lacking") > 0, F.concat(F.lit("Missing columns: "), F.array_join("lacking", ", ")))
        .otherwise("Accounted for")
    )
    # An absent report is one finding; a report that is there has no row of its own, nor a fact that agrees.
    listed = (
        F.when(F.col("present") == 0, F.col("kind") == "report")
        .when(F.col("kind") == "report", F.lit(False))
        .when(F.col("kind") == "fact", F.col("Status") == "Missing")
        .otherwise(F.lit(True))
    )
    return (
        grouped.withColumn("present", present)
        .withColumn("Status", state)
        .withColumn("Details", details)
        .filter(listed)
        .select(
            "seq", F.col("report").alias("Report"), F.col("content").alias("Content"), "Status",
            F.when(F.col("Status") == "Missing", "").otherwise(F.array_join("sheets", ", ")).alias("Sheets"),
            "Details",
        )
    )


def check_coverage(
    reports: dict[str, Report], selections: list[TableSelection], requirements: PublicationSpec,
    display: DisplayFormat = DisplayFormat(),
) -> DataFrame:
    """Which required content the selected tables hold, without writing anything."""
    if len({bool(r.metadata.get("synthetic")) for r in reports.values()}) > 1:
        raise DataContractError("Synthetic and real reports are published apart.")
    for s in selections:
        if s.report not in reports:
            raise DataContractError(f"There is no report {s.report!r} for {s.name!r}.")
    prepared = [(s, select_table(reports[s.report], s, display)) for s in selections]
    spark = prepared[0][1].sparkSession
    return reconcile(content_ledger(reports, prepared, spark), requirements)


def require_complete(coverage: DataFrame) -> None:
    missing = coverage.filter("Status = 'Missing'").orderBy("seq").collect()
    if missing:
        found = "; ".join(f"{r['Report']}: {r['Content']} ({r['Details']})" for r in missing)
        raise DataContractError(f"Required content is missing: {found}")
