"""One feature row per person, from dated conditions, visits, surveys and measurements.

Every reduction is an aggregate with a map-side combine, so a person who owns a large share of all rows
is shrunk before the shuffle. All results are keyed by ``person_id`` and join without a further exchange.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..config import ConceptSet, MeasurementFeature, StudySpec, SurveyFeature
from ..errors import DataContractError
from ..functions.scalars import age_on, evidence_number, finite, is_finite, parsed
from ..session import cut, local_rows
from ..sources.omop import OmopSource
from .vocabulary import resolve_concepts, resolve_surveys, resolve_units


def unique_people(frame: DataFrame) -> DataFrame:
    """The frame with ``person_id`` as text, once every person is known to have exactly one row."""
    if "person_id" not in frame.columns:
        raise DataContractError("A participant frame has a person_id column.")
    frame = frame.withColumn("person_id", F.col("person_id").cast("string"))
    if key_problems(frame).limit(1).count():
        raise DataContractError("person_id is missing or repeated.")
    return frame


def key_problems(frame: DataFrame) -> DataFrame:
    return frame.groupBy("person_id").agg(F.count("*").alias("rows")).filter("rows > 1 or person_id is null")


def _days_back(cutoff: dt.date, days: int | None) -> dt.date:
    return cutoff - dt.timedelta(days=days)


def dated_evidence(source: OmopSource, study: StudySpec, concepts: DataFrame) -> DataFrame:
    """Record counts, record span and all condition features, in one pass over conditions and visits.

    ``concepts`` is a materialised table, so Catalyst knows its size: it is broadcast to the scan below the
    broadcast threshold, and joined by a shuffle (with skew handling) beyond it.

    Rows are first rolled up to one per person and day. That makes distinct dates a plain count, needs no
    Expand for several distinct counts, and serves record evidence and every condition feature at once.
    """
    names = list(study.conditions)
    cutoff = F.lit(study.clinical_cutoff)
    hits = concepts.groupBy("concept_id").agg(
        *[F.bool_or(F.col("feature") == name).alias(f"hit_{name}") for name in names]
    )
    conditions = (
        source.table("condition_occurrence")
        .filter(F.col("condition_start_date") <= cutoff)
        .join(hits.withColumnRenamed("concept_id", "condition_concept_id"), "condition_concept_id", "left")
    )

    def hit(name: str) -> Column:
        inside = F.coalesce(F.col(f"hit_{name}"), F.lit(False))
        back = study.conditions[name].lookback_days
        if back is not None:
            inside = inside & (F.col("condition_start_date") >= F.lit(_days_back(study.clinical_cutoff, back)))
        return inside.alias(f"hit_{name}")

    dated = conditions.select(
        "person_id", F.to_date("condition_start_date").alias("day"), F.lit(True).alias("condition"),
        *[hit(name) for name in names],
    ).unionByName(
        source.table("visit_occurrence")
        .filter(F.col("visit_start_date") <= cutoff)
        .select(
            "person_id", F.to_date("visit_start_date").alias("day"), F.lit(False).alias("condition"),
            *[F.lit(False).alias(f"hit_{name}") for name in names],
        )
    )
    days = dated.groupBy("person_id", "day").agg(
        F.count("*").alias("records"),
        F.bool_or("condition").alias("condition"),
        *[F.bool_or(f"hit_{name}").alias(f"hit_{name}") for name in names],
    )
    columns = [
        F.sum("records").alias("ehr_record_count"),
        F.datediff(F.max("day"), F.min("day")).alias("ehr_days"),
        F.bool_or("condition").alias("any_condition"),
    ]
    for name in names:
        day = F.when(F.col(f"hit_{name}"), F.col("day"))
        columns += [
            F.count(day).alias(f"{name}__days"),
            F.min(day).alias(f"{name}__first"),
            F.max(day).alias(f"{name}__last"),
        ]
    people = days.groupBy("person_id").agg(*columns)
    outputs = ["person_id", "ehr_record_count", "ehr_days"]
    for name in names:
        outputs += condition_columns(study, name)
    return people.select(*outputs)


def condition_columns(study: StudySpec, name: str) -> list[Column]:
    """Stored days are null without any dated condition, 0 with others only; flag and span are never null."""
    spec = study.conditions[name]
    found = F.coalesce(F.col(f"{name}__days"), F.lit(0))
    span = F.coalesce(F.datediff(F.col(f"{name}__last"), F.col(f"{name}__first")), F.lit(0))
    flag = (found >= spec.min_distinct_dates) & (span >= spec.min_span_days)
    return [
        F.when(F.col("any_condition"), F.col(f"{name}__days")).alias(f"{name}__days"),
        F.col(f"{name}__first"),
        F.col(f"{name}__last"),
        span.alias(f"{name}__span"),
        flag.cast("int").alias(name),
    ]


def demographics(source: OmopSource, study: StudySpec) -> DataFrame:
    """Birth date, both ages, and the names of sex, race and ethnicity (``unknown`` without a concept).

    Only the concepts people actually refer to are looked up, so a handful of rows is broadcast instead
    of joining three times on keys that half of all people share.
    """
    person = source.table("person")
    fields = {
        "sex_at_birth": "sex_at_birth_concept_id",
        "race": "race_concept_id",
        "ethnicity": "ethnicity_concept_id",
    }
    used = person.select(F.explode(F.array(*fields.values())).alias("concept_id")).distinct()
    names = cut(source.table("concept").select("concept_id", "concept_name").join(used, "concept_id", "left_semi"))
    birth = F.to_date("birth_datetime")
    frame = person.select("person_id", birth.alias("birth_date"), *fields.values())
    for label, key in fields.items():
        frame = frame.join(
            names.withColumnsRenamed({"concept_id": key, "concept_name": label}), key, "left"
        )
    return frame.select(
        "person_id", "birth_date", *fields.values(),
        age_on(F.col("birth_date"), study.age_reference_date).alias("age"),
        age_on(F.col("birth_date"), study.clinical_cutoff).alias("age_at_cutoff"),
        *[F.coalesce(F.col(label), F.lit("unknown")).alias(label) for label in fields],
    )


def survey_evidence(events: DataFrame, rules: DataFrame, cutoff: dt.date) -> DataFrame:
    """(person_id, feature, positive, negative) from each question's latest day, ties included.

    "An answer on the latest day is positive" is the same as "the latest positive day is the latest day",
    which is three maxima: no window over a person's answers, and the maxima combine before the shuffle.
    """
    if isinstance(events.schema["event_date"].dataType, T.StringType):
        events = events.withColumn("event_date", F.col("event_date").try_cast("timestamp"))
    rows = events.filter(F.to_date("event_date") <= F.lit(cutoff)).join(F.broadcast(rules), "question_id")
    value = evidence_number(F.col("value_as_number"), F.col("value_as_string"))
    listed = F.coalesce(F.array_contains("positive", F.col("answer_id")), F.lit(False))
    above = F.coalesce(is_finite(value) & (value > F.col("threshold")), F.lit(False))
    denied = F.coalesce(F.array_contains("negative", F.col("answer_id")), F.lit(False))
    latest = rows.groupBy("person_id", "feature", "question_id").agg(
        F.max("event_date").alias("latest"),
        F.max(F.when(listed | above, F.col("event_date"))).alias("latest_positive"),
        F.max(F.when(denied, F.col("event_date"))).alias("latest_negative"),
    )
    return latest.select(
        "person_id", "feature",
        F.coalesce(F.col("latest_positive") == F.col("latest"), F.lit(False)).alias("positive"),
        F.coalesce(F.col("latest_negative") == F.col("latest"), F.lit(False)).alias("negative"),
    )


def survey_label(spec: SurveyFeature, positive: Column, negative: Column) -> Column:
    return (
        F.when(positive & negative, spec.conflict_label)
        .when(positive, spec.positive_label)
        .when(negative, spec.negative_label)
        .otherwise(spec.unknown_label)
    )


def reduce_surveys(
    events: DataFrame, rules: DataFrame, surveys: dict[str, SurveyFeature], cutoff: dt.date
) -> DataFrame:
    """All survey features at once, one row per person with any relevant answer."""
    evidence = survey_evidence(events, rules, cutoff)
    columns = []
    for name, spec in surveys.items():
        mine = F.col("feature") == name
        positive = F.coalesce(F.bool_or(mine & F.col("positive")), F.lit(False))
        negative = F.coalesce(F.bool_or(mine & F.col("negative")), F.lit(False))
        columns.append(survey_label(spec, positive, negative).alias(name))
    return evidence.groupBy("person_id").agg(*columns)


def survey_rules(spark, surveys: dict[str, SurveyFeature]) -> DataFrame:
    """Rules straight from definitions that already use concept ids."""
    rows = []
    for name, s in surveys.items():
        for question in sorted({*s.positive, *s.negative, *s.numeric_positive_above}):
            rows.append((
                name, question, list(s.positive.get(question, ())), list(s.negative.get(question, ())),
                s.numeric_positive_above.get(question),
            ))
    return spark.createDataFrame(
        rows,
        "feature string, question_id long, positive array<bigint>, negative array<bigint>, threshold double",
    )


def reduce_survey(events: DataFrame, spec: SurveyFeature, cutoff: dt.date) -> DataFrame:
    """(person_id, value) of one survey feature over (person, question, answer, date, number, text) events."""
    wanted = {"person_id", "question_id", "answer_id", "event_date", "value_as_number", "value_as_string"}
    if not wanted <= set(events.columns):
        raise DataContractError(f"Survey events lack {sorted(wanted - set(events.columns))}")
    rules = survey_rules(events.sparkSession, {"value": spec})
    reduced = reduce_surveys(events, rules, {"value": spec}, cutoff)
    return reduced.select(F.col("person_id").cast("string").alias("person_id"), "value")


def _unanimous(keep: Column) -> tuple[Column, Column]:
    """Aggregates giving (largest, smallest) value on the latest kept day."""
    high = F.max(F.when(keep, F.struct(F.col("event_date").alias("d"), F.col("value").alias("v"))))
    low = F.max(F.when(keep, F.struct(F.col("event_date").alias("d"), (-F.col("value")).alias("v"))))
    return high["v"], -low["v"]


def _agreed(high: Column, low: Column) -> Column:
    return F.when(high == low, high)


def reduce_measurements(rows: DataFrame, names: list[str]) -> DataFrame:
    """Latest-day value per person and feature, null where that day disagrees with itself.

    ``rows`` holds valid values only: (person_id, feature, event_date, value). One aggregate, one shuffle:
    the largest (date, value) and (date, -value) pairs carry the latest day's maximum and minimum.
    """
    columns = []
    for name in names:
        high, low = _unanimous(F.col("feature") == name)
        columns.append(_agreed(high, low).alias(name))
    return rows.groupBy("person_id").agg(*columns)


def reduce_measurement(events: DataFrame, spec: MeasurementFeature, cutoff: dt.date) -> DataFrame:
    """(person_id, value) of one measurement over (person, date, value, unit) events."""
    value = finite(parsed(F.col("value")))
    rows = (
        events.withColumn("value", value)
        .withColumn("event_date", F.col("event_date").try_cast("timestamp"))
        .filter(
            F.col("event_date").between(F.lit(_days_back(cutoff, spec.lookback_days)), F.lit(cutoff))
            & F.col("unit_code").isin(*spec.unit_codes)
            & F.col("value").between(spec.minimum, spec.maximum)
        )
        .select(F.col("person_id").cast("string").alias("person_id"), F.lit("value").alias("feature"),
                "event_date", "value")
    )
    return reduce_measurements(rows, ["value"])


def measurement_rows(source: OmopSource, study: StudySpec, concepts: DataFrame, units: DataFrame) -> DataFrame:
    """Measurement rows that are valid for some feature: window, concept, unit, range, finite."""
    cutoff, features = study.clinical_cutoff, study.measurements
    ranges = local_rows(
        source.spark,
        [(n, float(f.minimum), float(f.maximum), _days_back(cutoff, f.lookback_days)) for n, f in features.items()],
        "feature string, minimum double, maximum double, start date",
    )
    earliest = min(_days_back(cutoff, f.lookback_days) for f in features.values())
    wanted = (
        concepts.select("feature", F.col("concept_id").alias("measurement_concept_id"))
        .join(F.broadcast(ranges), "feature")
    )
    units = units.select("feature", F.col("concept_id").alias("unit_concept_id"))
    value = finite(parsed(F.col("value_as_number")))
    return (
        source.table("measurement")
        .filter(F.col("measurement_date").between(F.lit(earliest), F.lit(cutoff)))
        .join(wanted, "measurement_concept_id")
        .join(units, ["feature", "unit_concept_id"])
        .select(
            "person_id", "feature", F.col("measurement_date").alias("event_date"), value.alias("value"),
            "start", "minimum", "maximum",
        )
        .filter((F.col("event_date") >= F.col("start")) & F.col("value").between(F.col("minimum"), F.col("maximum")))
        .select("person_id", "feature", "event_date", "value")
    )


def survey_events(source: OmopSource) -> DataFrame:
    return source.table("observation").select(
        "person_id",
        F.col("observation_source_concept_id").alias("question_id"),
        F.col("value_source_concept_id").alias("answer_id"),
        F.col("observation_date").alias("event_date"),
        "value_as_number", "value_as_string",
    )


def resolve_study(source: OmopSource, study: StudySpec) -> dict[str, DataFrame]:
    """Check the source, then resolve every vocabulary reference of the study."""
    source.preflight(study)
    sets: dict[str, ConceptSet] = {n: f.concepts for n, f in {**study.conditions, **study.measurements}.items()}
    # Three independent resolutions of a few small jobs each; they overlap on the driver's threads.
    with ThreadPoolExecutor(3) as pool:
        waiting = {"concepts": pool.submit(resolve_concepts, source, sets)}
        if study.surveys:
            waiting["surveys"] = pool.submit(resolve_surveys, source, study.surveys)
        if study.measurements:
            waiting["units"] = pool.submit(resolve_units, source, study.measurements)
        return {name: result.result() for name, result in waiting.items()}


def extract_features(source: OmopSource, study: StudySpec, resolved: dict | None = None) -> DataFrame:
    """The participant feature frame: people with dated evidence, every declared feature.

    The population is written first, so that answers and measurements of others are dropped before they are
    reduced.
    """
    resolved = resolved or resolve_study(source, study)
    concepts = resolved["concepts"]
    conditions = concepts.filter(F.col("feature").isin(list(study.conditions)))
    frame = cut(demographics(source, study).join(dated_evidence(source, study, conditions), "person_id"))
    population = frame.select("person_id")
    if study.surveys:
        answers = reduce_surveys(
            survey_events(source).join(population, "person_id", "left_semi"),
            resolved["surveys"], study.surveys, study.clinical_cutoff,
        )
        frame = frame.join(answers, "person_id", "left")
        for name, spec in study.surveys.items():
            frame = frame.withColumn(name, F.coalesce(F.col(name), F.lit(spec.unknown_label)))
    if study.measurements:
        measured = concepts.filter(F.col("feature").isin(list(study.measurements)))
        rows = measurement_rows(source, study, measured, resolved["units"])
        rows = rows.join(population, "person_id", "left_semi")
        frame = frame.join(reduce_measurements(rows, list(study.measurements)), "person_id", "left")
    return frame.withColumn("person_id", F.col("person_id").cast("string"))
