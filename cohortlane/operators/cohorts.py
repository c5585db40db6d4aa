"""Disjoint cases and controls, with a reason for everyone left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import StudySpec
from ..errors import DataContractError
from ..functions.predicates import predicate_mask
from ..functions.scalars import is_missing
from .features import unique_people

FLOW = ("source", "eligible", "cases", "controls", "excluded")


def exclusion_reason(frame: DataFrame, study: StudySpec) -> Column:
    """First rule that excludes the person, or null for an eligible one."""
    age = F.col("age_at_cutoff")
    reason = (
        F.when(is_missing(frame, "age_at_cutoff") | is_missing(frame, "age"), "missing_or_invalid_age")
        .when(age < study.minimum_age, "below_minimum_age")
        .when(F.coalesce(F.col("ehr_record_count"), F.lit(0)) <= 0, "no_dated_ehr_evidence")
    )
    if study.maximum_age is not None:
        reason = reason.when(age > study.maximum_age, "above_maximum_age")
    if study.eligibility is not None:
        reason = reason.when(~predicate_mask(frame, study.eligibility), "study_eligibility")
    return reason


def classify(features: DataFrame, study: StudySpec) -> DataFrame:
    """The feature frame with ``reason``, ``is_case`` (1, 0 or null) and ``overlap``; one narrow step."""
    frame = features.withColumn("reason", exclusion_reason(features, study))
    eligible = F.col("reason").isNull()
    case = predicate_mask(features, study.case)
    control = predicate_mask(features, study.control)
    return frame.select(
        *features.columns,
        F.when(eligible & case, 1).when(eligible & control, 0).alias("is_case"),
        (eligible & case & control).alias("overlap"),
        F.when(~eligible, F.col("reason"))
        .when(eligible & ~case & ~control, F.lit("neither_case_nor_control"))
        .alias("reason"),
        eligible.alias("eligible"),
    )


def build_cohorts(features: DataFrame, study: StudySpec, *, checked: bool = False) -> DataFrame:
    """Classified people; fails on a repeated person or on overlapping definitions."""
    frame = features if checked else unique_people(features)
    classified = classify(frame, study)
    if classified.filter("overlap").limit(1).count():
        raise DataContractError("Somebody is both a case and a control.")
    return classified.drop("overlap")


def cases_and_controls(classified: DataFrame) -> DataFrame:
    return classified.filter("is_case is not null").drop("reason", "eligible")


def exclusions(classified: DataFrame) -> DataFrame:
    return classified.filter("reason is not null").select("person_id", "reason")


def flow_counts(classified: DataFrame) -> DataFrame:
    """(position, stage, n) in reporting order, from one aggregate over all people."""
    counts = classified.agg(
        F.count("*").alias("source"),
        F.count_if("eligible").alias("eligible"),
        F.count_if(F.col("is_case") == 1).alias("cases"),
        F.count_if(F.col("is_case") == 0).alias("controls"),
        F.count_if(F.col("reason").isNotNull()).alias("excluded"),
    )
    return long_flow(counts)


def long_flow(counts: DataFrame) -> DataFrame:
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("stage"), F.col(c).alias("n"))
        for i, c in enumerate(counts.columns)
    ]
    return counts.select(F.inline(F.array(*entries)))
