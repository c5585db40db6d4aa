import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from cohortlane import MeasurementFeature, Predicate, SpecError, StudySpec, SurveyFeature
from cohortlane.errors import DataContractError
from cohortlane.functions.predicates import predicate_mask
from cohortlane.functions.scalars import age_on, significant
from cohortlane.operators.cohorts import build_cohorts, exclusions, flow_counts
from cohortlane.operators.features import reduce_measurement, reduce_survey
from tests.conftest import STUDY


def selected(frame, rule):
    return [r[0] for r in frame.select(predicate_mask(frame, Predicate.from_dict(rule))).collect()]


def test_ages_follow_the_calendar(spark):
    def ages(day, *births):
        frame = spark.createDataFrame([(b,) for b in births], "born string").coalesce(1)
        return [r[0] for r in frame.select(age_on(F.col("born"), day)).collect()]

    assert ages(dt.date(2019, 3, 1), "1959-02-28", "1959-03-01", "1959-03-02", "2019-03-01") == [60, 60, 59, 0]
    assert ages(dt.date(2019, 2, 28), "1996-02-29", "2019-03-01", None, "some day", "") == [22, None, None, None, None]
    assert ages(dt.date(2020, 2, 29), "1996-02-29", "1996-03-01 10:00:00") == [24, 23]


def test_unknown_never_selects(spark):
    """Three values of a field against rules and their negations: what is unknown stays out of both."""
    grades = spark.createDataFrame([(None,), (3,), (8,)], "grade int").coalesce(1)
    high, low = {"field": "grade", "op": "gt", "value": 5}, {"field": "grade", "op": "le", "value": 5}
    absent = {"field": "grade", "op": "is_missing"}
    for rule, chosen in [
        (high, [False, False, True]), ({"negate": high}, [False, True, False]), ({"negate": {"negate": high}}, [False, False, True]),
        ({"any_of": [high, low]}, [False, True, True]), ({"all_of": [high, low]}, [False, False, False]),
        ({"negate": {"all_of": [high, low]}}, [False, True, True]), ({"any_of": [absent, high]}, [True, False, True]),
        (absent, [True, False, False]), ({"negate": absent}, [False, True, True]),
        ({"field": "grade", "value": None}, [False, False, False]), ({"field": "grade", "op": "ne", "value": None}, [False, True, True]),
        ({"negate": {"field": "grade", "op": "ne", "value": None}}, [False, False, False]),
    ]:
        assert selected(grades, rule) == chosen, rule


def test_nan_is_missing_and_types_may_differ(spark):
    frame = spark.createDataFrame([(1.0, "a"), (math.nan, "1"), (None, None)], "x double, t string").coalesce(1)
    assert selected(frame, {"field": "x", "op": "not_missing"}) == [True, False, False]
    assert selected(frame, {"field": "x", "op": "gt", "value": 0}) == [True, False, False]
    assert selected(frame, {"field": "t", "value": 1}) == [False, False, False]
    assert selected(frame, {"field": "t", "op": "ne", "value": 1}) == [True, True, False]
    assert selected(frame, {"field": "t", "op": "not_in", "value": ["a"]}) == [False, True, False]
    assert selected(frame, {"field": "x", "op": "in", "value": [1, 2]}) == [True, False, False]
    with pytest.raises(DataContractError):
        selected(frame, {"field": "absent", "value": 1})


def test_predicate_shapes_are_checked():
    for bad in ({}, {"field": "a", "negate": {"field": "b"}}, {"field": "a", "op": "in", "value": 1}):
        with pytest.raises(SpecError):
            Predicate.from_dict(bad)


SURVEY_SCHEMA = (
    "person_id string, question_id long, answer_id long, event_date string, value_as_number double, "
    "value_as_string string"
)
CUTOFF = dt.date(2022, 8, 31)
#: Question 700: 71 yes, 72 no, 73 neither. Question 800: glasses a week, more than 4 is yes.
DRINKING = SurveyFeature(positive={700: (71,)}, negative={700: (72,)}, numeric_positive_above={800: 4})


def survey(spark, **answers):
    """``answers``: per person a list of (question, answer, day of 2022 as text, number, text)."""
    rows = [(person, q, a, day, n, t) for person, given in answers.items() for q, a, day, n, t in given]
    events = spark.createDataFrame(rows, SURVEY_SCHEMA)
    found = [
        {r.person_id: r.value for r in reduce_survey(frame, DRINKING, CUTOFF).collect()}
        for frame in (events, events.withColumn("event_date", F.expr("try_cast(event_date as date)")), events.repartition(4).orderBy(F.rand(5)))
    ]
    assert found[0] == found[1] == found[2]
    return found[0]


def test_the_latest_day_of_a_question_decides(spark):
    found = survey(
        spark,
        changed_mind=[(700, 71, "2022-02-01", None, None), (700, 72, "2022-05-20", None, None)],
        two_answers_a_day=[(700, 72, "2022-05-20", None, None), (700, 71, "2022-05-20", None, None)],
        later_than_cutoff=[(700, 72, "2022-03-03", None, None), (700, 71, "2022-09-01", None, None)],
        two_questions=[(700, 72, "2022-06-01", None, None), (800, 0, "2022-01-01", 9.0, None)],
        neither=[(700, 73, "2022-06-01", None, "rather not say")],
        no_day=[(700, 71, "in spring", None, None), (700, 72, "2022-01-01", None, None)],
        other_question=[(900, 71, "2022-06-01", None, None)],
    )
    assert found == {"changed_mind": "no", "two_answers_a_day": "conflict", "later_than_cutoff": "no",
                     "two_questions": "conflict", "neither": "unknown", "no_day": "no"}


def test_numbers_count_above_their_threshold_only(spark):
    found = survey(
        spark, four=[(800, 0, "2022-06-01", 4.0, None)], more=[(800, 0, "2022-06-01", 4.1, "0")],
        text=[(800, 0, "2022-06-01", None, " 12 ")], not_a_number=[(800, 0, "2022-06-01", math.nan, "7")],
        endless=[(800, 0, "2022-06-01", math.inf, None)], words=[(800, 0, "2022-06-01", None, "plenty")],
    )
    assert found == {"four": "unknown", "more": "yes", "text": "yes", "not_a_number": "yes", "endless": "unknown", "words": "unknown"}


def test_measurement_uses_the_latest_valid_day(spark):
    spec = MeasurementFeature(
        concepts={"ids": [9], "domain": "Measurement"}, unit_codes=("mmol/L", "mM"), minimum=1, maximum=30, lookback_days=90
    )
    rows = {
        "plain": [("2022-08-01", 5.5, "mM"), ("2022-07-01", 9.0, "mM")],
        "last_is_out_of_range": [("2022-08-20", 31.0, "mM"), ("2022-08-02", 6.0, "mmol/L")],
        "last_has_another_unit": [("2022-08-20", 7.0, "mg/dL"), ("2022-08-02", 6.5, "mM")],
        "same_day_same_value": [("2022-08-02", 8.0, "mM"), ("2022-08-02", 8.0, "mmol/L")],
        "same_day_disagrees": [("2022-08-02", 8.0, "mM"), ("2022-08-02", 8.5, "mM"), ("2022-08-01", 5.0, "mM")],
        "bounds_belong": [("2022-08-02", 30.0, "mM")],
        "too_old": [("2022-05-01", 5.0, "mM")], "too_new": [("2022-09-01", 5.0, "mM")],
        "no_value": [("2022-08-02", math.nan, "mM")], "no_day": [("soon", 5.0, "mM")],
    }
    events = spark.createDataFrame(
        [(person, *row) for person, given in rows.items() for row in given],
        "person_id string, event_date string, value double, unit_code string")
    found = {r.person_id: r.value for r in reduce_measurement(events, spec, CUTOFF).collect()}
    assert found == {"plain": 5.5, "last_is_out_of_range": 6.0, "last_has_another_unit": 6.5, "same_day_same_value": 8.0,
                     "same_day_disagrees": None, "bounds_belong": 30.0}


def test_everybody_left_out_has_one_reason(features, feature_rows, study):
    who = F.col("person_id")
    spoiled = (
        features.withColumn("age_at_cutoff", F.when(who.isin("s000", "s001"), 12).otherwise(F.col("age_at_cutoff")))
        .withColumn("ehr_record_count", F.when(who.isin("s001", "s002", "s006"), 0).otherwise(F.col("ehr_record_count")))
        .withColumn("age", F.when(~who.isin("s003", "s006"), F.col("age")))
    )
    classified = build_cohorts(spoiled, study)
    reasons = {r.person_id: r.reason for r in exclusions(classified).collect()}
    assert set(reasons) == {"s000", "s001", "s002", "s003", "s006"} and reasons["s000"] == "below_minimum_age"
    assert reasons["s002"] == "no_dated_ehr_evidence" and reasons["s003"] == "missing_or_invalid_age"
    kept = feature_rows[~feature_rows.person_id.isin(list(reasons))]
    flow = {r.stage: r.n for r in flow_counts(classified).collect()}
    assert flow == {"source": len(feature_rows), "eligible": len(kept), "cases": int(kept.asthma.sum()),
                    "controls": int((kept.asthma == 0).sum()), "excluded": 5}


def test_nobody_is_counted_twice_or_in_both_roles(features, study):
    with pytest.raises(DataContractError):
        build_cohorts(features.unionByName(features.filter("person_id = 's010'")), study)
    both = StudySpec.from_dict({**STUDY, "control": {"field": "reflux", "op": "in", "value": [0, 1]}})
    with pytest.raises(DataContractError):
        build_cohorts(features, both)


def test_age_limit_and_own_eligibility(features, feature_rows):
    spec = StudySpec.from_dict({**STUDY, "maximum_age": 50, "eligibility": {"field": "sex_at_birth", "value": "woman"}})
    found = {r.person_id: r.reason for r in exclusions(build_cohorts(features, spec)).collect()}
    old = feature_rows[feature_rows.age_at_cutoff > 50].person_id
    assert {found[p] for p in old} == {"above_maximum_age"}
    rest = feature_rows[(feature_rows.age_at_cutoff <= 50) & (feature_rows.sex_at_birth == "man")].person_id
    assert set(found) == {*old, *rest} and {found[p] for p in rest} == {"study_eligibility"}


@pytest.mark.parametrize(
    "change",
    [
        {"unknown": 1}, {"clinical_cutoff": "2027-01-01"}, {"maximum_age": 3}, {"conditions": {}},
        {"conditions": {"age": {"concepts": {"ids": [1]}}}}, {"models": []},
        {"matching": {"ratio": 2, "minimum_controls": 3}}, {"matching": {"calipers": {"age": -1}}},
        {"conditions": {"c": {"concepts": {}}}},
    ],
)
def test_contradictory_studies_are_rejected(change):
    with pytest.raises(SpecError):
        StudySpec.from_dict({**STUDY, **change})


@pytest.mark.parametrize(
    "value, text",
    [(1.234567, "1.23"), (0.000123456, "0.000123"), (12345678.76, "1.23e+07"), (100.0, "100"), (0.5, "0.5"),
     (999.6, "1e+03"), (0.0, "0"), (2.0, "2")],
)
def test_significant_digits(spark, value, text):
    assert spark.range(1).select(significant(F.lit(value))).first()[0] == text
