"""The seven source tables as literal rows, through every extraction stage."""

import datetime as dt

import pytest

from cohortlane import ConceptSet, StudySpec, SurveyFeature
from cohortlane.errors import DataContractError
from cohortlane.operators.cohorts import build_cohorts
from cohortlane.operators.features import extract_features, unique_people
from cohortlane.operators.vocabulary import resolve_concepts, resolve_surveys
from cohortlane.plans.study_run import StudyRun
from cohortlane.sources.omop import OmopSource

D = dt.date.fromisoformat
SCHEMAS = {
    "person": "person_id long, birth_datetime timestamp, sex_at_birth_concept_id long, race_concept_id long, "
              "ethnicity_concept_id long",
    "condition_occurrence": "person_id long, condition_concept_id long, condition_start_date date",
    "visit_occurrence": "person_id long, visit_start_date date",
    "concept": "concept_id long, concept_name string, domain_id string, vocabulary_id string, "
               "concept_code string, standard_concept string, invalid_reason string",
    "concept_ancestor": "ancestor_concept_id long, descendant_concept_id long",
    "observation": "person_id long, observation_date date, observation_source_concept_id long, "
                   "value_source_concept_id long, value_as_number double, value_as_string string",
    "measurement": "person_id long, measurement_concept_id long, measurement_date date, value_as_number double, "
                   "unit_concept_id long",
}


def at(text):
    return dt.datetime.fromisoformat(text) if text else None


#: A small allergy clinic. Concepts 2xx are diagnoses (210 is an ancestor of 211 and 212), 3xx a test, 4xx units,
#: 5xx demographics, 6xx a questionnaire.
ROWS = {
    "person": [
        (71, at("1951-04-30"), 501, 503, 505), (72, at("1951-05-01"), 502, 503, 505), (73, at("1990-12-31"), 501, 504, None),
        (74, None, 599, 503, 505), (75, at("1988-07-07"), 502, 504, 505), (76, at("1979-02-11"), 501, 503, 505),
    ],
    "condition_occurrence": [
        # 71: four days of the diagnosis, one of them twice, over 100 days; one more after the cutoff
        (71, 211, D("2018-01-10")), (71, 211, D("2018-01-10")), (71, 212, D("2018-02-01")), (71, 211, D("2018-03-01")),
        (71, 212, D("2018-04-20")), (71, 211, D("2020-01-01")),
        # 72: enough days, too close together; 73: only the other diagnosis; 75: both
        (72, 211, D("2018-06-01")), (72, 211, D("2018-06-02")), (72, 212, D("2018-06-03")), (73, 230, D("2017-11-11")),
        (75, 230, D("2018-08-08")), (75, 211, D("2018-08-08")),
    ],
    "visit_occurrence": [(74, D("2019-04-30")), (73, D("2017-11-11")), (76, D("2019-05-01"))],
    "concept": [
        (210, "Allergic disease", "Condition", "SNOMED", "a-0", "S", None), (211, "Pollen allergy", "Condition", "SNOMED", "a-1", "S", None),
        (212, "Mite allergy", "Condition", "SNOMED", "a-2", "S", None), (230, "Eczema", "Condition", "SNOMED", "e-1", "S", None),
        (300, "Total IgE", "Measurement", "LOINC", "ige", "S", None),
        (400, "kilounit per litre", "Unit", "UCUM", "kU/L", "S", None), (401, "unit per millilitre", "Unit", "UCUM", "U/mL", "S", None),
        (501, "Woman", "Gender", "Gender", "w", "S", None), (502, "Man", "Gender", "Gender", "m", "S", None),
        (503, "North", "Race", "Race", "n", "S", None), (504, "South", "Race", "Race", "s", "S", None),
        (505, "Coast", "Ethnicity", "Ethnicity", "c", "S", None),
        (600, "Keeps a pet", "Observation", "PPI", "Pet-Now", None, None), (601, "Keeps one", "Observation", "PPI", "pet-yes", None, None),
        (602, "Keeps none", "Observation", "PPI", "pet-none", None, None),
    ],
    "concept_ancestor": [(210, 210), (210, 211), (210, 212), (211, 211), (212, 212), (230, 230), (300, 300)],
    "observation": [
        (71, D("2018-05-05"), 600, 601, None, None), (71, D("2019-03-03"), 600, 602, None, None),
        (72, D("2019-03-03"), 600, 602, None, None), (72, D("2019-03-03"), 600, 601, None, None),
        (75, D("2019-06-01"), 600, 601, None, None), (99, D("2019-01-01"), 600, 601, None, None),
    ],
    "measurement": [
        (71, 300, D("2019-02-02"), 120.0, 400), (71, 300, D("2019-02-02"), 120.0, 401), (71, 300, D("2018-12-24"), 80.0, 400),
        (72, 300, D("2019-02-02"), 120.0, 400), (72, 300, D("2019-02-02"), 121.0, 400), (73, 300, D("2018-04-01"), 50.0, 400),
        (75, 300, D("2019-04-01"), -4.0, 400), (75, 300, D("2019-03-31"), 33.0, 400), (75, 300, D("2019-04-02"), 44.0, 501),
    ],
}
STUDY = {
    "study_id": "clinic", "version": "3", "age_reference_date": "2021-05-01", "clinical_cutoff": "2019-04-30",
    "case": {"field": "allergy", "value": 1}, "control": {"field": "any_allergy", "value": 0},
    "conditions": {
        "allergy": {"concepts": {"ids": [210]}, "min_distinct_dates": 3, "min_span_days": 60},
        "any_allergy": {"concepts": {"ids": [210]}},
        "eczema": {"concepts": {"codes": ["e-1"]}},
    },
    "measurements": {
        "ige": {
            "concepts": {"ids": [300], "domain": "Measurement", "vocabulary": "LOINC"}, "unit_codes": ["kU/L", "U/mL"],
            "minimum": 0, "maximum": 5000, "lookback_days": 365,
        }
    },
    "surveys": {"pet": {"positive": {600: [601]}, "negative": {600: [602]}}},
    "matching": {},
    "models": [{"name": "primary", "predictors": ["eczema"], "primary": True}],
}


@pytest.fixture(scope="module")
def source(spark):
    return OmopSource(spark, {n: spark.createDataFrame(rows, SCHEMAS[n]) for n, rows in ROWS.items()})


@pytest.fixture(scope="module")
def extracted(source):
    return unique_people(extract_features(source, StudySpec.from_dict(STUDY))).cache()


def column(frame, name):
    return {r.person_id: r[name] for r in frame.select("person_id", name).collect()}


def test_only_people_with_dated_evidence_are_there(extracted):
    # 76 has a visit after the cutoff only, 99 answers without being a person
    assert column(extracted, "ehr_record_count") == {"71": 5, "72": 3, "73": 2, "74": 1, "75": 2}


def test_diagnoses_need_days_and_span(extracted):
    assert column(extracted, "allergy") == {"71": 1, "72": 0, "73": 0, "74": 0, "75": 0}
    assert column(extracted, "allergy__days") == {"71": 4, "72": 3, "73": 0, "74": None, "75": 1}
    assert column(extracted, "allergy__span") == {"71": 100, "72": 2, "73": 0, "74": 0, "75": 0}
    assert column(extracted, "eczema") == {"71": 0, "72": 0, "73": 1, "74": 0, "75": 1}


def test_people_are_named_and_aged(extracted):
    assert column(extracted, "age") == {"71": 70, "72": 70, "73": 30, "74": None, "75": 32}
    assert column(extracted, "age_at_cutoff") == {"71": 68, "72": 67, "73": 28, "74": None, "75": 30}
    assert column(extracted, "sex_at_birth") == {"71": "Woman", "72": "Man", "73": "Woman", "74": "unknown", "75": "Man"}
    assert column(extracted, "ethnicity")["73"] == "unknown"


def test_answers_and_tests_are_the_latest_before_the_cutoff(extracted):
    assert column(extracted, "pet") == {"71": "no", "72": "conflict", "73": "unknown", "74": "unknown", "75": "unknown"}
    # 73's value is older than a year; 75's last values are out of range, or in no accepted unit
    assert column(extracted, "ige") == {"71": 120.0, "72": None, "73": None, "74": None, "75": 33.0}


def test_groups_follow_the_definitions(extracted):
    roles = column(build_cohorts(extracted, StudySpec.from_dict(STUDY)), "is_case")
    # 72 and 75 are neither case nor free of the diagnosis; 74 has no age
    assert roles == {"71": 1, "72": None, "73": 0, "74": None, "75": None}


def test_preflight_reports_missing_and_mistyped_columns(source, spark):
    study = StudySpec.from_dict(STUDY)
    assert source.schema_problems(study).count() == 0
    tables = dict(source.tables)
    tables["person"] = tables["person"].drop("race_concept_id")
    tables["concept"] = tables["concept"].withColumn("domain_id", tables["concept"].concept_id)
    broken = OmopSource(spark, tables)
    found = {tuple(r) for r in broken.schema_problems(study).collect()}
    assert found == {
        ("person", "race_concept_id", "missing"), ("concept", "domain_id", "unexpected type bigint"),
    }
    with pytest.raises(DataContractError):
        broken.preflight(study)
    with pytest.raises(DataContractError):
        source.table("drug_exposure")


@pytest.mark.parametrize(
    "bad",
    [
        {"ids": [300]}, {"ids": [999]}, {"codes": ["a-9"]}, {"ids": [600], "domain": "Observation"},
        {"ids": [230], "exclude_ids": [230]},
    ],
)
def test_unusable_seeds_fail(source, bad):
    with pytest.raises(DataContractError):
        resolve_concepts(source, {"x": ConceptSet(**bad)})


def test_sets_follow_ancestors_and_exclusions(source):
    sets = {
        "whole": ConceptSet(codes=("a-0",)), "same": ConceptSet(ids=(210,)), "flat": ConceptSet(ids=(210,), descendants=False),
        "below": ConceptSet(ids=(210,), exclude_ids=(210,)), "without_mites": ConceptSet(ids=(210,), exclude_ids=(212,)),
        "two": ConceptSet(ids=(211, 230)),
    }
    found = {}
    for r in resolve_concepts(source, sets).collect():
        found.setdefault(r.feature, set()).add(r.concept_id)
    assert found == {"whole": {210, 211, 212}, "same": {210, 211, 212}, "flat": {210}, "below": {211, 212},
                     "without_mites": {210, 211}, "two": {211, 230}}


def test_survey_codes_are_found_in_any_spelling_and_must_be_unique(spark, source):
    pets = SurveyFeature(
        positive_codes={"pet-NOW": ("PET-yes",)}, negative_codes={"PET-now": ("pet-none",)},
        numeric_positive_above={600: 1}, numeric_positive_codes={"pet-now": 2},
    )
    row = resolve_surveys(source, {"pet": pets}).first()
    assert (row.question_id, row.positive, row.negative, row.threshold) == (600, [601], [602], 2.0)
    with pytest.raises(DataContractError):
        resolve_surveys(source, {"pet": SurveyFeature(positive_codes={"pet-now": ("pet-maybe",)})})
    twin = spark.createDataFrame([(650, "Kept a pet", "Observation", "PPI", "PET-NOW", None, None)], SCHEMAS["concept"])
    tables = {**source.tables, "concept": source.tables["concept"].unionByName(twin)}
    with pytest.raises(DataContractError):
        resolve_surveys(OmopSource(spark, tables), {"pet": pets})


def test_a_run_keeps_and_reuses_its_features(spark, source, tmp_path):
    study = StudySpec.from_dict(STUDY)
    run = StudyRun(spark, study, str(tmp_path / "run"))
    first = run.extract(source)
    again = StudyRun(spark, study, str(tmp_path / "run"))
    again.extract(source)
    assert again.feature_hash == run.feature_hash and first.count() == 5
    older = StudyRun(spark, StudySpec.from_dict({**STUDY, "version": "4", "minimum_age": 40}), str(tmp_path / "b"))
    older.reuse_features(run)
    groups = older.build_groups()
    assert groups.filter("is_case = 1").count() == 1 and groups.filter("is_case = 0").count() == 0
    changed = StudySpec.from_dict({**STUDY, "version": "5", "clinical_cutoff": "2018-12-31"})
    with pytest.raises(DataContractError):
        StudyRun(spark, changed, str(tmp_path / "c")).reuse_features(run)
    with pytest.raises(DataContractError):
        StudyRun(spark, changed, str(tmp_path / "run"))
