"""Queries for sources, vocabulary, predicates, joins, features and cohorts."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Window, functions as F

from cohortlane import ConceptSet, Predicate, StudySpec
from cohortlane.config import sensitivity_spec
from cohortlane.errors import DataContractError
from cohortlane.functions import scalars as sc
from cohortlane.functions.predicates import predicate_mask
from cohortlane.operators import cohorts, features as ft, vocabulary as vo
from cohortlane.operators.matching import caliper_join
from cohortlane.operators.release import ordered_by
from cohortlane.session import local_rows, scratch_folder
from cohortlane.sources import store
from cohortlane.sources.omop import CONTRACT

from .registry import query, rd
from .sql import CUTOFF, age_sql, oracle
from .study import CONDITION_SET, STUDY, classified_of, features_of, people_of, resolved_of, source_of, views_of

CUT = STUDY.clinical_cutoff


def folder(spark) -> str:
    """A new folder beside the session's checkpoints."""
    return f"{scratch_folder(spark)}/out-{uuid.uuid4().hex}"


# --- sources, sinks, checks ---------------------------------------------------------------------------------


@query("c1_schema_contract", oracle(" union all ".join(
    f"select '{t}' as table_name, cast({len(c)} as int) as columns, cast(0 as bigint) as problems, count(*) as rows from {t}"
    for t, c in CONTRACT.items()
)))
def c1(spark, d):
    source = views_of(spark, d)
    problems = source.schema_problems(STUDY).groupBy("table_name").agg(F.count("*").alias("problems"))
    sizes = None
    for name, columns in CONTRACT.items():
        part = source.table(name).agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table_name"), F.lit(len(columns)).alias("columns"), "rows"
        )
        sizes = part if sizes is None else sizes.unionByName(part)
    return sizes.join(F.broadcast(problems), "table_name", "left").select(
        "table_name", "columns", F.coalesce("problems", F.lit(0).cast("long")).alias("problems"), "rows"
    )


@query("c2_contract_scan", oracle(
    f"select person_id, measurement_concept_id, measurement_date, {rd('value_as_number')} as value_as_number, unit_concept_id from measurement"
))
def c2(spark, d):
    return source_of(spark, d).table("measurement")


@query("c3_repeated_keys", oracle(
    "select person_id, count(*) as rows from condition_occurrence group by person_id having count(*) > 1 or person_id is null"
))
def c3(spark, d):
    return ft.key_problems(source_of(spark, d).table("condition_occurrence"))


FEATURE_SQL = f"select * exclude (quantity), {rd('quantity')} as quantity from features"


@query("k1_k2_stored_frame", oracle(FEATURE_SQL))
def k1(spark, d):
    frames = store.FrameStore(spark, folder(spark))
    frames.save("features", features_of(spark, d), {"release": 1})
    assert frames.load("features", {"release": 2}) is None
    return frames.load("features", {"release": 1})


@query("k4_fingerprint", oracle(
    "select count(*) as n, true as order_free, true as multiset_aware from features"
))
def k4(spark, d):
    frame = features_of(spark, d)
    copies = {"one": frame, "again": frame.repartition(7).orderBy(F.desc("person_id")), "twice": frame.unionByName(frame)}
    prints = None
    for name, copy in copies.items():
        part = store.fingerprint_frame(copy).select(F.lit(name).alias("copy"), F.struct("n", "total", "parity").alias("print"))
        prints = part if prints is None else prints.unionByName(part)
    found = {name: F.max(F.when(F.col("copy") == name, F.col("print"))) for name in copies}
    return prints.agg(
        found["one"]["n"].alias("n"), (found["one"] == found["again"]).alias("order_free"),
        (found["one"]["total"] != found["twice"]["total"]).alias("multiset_aware"),
    )


@query("k5_csv_sink", oracle("select stage, n from flow", flow="""
    select 'source' as stage, count(*) as n from classified union all
    select 'eligible', count(*) from classified where eligible union all
    select 'cases', count(*) from classified where is_case = 1 union all
    select 'controls', count(*) from classified where is_case = 0 union all
    select 'excluded', count(*) from classified where reason is not null"""))
def k5(spark, d):
    path = folder(spark)
    store.write_csv(cohorts.flow_counts(classified_of(spark, d)).select("stage", "n"), path)
    return spark.read.schema("stage string, n long").option("header", True).csv(path)


@query("k6_json_sink", oracle("select reason, count(*) as n from classified where reason is not null group by reason"))
def k6(spark, d):
    path = folder(spark)
    table = cohorts.exclusions(classified_of(spark, d)).groupBy("reason").agg(F.count("*").alias("n"))
    store.write_json_records(table, path)
    return spark.read.schema("reason string, n long").json(path)


@query("k7_population_reuse", oracle(
    f"""select 'observation' as source, count(*) as n from observation where observation_date <= {CUTOFF}
          and person_id in (select person_id from ehr)
        union all select 'measurement', count(*) from measurement where measurement_date <= {CUTOFF}
          and person_id in (select person_id from ehr)"""
))
def k7(spark, d):
    population = features_of(spark, d).select(F.col("person_id").cast("long").alias("person_id"))
    source = source_of(spark, d)
    parts = []
    for name, date in (("observation", "observation_date"), ("measurement", "measurement_date")):
        rows = source.table(name).filter(F.col(date) <= F.lit(CUT)).join(population, "person_id", "left_semi")
        parts.append(rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("source"), "n"))
    return parts[0].unionByName(parts[1])


OLDER = sensitivity_spec(STUDY, version="older", minimum_age=30, maximum_age=60)


def flow_sql(minimum: int, maximum: int | None) -> str:
    over = f"when age_at_cutoff > {maximum} then 'above_maximum_age'" if maximum else ""
    return f"""select *, case when age is null or age_at_cutoff is null then 'missing_or_invalid_age'
        when age_at_cutoff < {minimum} then 'below_minimum_age' when ehr_record_count <= 0 then 'no_dated_ehr_evidence'
        {over} end as why from features"""


@query("k8_h5_variant_on_reused_features", oracle(
    """select version, cast(count(*) filter (why is null) as bigint) as eligible,
         count(*) filter (why is null and disease = 1) as cases,
         count(*) filter (why is null and any_disease = 0) as controls from both_versions group by version""",
    both_versions=f"""select '1' as version, * from ({flow_sql(18, None)})
        union all select 'older', * from ({flow_sql(30, 60)})""",
))
def k8(spark, d):
    assert OLDER.extraction_digest() == STUDY.extraction_digest()
    parts = []
    for study in (STUDY, OLDER):
        c = cohorts.classify(features_of(spark, d), study)
        parts.append(
            c.agg(
                F.count_if("eligible").alias("eligible"), F.count_if(F.col("is_case") == 1).alias("cases"),
                F.count_if(F.col("is_case") == 0).alias("controls"),
            ).withColumn("version", F.lit(study.version))
        )
    return parts[0].unionByName(parts[1])


# --- vocabulary ---------------------------------------------------------------------------------------------

SEEDS = {
    "brands": ConceptSet(ids=(500000001, 500000002), vocabulary="BRAND"),
    "codes": ConceptSet(codes=("P10", "P11", "P12"), vocabulary="PART", descendants=False),
    "unusable": ConceptSet(ids=(999999999, 9000001), codes=("brand#1", "nothing"), vocabulary="BRAND", descendants=False),
}
SEED_SQL = """select 'brands' as set_key, * from concept where concept_id in (500000001, 500000002)
    union all select 'codes', * from concept where vocabulary_id = 'PART' and concept_code in ('P10', 'P11', 'P12')
    union all select 'unusable', * from concept where concept_id = 9000001 or (vocabulary_id = 'BRAND' and concept_code = 'brand#1')"""


@query("v1_concept_seeds", oracle(SEED_SQL))
def v1(spark, d):
    return vo.concept_seeds(source_of(spark, d), SEEDS)


@query("v2_v3_seed_problems", oracle("""
    select 'unusable' as set_key, '999999999' as item, 'absent' as problem where not exists (select 1 from concept where concept_id = 999999999)
    union all select 'unusable', 'nothing', 'absent' where not exists (select 1 from concept where vocabulary_id = 'BRAND' and concept_code = 'nothing')
    union all select set_key, cast(concept_id as varchar),
      case when invalid_reason is not null then 'invalid' when domain_id <> 'Condition' then 'wrong domain' else 'not standard' end
    from seeds where invalid_reason is not null or domain_id <> 'Condition' or standard_concept is distinct from 'S'""",
    seeds=SEED_SQL))
def v2(spark, d):
    source = source_of(spark, d)
    return vo.seed_problems(source, SEEDS, vo.concept_seeds(source, SEEDS))


@query("v4_j6_descendants", oracle("""select c.concept_id, c.concept_name, c.vocabulary_id from concept c
    where c.concept_id in (select descendant_concept_id from concept_ancestor where ancestor_concept_id in (500000001, 500000002))
      or c.concept_id in (500000001, 500000002)"""))
def v4(spark, d):
    source = source_of(spark, d)
    seeds = local_rows(spark, [(i,) for i in SEEDS["brands"].ids], "ancestor_concept_id long")
    below = source.table("concept_ancestor").join(F.broadcast(seeds), "ancestor_concept_id", "left_semi")
    ids = below.select(F.col("descendant_concept_id").alias("concept_id")).union(seeds).distinct()
    return source.table("concept").join(ids, "concept_id", "left_semi").select(
        "concept_id", "concept_name", "vocabulary_id"
    )


@query("v5_v6_restricted_set", oracle("""select * from concept c where domain_id = 'Condition' and invalid_reason is null
      and standard_concept = 'S' and concept_id not in (500000003, 12)
      and (concept_id = 500000003 or concept_id in
        (select descendant_concept_id from concept_ancestor where ancestor_concept_id = 500000003)) order by concept_id"""))
def v5(spark, d):
    sets = {"x": ConceptSet(ids=(500000003,), vocabulary="BRAND", exclude_ids=(500000003, 12))}
    return vo.resolve_concepts(source_of(spark, d), sets).drop("feature").orderBy("concept_id")


@query("v7_shared_definitions", oracle("select feature, concept_id, concept_name from feature_concepts"))
def v7(spark, d):
    return resolved_of(spark, d)["concepts"].select("feature", "concept_id", "concept_name")


@query("v8_units", oracle("""select 'quantity' as feature, vocabulary_id, concept_id, concept_code, invalid_reason is null as valid
    from concept where vocabulary_id = 'UNIT' and concept_code = 'u0'"""))
def v8(spark, d):
    return vo.resolve_units(source_of(spark, d), STUDY.measurements)


@query("v9_survey_rules", oracle("""
    select 's1' as feature, q.concept_id as question_id, a.concept_id as answer_id,
      case when lower(a.concept_code) = 'answer_0' then 'negative' else 'positive' end as polarity, cast(null as double) as threshold
    from concept q join concept a on q.vocabulary_id = 'SURVEY' and a.vocabulary_id = 'SURVEY'
      and lower(q.concept_code) = 'question_0' and lower(a.concept_code) in ('answer_0', 'answer_1', 'answer_2')
    union all select 's1', concept_id, null, 'above', 100.0 from concept
    where vocabulary_id = 'SURVEY' and lower(concept_code) = 'question_2'"""))
def v9(spark, d):
    rules = resolved_of(spark, d)["surveys"]
    none = F.lit(None).cast("double").alias("threshold")
    parts = [
        rules.select("feature", "question_id", F.explode(side).alias("answer_id"), F.lit(side).alias("polarity"), none)
        for side in ("positive", "negative")
    ]
    above = rules.filter("threshold is not null").select(
        "feature", "question_id", F.lit(None).cast("long").alias("answer_id"), F.lit("above").alias("polarity"), "threshold"
    )
    return parts[0].unionByName(parts[1]).unionByName(above)


@query("v10_j3_demographic_names", oracle("select person_id, sex_at_birth, race, ethnicity from demographics"))
def v10(spark, d):
    return ft.demographics(source_of(spark, d), STUDY).select("person_id", "sex_at_birth", "race", "ethnicity")


# --- predicates -----------------------------------------------------------------------------------------------


def masks(name: str, rules: dict[str, dict], texts: dict[str, str]):
    """One boolean column per rule over every feature row; the oracle closes three-valued logic the same way."""
    columns = ", ".join(f"coalesce({text}, false) as {column}" for column, text in texts.items())

    @query(name, oracle(f"select person_id, {columns} from features"))
    def run(spark, d):
        frame = features_of(spark, d)
        return frame.select(
            "person_id", *[predicate_mask(frame, Predicate.from_dict(r)).alias(c) for c, r in rules.items()]
        )


def leaf(field, op="eq", value=None):
    return {"field": field, "op": op, "value": value}


masks("p1_equality", {
    "a": leaf("disease", value=1), "b": leaf("quantity", "ne", 10), "c": leaf("s1", value="yes"), "e": leaf("s1", "ne", 1),
}, {"a": "disease = 1", "b": "quantity <> 10", "c": "s1 = 'yes'", "e": "s1 is not null"})
masks("p2_ordering", {
    "a": leaf("quantity", "ge", 20), "b": leaf("quantity", "gt", 20), "c": leaf("age", "le", 40), "e": leaf("age", "lt", 40),
}, {"a": "quantity >= 20", "b": "quantity > 20", "c": "age <= 40", "e": "age < 40"})
masks("p3_membership", {
    "a": leaf("s1", "in", ["yes", "no"]), "b": leaf("s1", "not_in", ["yes", "no"]),
    "c": leaf("quantity", "in", [10, 20]), "e": leaf("quantity", "not_in", [10, 20]),
}, {"a": "s1 in ('yes', 'no')", "b": "s1 not in ('yes', 'no')", "c": "quantity in (10, 20)", "e": "quantity not in (10, 20)"})
masks("p4_missing", {
    "a": leaf("quantity", "is_missing"), "b": leaf("quantity", "not_missing"), "c": leaf("age", "is_missing"),
}, {"a": "quantity is null", "b": "quantity is not null", "c": "age is null"})
masks("p5_all_of", {"a": {"all_of": [leaf("age", "ge", 30), leaf("quantity", "gt", 5), leaf("exposed", value=1)]}},
      {"a": "age >= 30 and quantity > 5 and exposed = 1"})
masks("p6_any_of", {"a": {"any_of": [leaf("age", "ge", 60), leaf("quantity", "gt", 30), leaf("s1", value="yes")]}},
      {"a": "age >= 60 or quantity > 30 or s1 = 'yes'"})
masks("p7_negate", {
    "a": {"negate": leaf("quantity", "gt", 20)},
    "b": {"negate": {"any_of": [leaf("quantity", "gt", 20), leaf("age", "lt", 30)]}},
    "c": {"negate": {"negate": leaf("quantity", "gt", 20)}},
}, {"a": "not (quantity > 20)", "b": "not (quantity > 20 or age < 30)", "c": "quantity > 20"})
masks("p8_nested_mask", {
    "a": {"all_of": [{"negate": {"all_of": [leaf("age", "ge", 40), leaf("quantity", "ge", 20)]}},
                     {"any_of": [leaf("s1", "ne", "unknown"), leaf("disease", value=1)]}]},
}, {"a": "not (age >= 40 and quantity >= 20) and (s1 <> 'unknown' or disease = 1)"})
masks("p10_missing_literal", {
    "a": {"field": "quantity"}, "b": {"field": "quantity", "op": "ne"},
    "c": {"negate": {"field": "quantity"}}, "e": {"negate": {"field": "quantity", "op": "ne"}},
}, {"a": "false", "b": "quantity is not null", "c": "quantity is not null", "e": "false"})


#: Rules over the features; those after the first two name a column that the features lack, alone or deep inside.
COMPILED = {
    "known": leaf("age", "ge", 40),
    "known_inside": {"any_of": [leaf("disease", value=1), {"negate": leaf("s1", value="yes")}]},
    "alone": leaf("weight", "ge", 40),
    "missing": {"field": "weight", "op": "is_missing"},
    "inside": {"all_of": [leaf("age", "ge", 40), {"any_of": [leaf("disease", value=1), {"negate": leaf("height", value=1)}]}]},
    "other_case": leaf("Age_", "lt", 40),
}


@query("p9_unknown_fields", oracle("""select 'known' as rule, count(*) filter (age >= 40) as selected, cast(null as varchar) as error from features
    union all select 'known_inside', count(*) filter (disease = 1 or not (s1 = 'yes')), null from features
    union all select rule, null, 'A predicate names an unknown column: ' || field
      from (values ('alone', 'weight'), ('missing', 'weight'), ('inside', 'height'), ('other_case', 'Age_')) as t(rule, field)"""))
def p9(spark, d):
    """Rules with unknown columns are refused when they are compiled, before any row is read; the others select."""
    frame = features_of(spark, d)
    selected, refused = [], []
    for name, rule in COMPILED.items():
        try:
            selected.append(F.count_if(predicate_mask(frame, Predicate.from_dict(rule))).alias(name))
        except DataContractError as error:
            refused.append((name, None, str(error)))
    counted = frame.agg(*selected)
    counted = counted.unpivot([], counted.columns, "rule", "selected").withColumn("error", F.lit(None).cast("string"))
    return counted.union(local_rows(spark, refused, "rule string, selected long, error string"))


@query("p11_date_windows", oracle(f"""select count(*) filter (condition_start_date <= {CUTOFF}) as until,
      count(*) filter (condition_start_date <= {CUTOFF} and condition_start_date >= {CUTOFF} - 365) as lookback,
      count(*) filter (condition_start_date between {CUTOFF} - 30 and {CUTOFF}) as month from condition_occurrence"""))
def p11(spark, d):
    day, cut_off = F.col("condition_start_date"), F.lit(CUT)
    return source_of(spark, d).table("condition_occurrence").agg(
        F.count_if(day <= cut_off).alias("until"),
        F.count_if((day <= cut_off) & (day >= F.date_sub(cut_off, 365))).alias("lookback"),
        F.count_if(day.between(F.date_sub(cut_off, 30), cut_off)).alias("month"),
    )


@query("p12_ranges_and_lists", oracle("""select measurement_concept_id, count(*) as n from measurement
    where value_as_number between 5 and 45 and unit_concept_id in (700000001) group by 1"""))
def p12(spark, d):
    rows = source_of(spark, d).table("measurement")
    return rows.filter(F.col("value_as_number").between(5, 45) & F.col("unit_concept_id").isin(700000001)).groupBy(
        "measurement_concept_id").agg(F.count("*").alias("n"))


@query("p13_projection", oracle("select person_id, age as years, sex_at_birth as sex from features"))
def p13(spark, d):
    return features_of(spark, d).select("person_id", "age", "sex_at_birth", "race").withColumnsRenamed(
        {"age": "years", "sex_at_birth": "sex"}).drop("race")


# --- joins ------------------------------------------------------------------------------------------------------


@query("j1_people_with_evidence", oracle("select person_id, ehr_record_count from person join ehr using (person_id)"))
def j1(spark, d):
    source = source_of(spark, d)
    evidence = ft.dated_evidence(source, STUDY, resolved_of(spark, d)["concepts"])
    return source.table("person").join(evidence, "person_id").select("person_id", "ehr_record_count")


@query("j2_condition_features_left", oracle("select person_id, disease__days, exposed__first from features"))
def j2(spark, d):
    return features_of(spark, d).select("person_id", "disease__days", "exposed__first")


@query("j4_events_of_the_population", oracle(f"""select observation_source_concept_id as question_id, count(*) as n
    from observation where observation_date <= {CUTOFF} and person_id in (select person_id from ehr) group by 1"""))
def j4(spark, d):
    population = features_of(spark, d).select(F.col("person_id").cast("long").alias("person_id"))
    events = ft.survey_events(source_of(spark, d)).filter(F.col("event_date") <= F.lit(CUT))
    return events.join(population, "person_id", "left_semi").groupBy("question_id").agg(F.count("*").alias("n"))


@query("j5_measurement_units", oracle("""select u.concept_code as unit_code, count(*) as n, """ + rd("sum(value_as_number)") + """ as total
    from measurement m join concept u on u.concept_id = m.unit_concept_id where u.vocabulary_id = 'UNIT' group by 1"""))
def j5(spark, d):
    source = source_of(spark, d)
    units = source.table("concept").filter("vocabulary_id = 'UNIT'").select(
        F.col("concept_id").alias("unit_concept_id"), F.col("concept_code").alias("unit_code"))
    return source.table("measurement").join(F.broadcast(units), "unit_concept_id").groupBy("unit_code").agg(
        F.count("*").alias("n"), F.sum("value_as_number").alias("total"))


@query("j7_rows_of_a_concept_list", oracle(
    "select person_id, count(*) as n from condition_occurrence where condition_concept_id in (select concept_id from disease_set) group by 1"))
def j7(spark, d):
    ids = resolved_of(spark, d)["concepts"].filter("feature = 'disease'").select(
        F.col("concept_id").alias("condition_concept_id"))
    rows = source_of(spark, d).table("condition_occurrence")
    return rows.join(ids, "condition_concept_id", "left_semi").groupBy("person_id").agg(F.count("*").alias("n"))


@query("j8_u5_people_without_evidence", oracle(
    "select person_id from person where person_id not in (select person_id from ehr)"))
def j8(spark, d):
    known = features_of(spark, d).select(F.col("person_id").cast("long").alias("person_id"))
    return source_of(spark, d).table("person").join(known, "person_id", "left_anti").select("person_id")


@query("j9_one_to_one_merge", oracle("""select cast(d.person_id as varchar) as person_id, """ + rd("quantity") + """ as quantity
    from demographics d join ehr using (person_id) left join quantity using (person_id)"""))
def j9(spark, d):
    source, resolved = source_of(spark, d), resolved_of(spark, d)
    rows = ft.measurement_rows(source, STUDY, resolved["concepts"].filter("feature = 'quantity'"), resolved["units"])
    values = ft.reduce_measurements(rows, ["quantity"])
    people = features_of(spark, d).select("person_id")
    return people.join(ft.unique_people(values), "person_id", "left").select("person_id", "quantity")


REACH_SQL = """select c.person_id as case_id, count(k.person_id) as controls, """ + rd("min(abs(k.age - c.age))") + """ as nearest
    from people c left join people k on k.is_case = 0 and k.sex_at_birth = c.sex_at_birth and abs(k.age - c.age) <= 3
    where c.is_case = 1 group by 1"""


@query("j12_caliper_reach", oracle(REACH_SQL))
def j12(spark, d):
    """Controls within reach of each case, joined on distinct values with counts instead of person pairs."""
    values = ["sex_at_birth", "age"]
    people = people_of(spark, d)
    types = people.filter("is_case = 1").select(*values).distinct()
    cells = people.filter("is_case = 0").groupBy(*values).agg(F.count("*").alias("n"))
    met = caliper_join(types, cells, ["sex_at_birth"], {"age": 3.0}).groupBy(*values).agg(
        F.sum("n_control").alias("controls"), F.min(F.abs(F.col("age") - F.col("age_control"))).cast("double").alias("nearest"))
    cases = people.filter("is_case = 1").select(F.col("person_id").alias("case_id"), *values)
    return cases.join(met, values, "left").select(
        "case_id", F.coalesce("controls", F.lit(0)).cast("long").alias("controls"), "nearest")


@query("j12_two_calipers", oracle("""select c.person_id as case_id, count(k.person_id) as controls,
      coalesce(sum(abs(c.age - k.age) + abs(c.ehr_days - k.ehr_days)), 0) as apart
    from people c left join people k on k.is_case = 0 and abs(c.age - k.age) <= 2 and abs(c.ehr_days - k.ehr_days) <= 120.5
    where c.is_case = 1 group by 1"""))
def j12_two(spark, d):
    """Two calipers at once, no exact column: both are bands of the join key."""
    values = ["age", "ehr_days"]
    people = people_of(spark, d)
    types = people.filter("is_case = 1").select(*values).distinct()
    cells = people.filter("is_case = 0").groupBy(*values).agg(F.count("*").alias("n"))
    apart = F.abs(F.col("age") - F.col("age_control")) + F.abs(F.col("ehr_days") - F.col("ehr_days_control"))
    met = caliper_join(types, cells, [], {"age": 2.0, "ehr_days": 120.5}).groupBy(*values).agg(
        F.sum("n_control").alias("controls"), F.sum(apart * F.col("n_control")).alias("apart"))
    cases = people.filter("is_case = 1").select(F.col("person_id").alias("case_id"), *values)
    return cases.join(met, values, "left").select("case_id", *[
        F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("controls", "apart")])


@query("j14_role_overlap", oracle(
    "select person_id from features where disease = 1 and any_disease = 1"))
def j14(spark, d):
    """People in both of two deliberately overlapping groups."""
    overlapping = sensitivity_spec(STUDY, version="overlap", control=Predicate(field="any_disease", value=1),
                                   minimum_age=0)
    classified = cohorts.classify(features_of(spark, d), overlapping)
    both = classified.filter("overlap").select("person_id")
    rest = classified.filter("not eligible and disease = 1 and any_disease = 1").select("person_id")
    return both.unionByName(rest)


# --- scalars, windows, sorts, sets over the source --------------------------------------------------------------


@query("x1_calendar_age", oracle(f"""select person_id, {age_sql('birth_datetime', 2000, 2, 28)} as before_leap_day,
    {age_sql('birth_datetime', 2000, 2, 29)} as on_leap_day from person"""))
def x1(spark, d):
    return source_of(spark, d).table("person").select(
        "person_id",
        sc.age_on(F.col("birth_datetime"), dt.date(2000, 2, 28)).alias("before_leap_day"),
        sc.age_on(F.col("birth_datetime"), dt.date(2000, 2, 29)).alias("on_leap_day"))


@query("x2_dates", oracle(f"""select person_id, min(visit_start_date) - 30 as month_before,
    cast(max(visit_start_date) - min(visit_start_date) as int) as span from visit_occurrence group by 1"""))
def x2(spark, d):
    visits = source_of(spark, d).table("visit_occurrence")
    return visits.groupBy("person_id").agg(
        F.date_sub(F.min("visit_start_date"), 30).alias("month_before"),
        F.datediff(F.max("visit_start_date"), F.min("visit_start_date")).alias("span"))


@query("x3_x4_evidence_numbers", oracle(f"""select question_id, count(v) as numbers, {rd('sum(v)')} as total from (
    select observation_source_concept_id as question_id, case when isfinite(v) then v end as v from (
      select *, coalesce(value_as_number, try_cast(value_as_string as double)) as v from observation)) group by 1"""))
def x3(spark, d):
    value = sc.finite(sc.evidence_number(F.col("value_as_number"), F.col("value_as_string")))
    rows = ft.survey_events(source_of(spark, d)).select("question_id", value.alias("v"))
    return rows.groupBy("question_id").agg(F.count("v").alias("numbers"), F.sum("v").alias("total"))


@query("x5_x6_x7_text", oracle("""select lower(concept_code) as code, cast(concept_id as varchar) as concept_id,
    coalesce(standard_concept, 'none') as standard from concept"""))
def x5(spark, d):
    return source_of(spark, d).table("concept").select(
        F.lower("concept_code").alias("code"), F.col("concept_id").cast("string").alias("concept_id"),
        F.coalesce("standard_concept", F.lit("none")).alias("standard"))


@query("x8_survey_label", oracle("select cast(person_id as varchar) as person_id, s1 as label from features"))
def x8(spark, d):
    return features_of(spark, d).select("person_id", F.col("s1").alias("label"))


@query("x11_labels", oracle("""select distinct stage,
    upper(substr(replace(stage, '_', ' '), 1, 1)) || lower(substr(replace(stage, '_', ' '), 2)) as sentence
    from (select reason as stage from classified where reason is not null)"""))
def x11(spark, d):
    stages = cohorts.exclusions(classified_of(spark, d)).select(F.col("reason").alias("stage")).distinct()
    return stages.select("stage", sc.sentence_label(F.col("stage")).alias("sentence"))


@query("w1_latest_answers", oracle("""select person_id, observation_date as event_date, observation_source_concept_id as question_id,
    value_source_concept_id as answer_id from latest_answers"""))
def w1(spark, d):
    """All answers of each question's last day. The day comes from a combining aggregate, not a window."""
    rules = resolved_of(spark, d)["surveys"].select("question_id").distinct()
    rows = ft.survey_events(source_of(spark, d)).filter(F.col("event_date") <= F.lit(CUT)).join(
        F.broadcast(rules), "question_id")
    last = rows.groupBy("person_id", "question_id").agg(F.max("event_date").alias("event_date"))
    return rows.join(last, ["person_id", "question_id", "event_date"]).select(
        "person_id", "event_date", "question_id", "answer_id")


@query("w2_latest_valid_measurement", oracle(f"""select person_id, event_date, {rd('value')} as value from (
    select *, max(event_date) over (partition by person_id) as last from valid_measurements) where event_date = last"""))
def w2(spark, d):
    source, resolved = source_of(spark, d), resolved_of(spark, d)
    rows = ft.measurement_rows(source, STUDY, resolved["concepts"].filter("feature = 'quantity'"), resolved["units"])
    last = rows.groupBy("person_id").agg(F.max("event_date").alias("event_date"))
    return rows.join(last, ["person_id", "event_date"]).select("person_id", "event_date", "value")


@query("s1_canonical_order", oracle("""select person_id, is_case, row_number() over (order by is_case desc, person_id) as place
    from people"""))
def s1(spark, d):
    """Cases first, ids as text; places come from range partitions, so no task sorts everything."""
    from cohortlane.session import numbered

    people = people_of(spark, d).select("person_id", "is_case")
    return numbered(people, [], [F.col("is_case").desc(), F.col("person_id").asc()], "place")


@query("s2_listed_order", oracle("""select reason, n, row_number() over (order by case reason
      when 'neither_case_nor_control' then 0 when 'below_minimum_age' then 1 else 2 end, reason) as position
    from (select reason, count(*) as n from classified where reason is not null group by 1)"""))
def s2(spark, d):
    counts = cohorts.exclusions(classified_of(spark, d)).groupBy("reason").agg(F.count("*").alias("n"))
    counts = counts.withColumn("position", F.row_number().over(Window.orderBy("reason")))
    ordered = ordered_by(counts, "reason", ("neither_case_nor_control", "below_minimum_age"), "position")
    return ordered.select("reason", "n", F.col("position").cast("long").alias("position"))


@query("u1_g1_dated_events", oracle("select person_id, ehr_record_count, ehr_days from ehr"))
def u1(spark, d):
    return ft.dated_evidence(source_of(spark, d), STUDY, resolved_of(spark, d)["concepts"]).select(
        "person_id", "ehr_record_count", "ehr_days")


@query("u2_stacked_frames", oracle("""select person_id, is_case, cast(null as varchar) as reason from people
    union all select person_id, null, reason from classified where reason is not null"""))
def u2(spark, d):
    classified = classified_of(spark, d)
    people = cohorts.cases_and_controls(classified).select("person_id", "is_case")
    return people.unionByName(cohorts.exclusions(classified), allowMissingColumns=True)


@query("u3_distinct_days", oracle("select distinct person_id, condition_start_date from condition_occurrence"))
def u3(spark, d):
    return source_of(spark, d).table("condition_occurrence").select("person_id", "condition_start_date").distinct()


# --- features and cohorts -----------------------------------------------------------------------------------------

CONDITION_COLUMNS = [
    f"{n}{s}" for n in STUDY.conditions for s in ("__days", "__first", "__last", "__span", "")
]


@query("f1_condition_features", oracle(f"select person_id, {', '.join(CONDITION_COLUMNS)} from features"))
def f1(spark, d):
    source = source_of(spark, d)
    frame = ft.dated_evidence(source, STUDY, resolved_of(spark, d)["concepts"])
    people = source.table("person").select("person_id")
    return people.join(frame, "person_id").select(F.col("person_id").cast("string").alias("person_id"), *CONDITION_COLUMNS)


LOOKBACK = StudySpec.from_dict({
    **STUDY.to_dict(), "version": "lookback",
    "conditions": {
        "recent": {"concepts": CONDITION_SET, "lookback_days": 400},
        "any_disease": {"concepts": CONDITION_SET},
        "disease": {"concepts": CONDITION_SET},
    },
})


@query("f1_lookback", oracle(f"""select e.person_id, case when c.person_id is not null then coalesce(n, 0) end as recent__days
    from ehr e left join (select distinct person_id from condition_occurrence where condition_start_date <= {CUTOFF}) c using (person_id)
    left join (select person_id, count(distinct condition_start_date) as n from condition_occurrence
      where condition_concept_id in (select concept_id from disease_set)
        and condition_start_date between {CUTOFF} - 400 and {CUTOFF} group by 1) using (person_id)"""))
def f1_lookback(spark, d):
    concepts = resolved_of(spark, d)["concepts"].filter("feature in ('disease', 'any_disease')")
    recent = concepts.filter("feature = 'disease'").withColumn("feature", F.lit("recent"))
    frame = ft.dated_evidence(source_of(spark, d), LOOKBACK, concepts.unionByName(recent))
    return frame.select("person_id", "recent__days")


@query("f2_record_evidence", oracle("select person_id, ehr_record_count, ehr_days from features"))
def f2(spark, d):
    return features_of(spark, d).select("person_id", "ehr_record_count", "ehr_days")


@query("f3_demographics", oracle("select * from demographics"))
def f3(spark, d):
    return ft.demographics(source_of(spark, d), STUDY)


@query("f4_survey_feature", oracle("""select person_id, case when positive and negative then 'conflict' when positive then 'yes'
    when negative then 'no' else 'unknown' end as s1 from s1"""))
def f4(spark, d):
    return ft.reduce_surveys(
        ft.survey_events(source_of(spark, d)), resolved_of(spark, d)["surveys"], STUDY.surveys, CUT)


@query("f5_g5_measurement_feature", oracle(f"select person_id, {rd('quantity')} as quantity from quantity"))
def f5(spark, d):
    source, resolved = source_of(spark, d), resolved_of(spark, d)
    rows = ft.measurement_rows(source, STUDY, resolved["concepts"].filter("feature = 'quantity'"), resolved["units"])
    return ft.reduce_measurements(rows, ["quantity"])


@query("f6_feature_frame", oracle(FEATURE_SQL))
def f6(spark, d):
    return ft.extract_features(source_of(spark, d), STUDY, resolved_of(spark, d))


@query("h1_w6_exclusion_reasons", oracle("select person_id, reason from classified where not eligible"))
def h1(spark, d):
    frame = features_of(spark, d)
    return frame.select("person_id", cohorts.exclusion_reason(frame, STUDY).alias("reason")).filter("reason is not null")


@query("h2_cases_and_controls", oracle("select person_id, is_case, age, sex_at_birth from people"))
def h2(spark, d):
    return people_of(spark, d).select("person_id", "is_case", "age", "sex_at_birth")


@query("h3_exclusions", oracle("select person_id, reason from classified where reason is not null"))
def h3(spark, d):
    return cohorts.exclusions(cohorts.build_cohorts(features_of(spark, d), STUDY))


@query("h4_g16_flow", oracle("""select * from (
    select 0 as position, 'source' as stage, count(*) as n from classified union all
    select 1, 'eligible', count(*) from classified where eligible union all
    select 2, 'cases', count(*) from classified where is_case = 1 union all
    select 3, 'controls', count(*) from classified where is_case = 0 union all
    select 4, 'excluded', count(*) from classified where reason is not null)"""))
def h4(spark, d):
    return cohorts.flow_counts(classified_of(spark, d))
