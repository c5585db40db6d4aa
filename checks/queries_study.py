"""Queries for matching, balance, models, summaries, screening and release."""

from __future__ import annotations

import json
import math

from pyspark.sql import Window, functions as F

from cohortlane import MatchSpec, ModelSpec, Predicate, PublicationSpec, ReportSpec
from cohortlane.config import sensitivity_spec
from cohortlane.functions import scalars as sc
from cohortlane.operators import matching as mt, models as md, release as rl, screening as sr, summaries as sm
from cohortlane.operators.balance import balance_table, person_weights
from cohortlane.operators.cohorts import flow_counts
from cohortlane.operators.provenance import reviewed
from cohortlane.plans.study_run import build_report, load_report, save_report

from .queries_data import folder
from .registry import query, rd
from .sql import greedy, oracle
from .study import MATCHING, STUDY, classified_of, features_of, kept, matched_of, people_of, results_of

SPEC = MatchSpec.from_dict(MATCHING)
SPEC_R4 = MatchSpec.from_dict({**MATCHING, "ratio": 4})


def members_of(spark, d, **changes):
    return matched_of(spark, d, **changes).members


# --- matching -------------------------------------------------------------------------------------------------


@query("m1_match_pool", oracle("""select person_id, is_case, age is not null and quantity is not null as valid from people"""))
def m1(spark, d):
    spec = MatchSpec(exact=("sex_at_birth",), distance=("age", "quantity"))
    return mt.match_pool(people_of(spark, d), spec).select("person_id", "is_case", "valid")


@query("m2_exact_strata", oracle("""select cast(to_json([sex_at_birth, race]) as varchar) as stratum,
    count(*) filter (is_case = 1) as cases, count(*) filter (is_case = 0) as controls from people group by 1"""))
def m2(spark, d):
    spec = MatchSpec(exact=("sex_at_birth", "race"))
    return mt.with_stratum(people_of(spark, d), spec).groupBy("stratum").agg(
        F.count_if(F.col("is_case") == 1).alias("cases"), F.count_if(F.col("is_case") == 0).alias("controls"))


def edges(spark, d, spec, limits=mt.MatchLimits()):
    pool = mt.match_pool(people_of(spark, d), spec)
    space = mt.geometry(pool.filter("valid"), spec)
    core = mt.core_pool(pool, spec, space)
    return mt.match_edges(core, spec, space, limits).select("case_id", F.col("slot").cast("long").alias("slot"), "control_id")


@query("m3_j13_mahalanobis_nearest", oracle("""select case_id, slot, control_id from (
      select c.person_id as case_id, k.person_id as control_id, row_number() over (partition by c.person_id
        order by s22 * (c.age - k.age) * (c.age - k.age) - 2 * s12 * (c.age - k.age) * (c.ehr_days - k.ehr_days)
          + s11 * (c.ehr_days - k.ehr_days) * (c.ehr_days - k.ehr_days), k.person_id) as slot
      from people c join people k on c.is_case = 1 and k.is_case = 0 and c.sex_at_birth = k.sex_at_birth cross join pooled)
    where slot <= 3""", pooled="""
      select sum((n - 1) * v11) / sum(n - 1) as s11, sum((n - 1) * v12) / sum(n - 1) as s12, sum((n - 1) * v22) / sum(n - 1) as s22
      from (select count(*) as n, var_samp(age) as v11, covar_samp(age, ehr_days) as v12, var_samp(ehr_days) as v22
        from people group by is_case)"""))
def m3(spark, d):
    return edges(spark, d, MatchSpec(exact=("sex_at_birth",), distance=("age", "ehr_days"), ratio=3, replace=True))


THREE_COLUMNS = {
    "distance_rows": """select is_case, person_id, cast(age as double) as x, cast(ehr_days as double) as y,
          cast(sex_at_birth <> (select min(sex_at_birth) from people) as double) as z from people""",
    "pooled3": """select sum((n - 1) * xx) / sum(n - 1) as xx, sum((n - 1) * xy) / sum(n - 1) as xy,
          sum((n - 1) * xz) / sum(n - 1) as xz, sum((n - 1) * yy) / sum(n - 1) as yy,
          sum((n - 1) * yz) / sum(n - 1) as yz, sum((n - 1) * zz) / sum(n - 1) as zz
        from (select count(*) as n, var_samp(x) as xx, covar_samp(x, y) as xy, covar_samp(x, z) as xz,
          var_samp(y) as yy, covar_samp(y, z) as yz, var_samp(z) as zz from distance_rows group by is_case)""",
    # Cofactors: the inverse but for the determinant, which orders nothing.
    "cofactors": """select yy * zz - yz * yz as a, xx * zz - xz * xz as b, xx * yy - xy * xy as c,
          xz * yz - xy * zz as ab, xy * yz - xz * yy as ac, xy * xz - xx * yz as bc from pooled3""",
}


@query("m3_grid_with_factor", oracle("""select case_id, slot, control_id from (
      select c.person_id as case_id, k.person_id as control_id, row_number() over (partition by c.person_id
        order by round(a * (c.x - k.x) * (c.x - k.x) + b * (c.y - k.y) * (c.y - k.y) + f.c * (c.z - k.z) * (c.z - k.z)
          + 2 * ab * (c.x - k.x) * (c.y - k.y) + 2 * ac * (c.x - k.x) * (c.z - k.z) + 2 * bc * (c.y - k.y) * (c.z - k.z), 3),
          k.person_id) as slot
      from distance_rows c join distance_rows k on c.is_case = 1 and k.is_case = 0 cross join cofactors f)
    where slot <= 4""", **THREE_COLUMNS))
def m3_grid(spark, d):
    """The path of large strata: one stratum of everybody, two numbers and a factor, blocks of a grid."""
    spec = MatchSpec(distance=("age", "ehr_days", "sex_at_birth"), categorical=("sex_at_birth",), ratio=4, replace=True)
    return edges(spark, d, spec, mt.MatchLimits(stratum_rows=1, window=16))


def logistic_newton(steps: int) -> dict[str, str]:
    """Unrolled Newton steps of role on age, centred at 40, in SQL."""
    ctes = {"logit_0": "select cast(0 as double) as b0, cast(0 as double) as b1"}
    for k in range(1, steps + 1):
        ctes[f"logit_{k}"] = f"""select b0 + (i11 * g0 - i01 * g1) / (i00 * i11 - i01 * i01) as b0,
              b1 + (i00 * g1 - i01 * g0) / (i00 * i11 - i01 * i01) as b1
            from (select any_value(b0) as b0, any_value(b1) as b1, sum(is_case - p) as g0, sum((is_case - p) * x) as g1,
                sum(p * (1 - p)) as i00, sum(p * (1 - p) * x) as i01, sum(p * (1 - p) * x * x) as i11
              from (select is_case, age - 40 as x, b0, b1, 1 / (1 + exp(-(b0 + b1 * (age - 40)))) as p
                from people cross join logit_{k - 1}))"""
    return ctes


@query("m4_propensity_nearest", oracle("""select case_id, slot, control_id from (
      select c.person_id as case_id, k.person_id as control_id,
        row_number() over (partition by c.person_id order by abs(c.l - k.l), k.person_id) as slot
      from scored c join scored k on c.is_case = 1 and k.is_case = 0 cross join width where abs(c.l - k.l) <= w)
    where slot <= 2""", **logistic_newton(8),
    scored="select person_id, is_case, round(b0 - 40 * b1 + b1 * age, 9) as l from people cross join logit_8",
    width="""select round(0.2 * sqrt((max(v) filter (is_case = 1) + max(v) filter (is_case = 0)) / 2), 9) as w
      from (select is_case, var_samp(l) as v from scored group by 1)"""))
def m4(spark, d):
    return edges(spark, d, MatchSpec(method="propensity", distance=("age",), ratio=2, replace=True))


EDGE_SQL = "select case_id, slot, control_id from "


@query("m5_s3_greedy_ratio_2", oracle(EDGE_SQL + "edges_r2"))
def m5(spark, d):
    return edges(spark, d, SPEC)


@query("m5_greedy_ratio_4", oracle(EDGE_SQL + "edges_r4"))
def m5_r4(spark, d):
    return edges(spark, d, SPEC_R4)


@query("m5_w7_greedy_in_chunks", oracle(EDGE_SQL + "edges_r4"))
def m5_chunks(spark, d):
    """The path of large strata, forced on every stratum: same edges."""
    return edges(spark, d, SPEC_R4, mt.MatchLimits(stratum_rows=1, chunk=4000))


@query("m5_greedy_one_stratum", oracle(EDGE_SQL + "edges_one", **greedy("one", 2, "abs(k.age - a.age) <= 3")))
def m5_one_stratum(spark, d):
    """Without exact columns everybody is one stratum; served in rounds, cells from the blocks of a grid."""
    spec = MatchSpec(distance=("age",), calipers={"age": 3}, ratio=2)
    return edges(spark, d, spec, mt.MatchLimits(stratum_rows=1, stratum_pairs=0, chunk=120, window=8))


@query("m6_replacement_grid", oracle(EDGE_SQL + "edges_rep"))
def m6_grid(spark, d):
    """The path of large strata, forced on every stratum: same edges."""
    spec = MatchSpec.from_dict({**MATCHING, "replace": True})
    return edges(spark, d, spec, mt.MatchLimits(stratum_rows=1, window=2))


@query("m6_replacement", oracle(EDGE_SQL + "edges_rep"))
def m6(spark, d):
    return edges(spark, d, MatchSpec.from_dict({**MATCHING, "replace": True}))


@query("m7_minimum_controls", oracle("""select match_set_id, cast(count(*) - 1 as bigint) as controls from members_r4
    group by 1 having count(*) - 1 >= 3"""))
def m7(spark, d):
    members = members_of(spark, d, ratio=4, minimum_controls=3)
    return members.groupBy("match_set_id").agg((F.count("*") - 1).alias("controls"))


@query("m8_set_layout", oracle(f"""select person_id, match_set_id, is_case, control_order, {rd('weight')} as weight, age, exposed
    from members"""))
def m8(spark, d):
    return members_of(spark, d).select("person_id", "match_set_id", "is_case", "control_order", "weight", "age", "exposed")


@query("m9_unmatched_cases", oracle("""select person_id, 'no_sufficient_eligible_controls' as reason from people where is_case = 1
    and person_id not in (select case_id from edges_r4 group by 1 having count(*) >= 3)"""))
def m9(spark, d):
    return matched_of(spark, d, ratio=4, minimum_controls=3).unmatched


@query("m10_criteria_violations", oracle("""select match_set_id, problem from (
      select match_set_id, 'controls' as problem from members_r4 group by 1 having count(*) - 1 not between 3 and 4
      union all select match_set_id, 'caliper age' from members_r4 group by 1 having max(abs(match_difference_age)) > 1
      union all select match_set_id, 'exact race' from members_r4 group by 1
        having count(distinct race) > 1)"""))
def m10(spark, d):
    """Sets of the ratio-4 match that would break stricter rules."""
    strict = MatchSpec(exact=("sex_at_birth", "race"), calipers={"age": 1}, ratio=4, minimum_controls=3)
    return mt.criteria_violations(members_of(spark, d, ratio=4), strict)


@query("m11_membership_violations", oracle("""
    select 'null identifiers' as problem, count(*) filter (person_id is null or match_set_id is null or is_case is null) as n from members_rep
    union all select 'roles', count(*) filter (is_case not in (0, 1)) from members_rep
    union all select 'repeated in a set', count(*) from (select 1 from members_rep group by match_set_id, person_id having count(*) > 1)
    union all select 'set composition', count(*) from (select 1 from members_rep group by match_set_id having sum(is_case) <> 1 or count(*) < 2)
    union all select 'reused', count(*) from (select 1 from members_rep group by person_id having count(*) > 1)"""))
def m11(spark, d):
    return mt.membership_violations(members_of(spark, d, replace=True))


@query("m12_j11_caliper_differences", oracle("select match_set_id, person_id, cast(match_difference_age as int) as match_difference_age from members"))
def m12(spark, d):
    return members_of(spark, d).select("match_set_id", "person_id", "match_difference_age")


@query("m13_matching_summary", oracle("""select (select count(*) from members where is_case = 1) as matched_cases,
    (select count(*) from members where is_case = 0) as controls,
    (select count(*) from people where is_case = 1 and age is null) as missing_case_match_features,
    (select count(*) from people where is_case = 0 and age is null) as missing_control_match_features,
    (select count(*) from people where is_case = 1 and person_id not in (select case_id from edges_r2)) as unmatched_cases"""))
def m13(spark, d):
    return matched_of(spark, d).summary


@query("j10_carried_features", oracle(f"select match_set_id, person_id, race, {rd('quantity')} as quantity, ehr_days from members_rep"))
def j10(spark, d):
    return members_of(spark, d, replace=True).select("match_set_id", "person_id", "race", "quantity", "ehr_days")


# --- aggregates and windows over sets ------------------------------------------------------------------------


@query("g2_g3_distinct_days", oracle("select person_id, disease__days, disease__first, disease__last from features"))
def g2(spark, d):
    return features_of(spark, d).select("person_id", "disease__days", "disease__first", "disease__last")


@query("g4_any_per_set", oracle("""select match_set_id, bool_or(exposed = 1) as any_exposed,
    bool_or(exposed = 1 and is_case = 0) as any_exposed_control from members group by 1"""))
def g4(spark, d):
    exposed = F.col("exposed") == 1
    return members_of(spark, d).groupBy("match_set_id").agg(
        F.bool_or(exposed).alias("any_exposed"), F.bool_or(exposed & (F.col("is_case") == 0)).alias("any_exposed_control"))


@query("g6_set_sums", oracle("select match_set_id, cast(sum(is_case) as bigint) as cases, count(*) as size from members group by 1"))
def g6(spark, d):
    return members_of(spark, d).groupBy("match_set_id").agg(F.sum("is_case").alias("cases"), F.count("*").alias("size"))


@query("g7_achieved_ratios", oracle("""select controls, count(*) as sets from (
    select count(*) - 1 as controls from members_r4 group by match_set_id) group by 1"""))
def g7(spark, d):
    return matched_of(spark, d, ratio=4).ratios


@query("g8_varies_within_set", oracle("""select match_set_id, min(exposed) <> max(exposed) as exposed, min(age) <> max(age) as age,
    min(sex_at_birth) <> max(sex_at_birth) as sex from members group by 1"""))
def g8(spark, d):
    def varies(c):
        return F.min(c) != F.max(c)

    return members_of(spark, d).groupBy("match_set_id").agg(
        varies("exposed").alias("exposed"), varies("age").alias("age"), varies("sex_at_birth").alias("sex"))


@query("g9_role_by_predictor", oracle(" union all ".join(
    f"""select '{p}' as predictor, count(*) filter (is_case = 0 and {p} = 0) as cell_00, count(*) filter (is_case = 0 and {p} = 1) as cell_01,
      count(*) filter (is_case = 1 and {p} = 0) as cell_10, count(*) filter (is_case = 1 and {p} = 1) as cell_11 from members"""
    for p in ("exposed", "disease")
)))
def g9(spark, d):
    return sr.role_tables(members_of(spark, d), ["exposed", "disease"])


@query("g10_moments_and_quartiles", oracle(f"""select is_case, {rd('avg(ehr_days)')} as mean, {rd('stddev_samp(ehr_days)')} as sd,
    {rd('quantile_cont(ehr_days, 0.25)')} as q1, {rd('quantile_cont(ehr_days, 0.5)')} as median,
    {rd('quantile_cont(ehr_days, 0.75)')} as q3 from people group by 1"""))
def g10(spark, d):
    rows = people_of(spark, d).select(
        F.col("is_case").cast("string").alias("group"), F.lit("ehr_days").alias("variable"), F.col("ehr_days").cast("double").alias("x"))
    moments = rows.groupBy("group").agg(F.avg("x").alias("mean"), F.stddev_samp("x").alias("sd"))
    return moments.join(sm.quartiles(rows), "group").select(
        F.col("group").cast("int").alias("is_case"), "mean", "sd", "q1", "median", "q3")


@query("g12_g13_person_weights", oracle(f"select person_id, {rd('sum(weight)')} as w from members_rep group by 1"))
def g13(spark, d):
    return person_weights(members_of(spark, d, replace=True))


@query("g14_score_and_information", oracle(f"""select {rd('sum(case when is_case = 1 then exposed - mean end)')} as score,
      {rd('sum(case when is_case = 1 then square - mean * mean end)')} as information from (
      select *, avg(exposed) over (partition by match_set_id) as mean,
        avg(exposed * exposed) over (partition by match_set_id) as square from members)"""))
def g14(spark, d):
    """Score and information of the conditional likelihood at zero, from per-set sums."""
    sets = members_of(spark, d).groupBy("match_set_id").agg(
        F.sum(F.when(F.col("is_case") == 1, F.col("exposed"))).alias("x"),
        F.avg("exposed").alias("mean"), F.avg(F.col("exposed") * F.col("exposed")).alias("square"))
    return sets.agg(
        F.sum(F.col("x") - F.col("mean")).alias("score"),
        F.sum(F.col("square") - F.col("mean") * F.col("mean")).alias("information"))


@query("g15_constant_columns", oracle("""select min(sex_at_birth) = max(sex_at_birth) as sex_at_birth, min(disease) = max(disease) as disease,
    min(any_disease) = max(any_disease) as any_disease from people where is_case = 1"""))
def g15(spark, d):
    cases = people_of(spark, d).filter("is_case = 1")
    return cases.agg(*[(F.min(c) == F.max(c)).alias(c) for c in ("sex_at_birth", "disease", "any_disease")])


@query("w3_set_centred_values", oracle(f"select match_set_id, person_id, {rd('age - avg(age) over (partition by match_set_id)')} as centred from members"))
def w3(spark, d):
    mean = F.avg("age").over(Window.partitionBy("match_set_id"))
    return members_of(spark, d).select("match_set_id", "person_id", (F.col("age") - mean).alias("centred"))


@query("w4_x14_control_order", oracle("select 'set_' || case_id as match_set_id, control_id as person_id, cast(slot as int) as control_order from edges_r4"))
def w4(spark, d):
    return members_of(spark, d, ratio=4).filter("is_case = 0").select("match_set_id", "person_id", "control_order")


@query("u4_distinct_people", oracle("select distinct person_id, is_case from members_rep"))
def u4(spark, d):
    return sm.distinct_people(members_of(spark, d, replace=True), [])


# --- scalars over people ----------------------------------------------------------------------------------------


@query("x9_transforms", oracle(f"""select person_id, {rd('exp(age / 100.0)')} as e, {rd('sqrt(ehr_days)')} as r,
    {rd('ln((age / 100.0) / (1 - age / 100.0))')} as logit from people where age between 1 and 99"""))
def x9(spark, d):
    share = F.col("age") / 100.0
    return people_of(spark, d).filter("age between 1 and 99").select(
        "person_id", F.exp(share).alias("e"), F.sqrt("ehr_days").alias("r"), F.log(share / (1 - share)).alias("logit"))


@query("x10_indicators", oracle(f"""select person_id, {rd("cast(race = 'Race AMERICA' as int)")} as america,
    {rd("cast(race = 'Race ASIA' as int)")} as asia from people"""))
def x10(spark, d):
    people = people_of(spark, d)
    levels = mt.factor_levels(people, ["race"])["race"]
    marks = [(F.col("race") == level).cast("double").alias(level.split()[-1].lower()) for level in levels[1:]]
    return people.select("person_id", *marks).select("person_id", "america", "asia")


@query("x12_number_text", oracle("""select reason, n, format('{:,}', n) as thousands, printf('%.3f', n / 7.0) as fixed,
    case when 1.0 / (n * n) < 0.001 then '<0.001' else printf('%.3f', 1.0 / (n * n)) end as p from (
    select reason, count(*) as n from classified where reason is not null group by 1)"""))
def x12(spark, d):
    counts = classified_of(spark, d).filter("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))
    n = F.col("n")
    return counts.select("reason", "n", sc.thousands(n).alias("thousands"), sc.fixed(n / 7.0, 3).alias("fixed"),
                         sc.p_text(1.0 / (n * n)).alias("p"))


@query("x13_composite_keys", oracle("""select cast(to_json([race, cast(quantity as varchar)]) as varchar) as composite, count(*) as n
    from people group by race, quantity"""))
def x13(spark, d):
    keys = people_of(spark, d).groupBy("race", "quantity").agg(F.count("*").alias("n"))
    return keys.select(F.to_json(F.array("race", F.col("quantity").cast("string"))).alias("composite"), "n")


# --- balance -----------------------------------------------------------------------------------------------------

WEIGHTED = """select p.*, coalesce(w, 0) as w from people p left join (
    select person_id, sum(weight) as w from {members} group by 1) using (person_id)"""
AGE_BALANCE = f"""select 'age' as variable, 'Contin.' as type,
    {rd('(avg(age) filter (is_case = 1) - avg(age) filter (is_case = 0)) / stddev_samp(age) filter (is_case = 1)')} as diff_before,
    {rd('var_samp(age) filter (is_case = 1) / var_samp(age) filter (is_case = 0)')} as v_ratio_before,
    {rd('(any_value(m1) - any_value(m0)) / stddev_samp(age) filter (is_case = 1)')} as diff_after,
    {rd('''(sum(w * (age - m1) * (age - m1)) filter (is_case = 1) * sum(w) filter (is_case = 1)
        / (sum(w) filter (is_case = 1) * sum(w) filter (is_case = 1) - sum(w * w) filter (is_case = 1)))
      / (sum(w * (age - m0) * (age - m0)) filter (is_case = 0) * sum(w) filter (is_case = 0)
        / (sum(w) filter (is_case = 0) * sum(w) filter (is_case = 0) - sum(w * w) filter (is_case = 0)))''')} as v_ratio_after
    from weighted cross join (select sum(w * age) filter (is_case = 1) / sum(w) filter (is_case = 1) as m1,
      sum(w * age) filter (is_case = 0) / sum(w) filter (is_case = 0) as m0 from weighted)"""


def level_balance(column: str, levels: str) -> str:
    return f"""select '{column}_' || l as variable, 'Binary' as type, {rd('(p1 - p0) / sqrt(p1 * (1 - p1))')} as diff_before,
        cast(null as double) as v_ratio_before, {rd('(q1 - q0) / sqrt(p1 * (1 - p1))')} as diff_after, cast(null as double) as v_ratio_after
      from (select l, avg(cast({column} = l as int)) filter (is_case = 1) as p1, avg(cast({column} = l as int)) filter (is_case = 0) as p0,
          sum(w * cast({column} = l as int)) filter (is_case = 1) / sum(w) filter (is_case = 1) as q1,
          sum(w * cast({column} = l as int)) filter (is_case = 0) / sum(w) filter (is_case = 0) as q0
        from weighted cross join (select distinct {column} as l from people {levels}) group by l)"""


SECOND_SEX = "where sex_at_birth > (select min(sex_at_birth) from people)"


@query("b1_b2_b3_balance", oracle(AGE_BALANCE + " union all " + level_balance("sex_at_birth", SECOND_SEX),
                                  weighted=WEIGHTED.format(members="members_r4")))
def b1(spark, d):
    return matched_of(spark, d, ratio=4).balance


@query("b4_b5_factor_levels", oracle(
    AGE_BALANCE + " union all " + level_balance("sex_at_birth", SECOND_SEX) + " union all " + level_balance("race", "")
    + " union all select 'site', 'Constant', null, null, null, null",
    weighted=WEIGHTED.format(members="members_rep")))
def b4(spark, d):
    matched = matched_of(spark, d, replace=True)
    spec = MatchSpec(exact=("sex_at_birth", "race", "site"), distance=("age",))
    return balance_table(matched.pool.withColumn("site", F.lit("one")), matched.members, spec)


@query("b6_r9_shown_balance", oracle(
    f"""select variable as "Variable", case when not small then type end as "Type",
      case when not small then abs(diff_before) end as "Absolute SMD before", case when not small then v_ratio_before end as "Variance ratio before",
      case when not small then abs(diff_after) end as "Absolute SMD after", case when not small then v_ratio_after end as "Variance ratio after",
      small as suppressed from ({AGE_BALANCE} union all {level_balance("sex_at_birth", SECOND_SEX)})
      cross join (select count(*) filter (is_case = 1) between 1 and 20 or count(*) filter (is_case = 0) between 1 and 20 as small from members)""",
    weighted=WEIGHTED.format(members="members")))
def b6(spark, d):
    matched = matched_of(spark, d)
    return sr.screened_balance(matched.balance, matched.summary)


# --- models --------------------------------------------------------------------------------------------------------

RESTRICTED = ModelSpec(
    name="restricted", predictors=("exposed",), covariates=("quantity",),
    restriction=Predicate(field="age", op="ge", value=30))


@query("a1_a2_attrition", oracle("""select cast(sum(n) as bigint) as rows_before, cast(coalesce(sum(complete) filter (good), 0) as bigint) as rows_analyzed,
      count(*) as sets_before, count(*) filter (good) as sets_analyzed,
      cast(sum(n) - coalesce(sum(complete) filter (good), 0) as bigint) as rows_removed, count(*) - count(*) filter (good) as sets_removed,
      cast(sum(n - n_kept) as bigint) as rows_removed_by_restriction
    from (select *, cases = 1 and complete >= 2 as good from (select count(*) as n, count(*) filter (age >= 30) as n_kept,
        count(*) filter (age >= 30 and quantity is not null) as complete,
        count(*) filter (age >= 30 and quantity is not null and is_case = 1) as cases from members group by match_set_id))"""))
def a1(spark, d):
    return md.attrition(md.packed_sets(members_of(spark, d), RESTRICTED, "exposed"))


@query("a3_sample_counts", oracle("""select count(*) filter (is_case = 1) as cases_analyzed, count(*) filter (is_case = 0) as controls_analyzed,
      count(*) filter (is_case = 1 and exposed = 1) as case_with_condition, count(*) filter (is_case = 1 and exposed = 0) as case_without_condition,
      count(*) filter (is_case = 0 and exposed = 1) as control_with_condition, count(*) filter (is_case = 0 and exposed = 0) as control_without_condition,
      (select count(*) from (select 1 from members group by match_set_id having min(exposed) < max(exposed))) as discordant_sets,
      count(*) filter (exposed not in (0, 1)) as not_binary from members"""))
def a3(spark, d):
    return md.sample_counts(md.packed_sets(members_of(spark, d), STUDY.models[0], "exposed"))


def conditional_newton(steps: int, members: str) -> dict[str, str]:
    """Unrolled Newton steps of the conditional likelihood in exposure and age, in SQL."""
    ctes = {
        "gaps": f"""select k.match_set_id, k.exposed - c.exposed as x, k.age - c.age as z from {members} k
            join {members} c on c.match_set_id = k.match_set_id and c.is_case = 1 where k.is_case = 0""",
        "fit_0": "select cast(0 as double) as b, cast(0 as double) as c, cast(0 as double) as v",
    }
    for k in range(1, steps + 1):
        ctes[f"fit_{k}"] = f"""select b + (i22 * g1 - i12 * g2) / det as b, c + (i11 * g2 - i12 * g1) / det as c, i22 / det as v from (
            select *, i11 * i22 - i12 * i12 as det from (
              select any_value(b) as b, any_value(c) as c, -sum(sx / s) as g1, -sum(sz / s) as g2,
                sum(sxx / s - sx * sx / (s * s)) as i11, sum(sxz / s - sx * sz / (s * s)) as i12, sum(szz / s - sz * sz / (s * s)) as i22
              from (select match_set_id, any_value(b) as b, any_value(c) as c, 1 + sum(w) as s, sum(w * x) as sx, sum(w * z) as sz,
                  sum(w * x * x) as sxx, sum(w * x * z) as sxz, sum(w * z * z) as szz
                from (select *, exp(b * x + c * z) as w from gaps cross join fit_{k - 1}) group by 1)))"""
    return ctes


@query("a4_a11_conditional_fit", oracle(f"""select 'estimated' as status, {rd('b')} as coefficient, {rd('sqrt(v)')} as standard_error, {rd('exp(b)')} as odds_ratio,
    {rd('exp(b - 1.959963984540054 * sqrt(v))')} as ci_lower, {rd('exp(b + 1.959963984540054 * sqrt(v))')} as ci_upper, true as converged from fit_9""",
    **conditional_newton(9, "members_r4")))
def a4(spark, d):
    row = md.fit_model(members_of(spark, d, ratio=4), STUDY.models[0], "exposed")
    names = ("status", "coefficient", "standard_error", "odds_ratio", "ci_lower", "ci_upper", "converged")
    schema = "status string, coefficient double, standard_error double, odds_ratio double, ci_lower double, ci_upper double, converged boolean"
    return spark.createDataFrame([tuple(row[n] for n in names)], schema)


@query("a5_conditioned_out_terms", oracle(f"""select 'sex_at_birth_Sex NATION_1' as conditioned_out_terms, {rd('b')} as coefficient from fit_9
    where not exists (select 1 from members group by match_set_id having min(sex_at_birth) <> max(sex_at_birth))""",
    **conditional_newton(9, "members")))
def a5(spark, d):
    model = ModelSpec(name="sex", predictors=("exposed",), covariates=("age", "sex_at_birth"), categorical=("sex_at_birth",))
    row = md.fit_model(members_of(spark, d), model, "exposed")
    return spark.createDataFrame(
        [(", ".join(row["conditioned_out_terms"]), row["coefficient"])], "conditioned_out_terms string, coefficient double")


@query("a6_centred_gram", oracle(f"""select {rd('sum(x * x)')} as xx, {rd('sum(x * z)')} as xz, {rd('sum(z * z)')} as zz from (
    select exposed - avg(exposed) over (partition by match_set_id) as x, age - avg(age) over (partition by match_set_id) as z from members)"""))
def a6(spark, d):
    """Cross products of the set-centred design, whose rank decides whether a conditional fit is possible."""
    from cohortlane.operators import estimation as est

    packed = md.packed_sets(members_of(spark, d), STUDY.models[0], "exposed")
    sets, names = md.design(packed, STUDY.models[0], "exposed", [])
    sums = est.PatternSums(md.set_patterns(sets), lambda rows: est.set_arrays(rows, 2))
    xx, xz, _, zz = (float(v) for v in sums(est.centred_gram, len(names)))
    return spark.createDataFrame([(xx, xz, zz)], "xx double, xz double, zz double")


FIRTH = ModelSpec(name="plain", predictors=("exposed",), method="firth")


@query("a7_firth_saturated", oracle(f"""select 'estimated' as status, {rd('ln((a + 0.5) * (e + 0.5) / ((b + 0.5) * (c + 0.5)))')} as coefficient from (
    select count(*) filter (is_case = 1 and exposed = 1) as a, count(*) filter (is_case = 1 and exposed = 0) as b,
      count(*) filter (is_case = 0 and exposed = 1) as c, count(*) filter (is_case = 0 and exposed = 0) as e from members)"""))
def a7(spark, d):
    row = md.fit_model(members_of(spark, d), FIRTH, "exposed")
    return spark.createDataFrame([(row["status"], row["coefficient"])], "status string, coefficient double")


@query("a8_firth_profile_interval")
def a8(spark, d):
    """No SQL form: the interval needs a root search. Tests check that its ends lie on the profile."""
    row = md.fit_model(members_of(spark, d), STUDY.models[1], "exposed")
    names = ("status", "odds_ratio", "ci_lower", "ci_upper", "p_value")
    return spark.createDataFrame(
        [tuple(row[n] for n in names)], "status string, odds_ratio double, ci_lower double, ci_upper double, p_value double")


# With one binary column the penalised likelihood is a binomial one with half a person added to each count, and the
# best intercept at a given coefficient v solves a quadratic equation in exp(intercept). Both ends by bisection.
PROFILE_SQL = {
    "halves": """select a + 0.5 as a, b + 0.5 as b, c + 0.5 as c, e + 0.5 as e, ln((a + 0.5) * (e + 0.5) / ((b + 0.5) * (c + 0.5))) as centre
      from (select count(*) filter (is_case = 1 and exposed = 1) as a, count(*) filter (is_case = 1 and exposed = 0) as b,
        count(*) filter (is_case = 0 and exposed = 1) as c, count(*) filter (is_case = 0 and exposed = 0) as e from members)""",
    "bisected": """select -1 as side, 0 as step, cast(0 as double) as inside, cast(20 as double) as outside
      union all select 1, 0, 0, 20
      union all select side, step + 1, case when drop < 3.841458820694124 then (inside + outside) / 2 else inside end,
        case when drop < 3.841458820694124 then outside else (inside + outside) / 2 end
      from (select side, step, inside, outside,
          2 * (a * ln(a / (a + c)) + c * ln(c / (a + c)) + b * ln(b / (b + e)) + e * ln(e / (b + e))
            - (a * ln(r * t / (1 + r * t)) - c * ln(1 + r * t) + b * ln(t / (1 + t)) - e * ln(1 + t))) as drop
        from (select *, (-m + sqrt(m * m + 4 * k * (a + b))) / (2 * k) as t
          from (select *, (c + e) * r as k, (a + c) * r + (b + e) - (a + b) * (1 + r) as m
            from (select *, exp(centre + side * (inside + outside) / 2) as r from bisected cross join halves where step < 60))))""",
}


@query("a8_profile_of_one_column", oracle(f"""select {rd('centre')} as coefficient, {rd('max(case when side = -1 then centre - inside end)')} as low,
    {rd('max(case when side = 1 then centre + inside end)')} as high from bisected cross join halves where step = 60 group by centre""", **PROFILE_SQL))
def a8_one(spark, d):
    row = md.fit_model(members_of(spark, d), FIRTH, "exposed")
    return spark.createDataFrame(
        [(row["coefficient"], math.log(row["ci_lower"]), math.log(row["ci_upper"]))],
        "coefficient double, low double, high double")


@query("a9_w5_holm", oracle(f"""select model, predictor, family, "primary", {rd('p_value')} as p_value,
      {rd('''case when "primary" and p_value is not null then least(1, max(step) over (partition by family, "primary" order by p, model, predictor)) end''')} as p_holm,
      case when "primary" then m end as family_size from (
      select *, (m - row_number() over (partition by family, "primary" order by p, model, predictor) + 1) * p as step from (
        select *, coalesce(p_value, 1) as p, count(*) over (partition by family, "primary") as m from shares))""",
    shares="""select race as family, sex_at_birth as model, s1 as predictor, s1 <> 'conflict' as "primary",
      case when count(*) > 3 then count(*) filter (exposed = 1) * 0.05 / count(*) end as p_value from features group by 1, 2, 3, 4"""))
def a9(spark, d):
    """Adjusts a family of shares taken as p-values; rare groups have none and keep their place."""
    shares = features_of(spark, d).groupBy(
        F.col("race").alias("family"), F.col("sex_at_birth").alias("model"), F.col("s1").alias("predictor")
    ).agg(F.count("*").alias("n"), F.count_if(F.col("exposed") == 1).alias("k"))
    shares = shares.select(
        "model", "predictor", "family", (F.col("predictor") != "conflict").alias("primary"),
        F.when(F.col("n") > 3, F.col("k") * 0.05 / F.col("n")).alias("p_value"))
    return md.holm(shares)


@query("a10_reasons", oracle("""select predictor, case when lo = hi then 'empty_sample_or_constant_predictor'
      when discordant = 0 then 'no_within_set_predictor_information' when separated then 'unstable_or_nonconverged_conditional_fit' end as reason
    from (
      select 'one' as predictor, 1 as lo, 1 as hi, 0 as discordant, false as separated
      union all select 'second_sex', min(x), max(x), (select count(*) from (select 1 from members group by match_set_id having min(sex_at_birth) <> max(sex_at_birth))), false
        from (select cast(sex_at_birth = 'Sex NATION_1' as int) as x from members)
      union all select 'any_disease', min(any_disease), max(any_disease), count(distinct match_set_id), min(any_disease) filter (is_case = 1) > max(any_disease) filter (is_case = 0) from members)"""))
def a10(spark, d):
    members = members_of(spark, d).withColumn("one", F.lit(1)).withColumn(
        "second_sex", (F.col("sex_at_birth") == "Sex NATION_1").cast("int"))
    model = ModelSpec(name="m", predictors=("one", "second_sex", "any_disease"))
    return md.fit_models(members, (model,)).select("predictor", "reason")


@query("a12_all_models", oracle("""select model, 'exposed' as predictor, 'estimated' as status, count(distinct match_set_id) as sets_analyzed,
    count(*) as rows_analyzed, count(*) filter (is_case = 1 and exposed = 1) as case_with_condition
    from members cross join (select unnest(['primary', 'sensitivity']) as model) group by 1"""))
def a12(spark, d):
    return results_of(spark, d).select(
        "model", "predictor", "status", "sets_analyzed", "rows_analyzed", "case_with_condition")


# --- summaries and screening ----------------------------------------------------------------------------------------

CONTENT = ReportSpec.from_dict({
    "version": "1",
    "characteristics": {
        "race": {"fields": ["race"]},
        "joint": {"fields": ["sex_at_birth", "s1"], "label": "Sex and survey"},
        "grouped": {"fields": ["ethnicity"], "groups": [
            {"label": "Named", "values": [["Ethnicity NATION_0"], ["Ethnicity NATION_1"]]}]},
        "exposed": {"fields": ["exposed"], "kind": "binary"},
        "age": {"fields": ["age"], "kind": "continuous", "label": "Age (years)"},
        "quantity": {"fields": ["quantity"], "kind": "continuous"},
    },
})
GROUP = "case when is_case = 1 then 'Cases' else 'Controls' end"
WHOLE = "(select is_case, count(*) as total from distinct_members group by 1)"


def levels_sql(variable: str, label: str, key: str) -> str:
    return f"""select {GROUP} as "group", '{variable}' as variable, {label} as level, cast(to_json({key}) as varchar) as level_key,
        count(*) as n, any_value(total) as denominator, {rd('100.0 * count(*) / any_value(total)')} as percent
      from distinct_members join {WHOLE} using (is_case) group by is_case, level, level_key"""


RACE = levels_sql("race", "race", "['raw', cast(to_json([race]) as varchar)]")
JOINT = levels_sql("joint", "sex_at_birth || ' / ' || s1", "['raw', cast(to_json([sex_at_birth, s1]) as varchar)]")
IN_GROUP = "ethnicity in ('Ethnicity NATION_0', 'Ethnicity NATION_1')"
GROUPED = levels_sql(
    "grouped", f"case when {IN_GROUP} then 'Named' else ethnicity end",
    f"case when {IN_GROUP} then ['group', 'Named'] else ['raw', cast(to_json([ethnicity]) as varchar)] end")


def summary_of(spark, d):
    return kept(spark, d, "summary", lambda: sm.cut(sm.summarize_characteristics(members_of(spark, d), CONTENT)))


def levels(frame):
    return frame.select("group", "variable", "level", "level_key", "n", "denominator", "percent")


@query("r1_g11_categories", oracle(RACE + " union all " + JOINT))
def r1(spark, d):
    spec = ReportSpec(version="1", characteristics={k: CONTENT.characteristics[k] for k in ("race", "joint")})
    return levels(sm.summarize_characteristics(members_of(spark, d), spec))


@query("r2_category_groups", oracle(GROUPED))
def r2(spark, d):
    spec = ReportSpec(version="1", characteristics={"grouped": CONTENT.characteristics["grouped"]})
    return levels(sm.summarize_characteristics(members_of(spark, d), spec))


BINARY = f"""select {GROUP} as "group", 'exposed' as variable, count(*) filter (exposed = 1) as n, count(exposed) as denominator,
    count(*) - count(exposed) as missing, {rd('100.0 * count(*) filter (exposed = 1) / count(exposed)')} as percent
    from distinct_members group by is_case"""


@query("r3_binary", oracle(BINARY))
def r3(spark, d):
    spec = ReportSpec(version="1", characteristics={"exposed": CONTENT.characteristics["exposed"]})
    return sm.summarize_characteristics(members_of(spark, d), spec).select(
        "group", "variable", "n", "denominator", "missing", "percent")


def continuous_sql(column: str) -> str:
    return f"""select {GROUP} as "group", '{column}' as variable, count({column}) as n, count(*) as denominator, count(*) - count({column}) as missing,
        {rd(f'avg({column})')} as mean, {rd(f'stddev_samp({column})')} as sd, {rd(f'quantile_cont({column}, 0.5)')} as median,
        {rd(f'quantile_cont({column}, 0.25)')} as q1, {rd(f'quantile_cont({column}, 0.75)')} as q3 from distinct_members group by is_case"""


@query("r4_continuous", oracle(continuous_sql("age") + " union all " + continuous_sql("quantity")))
def r4(spark, d):
    spec = ReportSpec(version="1", characteristics={k: CONTENT.characteristics[k] for k in ("age", "quantity")})
    return sm.summarize_characteristics(members_of(spark, d), spec).select(
        "group", "variable", "n", "denominator", "missing", "mean", "sd", "median", "q1", "q3")


@query("r5_small_counts", oracle("select race, s1, count(*) as n, count(*) between 1 and 20 as small from people group by 1, 2"))
def r5(spark, d):
    counts = people_of(spark, d).groupBy("race", "s1").agg(F.count("*").alias("n"))
    return counts.select("race", "s1", "n", sc.small_count(F.col("n")).alias("small"))


ALL_CELLS = f"""select variable, "group", n, denominator, cast(null as bigint) as missing from ({RACE} union all {JOINT} union all {GROUPED})
    union all select variable, "group", n, denominator, missing from ({BINARY})
    union all select variable, "group", n, denominator, missing from ({continuous_sql('age')})
    union all select variable, "group", n, denominator, missing from ({continuous_sql('quantity')})"""
SMALL = "(n between 1 and 20 or denominator - n between 1 and 20 or coalesce(missing, 0) between 1 and 20)"
SCREENED = f"""select variable, "group", case when not suppressed then n end as n, case when not suppressed then denominator end as denominator,
    case when not suppressed then missing end as missing, suppressed
    from (select *, bool_or({SMALL}) over (partition by variable) as suppressed from cells)"""


@query("r6_screened_characteristics", oracle(SCREENED, cells=ALL_CELLS))
def r6(spark, d):
    return sr.screened_characteristics(summary_of(spark, d)).select(
        "variable", "group", "n", "denominator", "missing", "suppressed")


SAMPLE_SQL = """select count(*) filter (is_case = 1) as cases, count(*) filter (is_case = 0) as controls,
    count(*) filter (is_case = 1 and exposed = 1) as a, count(*) filter (is_case = 1 and exposed = 0) as b,
    count(*) filter (is_case = 0 and exposed = 1) as c, count(*) filter (is_case = 0 and exposed = 0) as e,
    (select count(*) from (select 1 from members group by match_set_id having min(exposed) < max(exposed))) as discordant,
    count(distinct match_set_id) as sets from members"""
UNSAFE = "(least(a, b, c, e) between 1 and 20 or a between 1 and 20 or b between 1 and 20 or c between 1 and 20 or e between 1 and 20 or cases between 1 and 20 or controls between 1 and 20 or discordant between 1 and 20)"


@query("r7_screened_associations", oracle(f"""select model, 'exposed' as predictor, case when {UNSAFE} then 'suppressed_pending_disclosure_review' else 'estimated' end as status,
    case when not {UNSAFE} then cases end as cases_analyzed, case when not {UNSAFE} then a end as case_with_condition, {UNSAFE} as suppressed
    from sample cross join (select unnest(['primary', 'sensitivity']) as model)""", sample=SAMPLE_SQL))
def r7(spark, d):
    return sr.screened_associations(results_of(spark, d), members_of(spark, d), ["exposed"]).select(
        "model", "predictor", "status", "cases_analyzed", "case_with_condition", "suppressed")


FLOW_SQL = """select 0 as position, 'source' as stage, count(*) as n from classified union all
    select 1, 'eligible', count(*) from classified where eligible union all
    select 2, 'cases', count(*) from classified where is_case = 1 union all
    select 3, 'controls', count(*) from classified where is_case = 0 union all
    select 4, 'excluded', count(*) from classified where reason is not null union all
    select 5, 'matched_cases', count(*) from members where is_case = 1 union all
    select 6, 'matched_controls', count(*) from members where is_case = 0"""


@query("r8_screened_flow", oracle("""select position, stage, case when not hidden then n end as n, hidden as suppressed from flow
    cross join (select bool_or(x.n between 1 and 20 or abs(x.n - y.n) between 1 and 20) as hidden from flow x cross join flow y)""", flow=FLOW_SQL))
def r8(spark, d):
    flow = flow_counts(classified_of(spark, d))
    return sr.screened_flow(sr.full_flow(flow, matched_of(spark, d).summary))


@query("r10_group_sizes", oracle(f"""select {GROUP} as "group", case when count(*) not between 1 and 20 then count(*) end as n,
    count(*) between 1 and 20 as suppressed from distinct_members group by is_case"""))
def r10(spark, d):
    return sr.screened_group_sizes(sm.group_sizes(members_of(spark, d)))


@query("r16_default_summaries", oracle(
    levels_sql("sex_at_birth", "sex_at_birth", "['raw', cast(to_json([sex_at_birth]) as varchar)]") + " union all " + RACE + " union all "
    + levels_sql("ethnicity", "ethnicity", "['raw', cast(to_json([ethnicity]) as varchar)]")
    + f""" union all select "group", variable, '', null, n, denominator, null from ({continuous_sql('age')})"""))
def r16(spark, d):
    return levels(sm.characteristics(members_of(spark, d), STUDY))


# --- release ------------------------------------------------------------------------------------------------------------


def report_of(spark, d):
    return kept(spark, d, "report", lambda: build_report(
        matched_of(spark, d), results_of(spark, d), flow_counts(classified_of(spark, d)), STUDY, CONTENT))


def shown(n: str, suppressed: str = "suppressed") -> str:
    return f"case when {suppressed} then 'Suppressed' else {n} end"


@query("r11_characteristics_table", oracle(f"""select variable, "Characteristic",
      coalesce(max(t) filter ("group" = 'Cases'), case when max(t) = 'Suppressed' then 'Suppressed' else '0 (0.0%)' end) as "Cases",
      coalesce(max(t) filter ("group" = 'Controls'), case when max(t) = 'Suppressed' then 'Suppressed' else '0 (0.0%)' end) as "Controls"
    from (
      select variable, "group", 'Race: ' || level as "Characteristic", {shown("n || ' (' || printf('%.1f', percent) || '%)'")} as t
        from ({RACE}) join hidden using (variable)
      union all select variable, "group", 'Sex And Survey: ' || level, {shown("n || ' (' || printf('%.1f', percent) || '%)'")}
        from ({JOINT}) join hidden using (variable)
      union all select variable, "group", 'Recorded exposure: Recorded, n/N (%)', {shown("n || '/' || denominator || ' (' || printf('%.1f', percent) || '%)'")}
        from ({BINARY}) join hidden using (variable)
      union all select variable, "group", 'Recorded exposure: Observed / missing', {shown("denominator || ' / ' || missing")}
        from ({BINARY}) join hidden using (variable)
      union all select variable, "group", 'Age (years): Observed / missing', {shown("n || ' / ' || missing")}
        from ({continuous_sql('age')}) join hidden using (variable))
    group by variable, "Characteristic" """,
    cells=ALL_CELLS, hidden=f"select variable, bool_or({SMALL}) as suppressed from cells group by 1").replace("Sex And Survey", "Sex and survey"))
def r11(spark, d):
    summaries = {"age": ("missing",)}
    labels = {"exposed": "Recorded exposure", "joint": "Sex and survey", "age": "Age (years)"}
    screened = sr.screened_characteristics(summary_of(spark, d)).filter("variable in ('race', 'joint', 'exposed', 'age')")
    return rl.publication_characteristics(screened, labels, summaries=summaries).select(
        "variable", "Characteristic", "Cases", "Controls")


@query("r12_associations_table", oracle(f"""select model as model_id, 'exposed' as predictor_id,
    case when {UNSAFE} then 'suppressed_pending_disclosure_review' else 'estimated' end as status_id,
    case when not {UNSAFE} then sets end as "Matched sets",
    {shown("c || '/' || controls || ' (' || printf('%.1f', 100.0 * c / controls) || '%)'", UNSAFE)} as "Condition in sampled controls",
    case model when 'primary' then 'Primary' else 'Sensitivity' end as "Model", 'Recorded exposure' as "Condition",
    case when {UNSAFE} then 'Suppressed' else 'Estimated' end as "Status",
    case when not {UNSAFE} then cases end as "Cases", case when not {UNSAFE} then controls end as "Controls",
    {shown("a || '/' || cases || ' (' || printf('%.1f', 100.0 * a / cases) || '%)'", UNSAFE)} as "Condition in sampled cases"
    from sample cross join (select unnest(['primary', 'sensitivity']) as model)""", sample=SAMPLE_SQL))
def r12(spark, d):
    screened = sr.screened_associations(results_of(spark, d), members_of(spark, d), ["exposed"])
    return rl.publication_associations(screened, STUDY.labels).select(
        "model_id", "predictor_id", "status_id", "Model", "Condition", "Status", "Cases", "Controls", "Matched sets",
        "Condition in sampled cases", "Condition in sampled controls")


@query("r13_selected_table", oracle(f"""select 'Primary' as "Model", 'Recorded exposure' as "Condition",
    case when not {UNSAFE} then cases end as "Cases" from sample""", sample=SAMPLE_SQL))
def r13(spark, d):
    selection = rl.TableSelection("models", "associations", models=("primary",), columns=("Model", "Condition", "Cases"))
    return rl.select_table(report_of(spark, d), selection).select("Model", "Condition", "Cases")


PUBLICATION = PublicationSpec.from_dict({
    "version": "1",
    "reports": {"main": {
        "study_id": "orders_demo", "protocol_version": "1", "group_sizes": True,
        "characteristics": {"age": ["median_iqr", "missing"], "race": ["n_percent"], "absent": ["n_percent"]},
        "associations": {"primary": ["exposed"], "sensitivity": ["exposed"]},
        "tables": {"flow": ["Stage", "Participants"], "balance": ["Variable", "Absolute SMD after"]},
    }},
})
SELECTIONS = [
    rl.TableSelection("People", "characteristics", variables=("age", "race"), group_sizes=True),
    rl.TableSelection("Models", "associations"),
    rl.TableSelection("Flow", "flow"),
    rl.TableSelection("Balance", "balance"),
]


@query("r14_coverage", oracle(f"""select content as "Content", case when content = 'absent: n_percent' then 'Missing'
      when kind = 'model' and {UNSAFE} then 'Included, suppressed' else 'Included' end as "Status" from sample cross join (
      select unnest(['Group sizes', 'age: median_iqr', 'age: missing', 'race: n_percent', 'absent: n_percent', 'flow', 'balance', 'Methods and review status']) as content, 'other' as kind
      union all select unnest(['primary: exposed', 'sensitivity: exposed']), 'model')""", sample=SAMPLE_SQL))
def r14(spark, d):
    return rl.check_coverage({"main": report_of(spark, d)}, SELECTIONS, PUBLICATION).select("Content", "Status")


METHODS_SQL = """select 'r' || cast(ratio as varchar) as report, stage, item, case stage when 'study' then
      case item when 'identity' then 'orders_demo' else cast(ratio as varchar) end else '1 to ' || cast(ratio as varchar) end as value
    from (select unnest([2, 4]) as ratio) cross join (
      select unnest(['study', 'study', 'matching']) as stage, unnest(['identity', 'version', 'controls a case']) as item)
    where (select count(*) from people) > 0
    union all select 'r2', 'review', 'status', 'accepted' union all select 'r2', 'review', 'reviewer', 'a reader'
    union all select 'r4', 'review', 'status', 'not reviewed'"""


def saved_reports(spark, d):
    """Two studies, of two and of four controls a case, saved and loaded again."""

    def make():
        loaded = {}
        for ratio in (2, 4):
            study = sensitivity_spec(STUDY, version=str(ratio), matching=MatchSpec.from_dict({**MATCHING, "ratio": ratio}))
            results = results_of(spark, d, ratio=ratio)
            report = build_report(matched_of(spark, d, ratio=ratio), results, flow_counts(classified_of(spark, d)), study, CONTENT)
            if ratio == 2:
                report.methods = reviewed(report.methods, "accepted", "a reader")
            path = folder(spark)
            save_report(spark, path, report)
            loaded[f"r{ratio}"] = load_report(spark, path)
        return loaded

    return kept(spark, d, "saved reports", make)


@query("r14_methods_of_saved_reports", oracle(METHODS_SQL))
def r14_methods(spark, d):
    rows = rl.combined_methods(saved_reports(spark, d))
    shown = "stage in ('study', 'review') or item = 'controls a case'"
    return rows.filter(shown).select("report", "stage", "item", "value")


def two_flows(select: str) -> str:
    """Flow rows of both studies with whether any count of a study must be hidden."""
    return f"""select report, {select} from flows join (
      select x.report, bool_or(x.n between 1 and 20 or abs(x.n - y.n) between 1 and 20) as hidden
      from flows x join flows y on x.report = y.report group by 1) using (report)"""


@query("r15_loaded_studies", oracle(
    two_flows("""upper(stage[1]) || replace(stage[2:], '_', ' ') as "Stage",
      case when hidden then 'Suppressed' else cast(n as varchar) end as "Participants" """),
    flows=f"""select 'r2' as report, * from ({FLOW_SQL})
      union all select 'r4', * from ({FLOW_SQL.replace('from members', 'from members_r4')})"""))
def r15_loaded(spark, d):
    return rl.combine_reports(saved_reports(spark, d), "flow").select("report", "Stage", "Participants")


@query("r15_combined_reports", oracle("""select report, "Stage", case when hidden then 'Suppressed' else cast(n as varchar) end as "Participants"
    from (select unnest(['first', 'second']) as report) cross join (
      select upper(stage[1]) || replace(stage[2:], '_', ' ') as "Stage", n from flow)
    cross join (select bool_or(x.n between 1 and 20 or abs(x.n - y.n) between 1 and 20) as hidden from flow x cross join flow y)""", flow=FLOW_SQL))
def r15(spark, d):
    report = report_of(spark, d)
    return rl.combine_reports({"first": report, "second": report}, "flow").select("report", "Stage", "Participants")


@query("k3_report_snapshot", oracle(SCREENED, cells=ALL_CELLS))
def k3(spark, d):
    report, path = report_of(spark, d), folder(spark)
    save_report(spark, path, report)
    loaded = load_report(spark, path)
    assert loaded.metadata == json.loads(json.dumps(report.metadata)) and set(loaded.tables) == set(report.tables)
    return loaded.screened["characteristics"].select("variable", "group", "n", "denominator", "missing", "suppressed")
