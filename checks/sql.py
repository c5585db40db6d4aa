"""The example study written independently as SQL common table expressions for DuckDB.

``oracle(select)`` puts a final select behind the whole chain; a CTE that is not used costs nothing.
"""

from __future__ import annotations

from .study import VIEWS

CUTOFF = "date '2000-01-20'"
SCORE_STEPS = 8


def age_sql(birth: str, year: int, month: int, day: int) -> str:
    later = f"(month({birth}) > {month} or (month({birth}) = {month} and day({birth}) > {day}))"
    return f"case when {birth} <= make_date({year}, {month}, {day}) then cast({year} - year({birth}) - cast({later} as int) as int) end"


def condition_set(seed: int) -> str:
    return f"""select * from concept where domain_id = 'Condition' and invalid_reason is null
      and standard_concept = 'S' and (concept_id = {seed} or concept_id in
        (select descendant_concept_id from concept_ancestor where ancestor_concept_id = {seed}))"""


SAME_SEX_AND_AGE = "k.sex_at_birth = a.sex_at_birth and abs(k.age - a.age) <= 3"


def greedy(name: str, ratio: int, eligible: str = SAME_SEX_AND_AGE) -> dict[str, str]:
    """Agents one after another, each taking the nearest free control: the definition as a recursion."""
    return {
        f"agents_{name}": f"""select row_number() over (order by slot, person_id) as turn, slot, person_id as case_id,
            sex_at_birth, age from people cross join (select unnest(range(1, {ratio + 1})) as slot) where is_case = 1""",
        f"greedy_{name}": f"""select cast(0 as bigint) as turn, cast(null as varchar) as case_id, cast(0 as bigint) as slot,
              cast(null as varchar) as control_id, cast([] as varchar[]) as used
            union all
            select a.turn, a.case_id, a.slot, c.kid,
              case when c.kid is null then g.used else list_append(g.used, c.kid) end
            from greedy_{name} g join agents_{name} a on a.turn = g.turn + 1
            left join lateral (
              select arg_min(k.person_id, (abs(k.age - a.age), k.person_id)) as kid from people k
              where k.is_case = 0 and {eligible}
                and not list_contains(g.used, k.person_id)) c on true""",
        f"edges_{name}": f"select case_id, slot, control_id from greedy_{name} where control_id is not null",
    }


def members_of(edges: str) -> str:
    """Sets with weights and the case's age, over an edge table; minimum one control."""
    return f"""select r.person_id, 'set_' || r.case_id as match_set_id, r.is_case, r.control_order,
          case when r.is_case = 1 then 1.0 else 1.0 / (count(*) over (partition by r.case_id) - 1) end as weight,
          r.case_id, p.* exclude (person_id, is_case),
          p.age - max(case when r.is_case = 1 then p.age end) over (partition by r.case_id) as match_difference_age
        from (select case_id, control_id as person_id, 0 as is_case, cast(slot as int) as control_order from {edges}
              union all select distinct case_id, case_id, 1, 0 from {edges}) r
        join people p on p.person_id = r.person_id"""


CHAIN: dict[str, str] = {
    **VIEWS,
    "disease_set": condition_set(500000001),
    "exposed_set": condition_set(500000002),
    "feature_concepts": """select 'disease' as feature, * from disease_set
        union all select 'any_disease', * from disease_set
        union all select 'exposed', * from exposed_set
        union all select 'quantity', * from concept where concept_id = 600000001""",
    "ehr_events": f"""select person_id, condition_start_date as event_date from condition_occurrence
          where condition_start_date <= {CUTOFF}
        union all select person_id, visit_start_date from visit_occurrence where visit_start_date <= {CUTOFF}""",
    "ehr": """select person_id, count(*) as ehr_record_count,
          cast(max(event_date) - min(event_date) as int) as ehr_days from ehr_events group by person_id""",
    "cf": f"""select c.person_id,
          count(distinct case when d.concept_id is not null then condition_start_date end) as disease__days,
          min(case when d.concept_id is not null then condition_start_date end) as disease__first,
          max(case when d.concept_id is not null then condition_start_date end) as disease__last,
          count(distinct case when e.concept_id is not null then condition_start_date end) as exposed__days,
          min(case when e.concept_id is not null then condition_start_date end) as exposed__first,
          max(case when e.concept_id is not null then condition_start_date end) as exposed__last
        from condition_occurrence c
        left join disease_set d on d.concept_id = c.condition_concept_id
        left join exposed_set e on e.concept_id = c.condition_concept_id
        where condition_start_date <= {CUTOFF} group by c.person_id""",
    "latest_answers": f"""select * from (
          select *, max(observation_date) over (partition by person_id, observation_source_concept_id) as last_date
          from observation where observation_source_concept_id in (800000001, 800000003)
            and observation_date <= {CUTOFF}) where observation_date = last_date""",
    "s1": """select person_id,
          coalesce(bool_or((observation_source_concept_id = 800000001 and value_source_concept_id in (810000002, 810000003))
            or (observation_source_concept_id = 800000003
                and coalesce(value_as_number, try_cast(value_as_string as double)) > 100)), false) as positive,
          coalesce(bool_or(observation_source_concept_id = 800000001 and value_source_concept_id = 810000001), false)
            as negative
        from latest_answers group by person_id""",
    "valid_measurements": f"""select m.person_id, measurement_date as event_date, value_as_number as value
        from measurement m join concept u on u.concept_id = m.unit_concept_id
        where measurement_concept_id = 600000001 and u.vocabulary_id = 'UNIT' and u.concept_code = 'u0'
          and measurement_date between {CUTOFF} - 365 and {CUTOFF} and value_as_number between 5 and 45""",
    "quantity": """select person_id, case when count(distinct value) = 1 then min(value) end as quantity from (
          select *, max(event_date) over (partition by person_id) as last_date from valid_measurements)
        where event_date = last_date group by person_id""",
    "demographics": f"""select person_id, cast(birth_datetime as date) as birth_date, sex_at_birth_concept_id,
          race_concept_id, ethnicity_concept_id,
          {age_sql('birth_datetime', 2000, 6, 30)} as age, {age_sql('birth_datetime', 2000, 1, 20)} as age_at_cutoff,
          coalesce(s.concept_name, 'unknown') as sex_at_birth, coalesce(r.concept_name, 'unknown') as race,
          coalesce(e.concept_name, 'unknown') as ethnicity
        from person p left join concept s on s.concept_id = p.sex_at_birth_concept_id
        left join concept r on r.concept_id = p.race_concept_id
        left join concept e on e.concept_id = p.ethnicity_concept_id""",
    "features": """select cast(d.person_id as varchar) as person_id, d.* exclude (person_id), ehr_record_count, ehr_days,
          disease__days, disease__first, disease__last, coalesce(cast(disease__last - disease__first as int), 0) as disease__span,
          cast(coalesce(disease__days, 0) >= 2 and coalesce(disease__last - disease__first, 0) >= 30 as int) as disease,
          disease__days as any_disease__days, disease__first as any_disease__first, disease__last as any_disease__last,
          coalesce(cast(disease__last - disease__first as int), 0) as any_disease__span,
          cast(coalesce(disease__days, 0) >= 1 as int) as any_disease,
          exposed__days, exposed__first, exposed__last,
          coalesce(cast(exposed__last - exposed__first as int), 0) as exposed__span,
          cast(coalesce(exposed__days, 0) >= 1 as int) as exposed,
          case when positive and negative then 'conflict' when positive then 'yes' when negative then 'no' else 'unknown' end as s1,
          quantity
        from demographics d join ehr using (person_id) left join cf using (person_id) left join s1 using (person_id)
        left join quantity using (person_id)""",
    "judged": """select *, case when age is null or age_at_cutoff is null then 'missing_or_invalid_age'
          when age_at_cutoff < 18 then 'below_minimum_age' when ehr_record_count <= 0 then 'no_dated_ehr_evidence' end
          as first_reason from features""",
    "classified": """select * exclude (first_reason),
          case when first_reason is null and disease = 1 then 1 when first_reason is null and any_disease = 0 then 0 end as is_case,
          coalesce(first_reason, case when disease <> 1 and any_disease <> 0 then 'neither_case_nor_control' end) as reason,
          first_reason is null as eligible from judged""",
    "people": "select * exclude (reason, eligible) from classified where is_case is not null",
    **greedy("r2", 2),
    **greedy("r4", 4),
    "edges_rep": """select case_id, slot, control_id from (
          select c.person_id as case_id, k.person_id as control_id,
            row_number() over (partition by c.person_id order by abs(k.age - c.age), k.person_id) as slot
          from people c join people k on c.is_case = 1 and k.is_case = 0 and k.sex_at_birth = c.sex_at_birth
            and abs(k.age - c.age) <= 3) where slot <= 2""",
    "members": members_of("edges_r2"),
    "members_r4": members_of("edges_r4"),
    "members_rep": members_of("edges_rep"),
    "distinct_members": "select distinct on (person_id, is_case) * from members",
}

MATERIAL = {"features", "classified", "people", "members", "members_r4", "members_rep", "edges_r2", "edges_r4", "greedy_r2", "greedy_r4"}


def oracle(select: str, **more: str) -> str:
    """A full statement: the chain, further CTEs of the query's own, and its final select."""
    parts = []
    for name, text in {**CHAIN, **more}.items():
        hint = " materialized" if name in MATERIAL - {"greedy_r2", "greedy_r4"} else ""
        parts.append(f"{name} as{hint} ({text})")
    return "with recursive " + ",\n".join(parts) + "\n" + select
