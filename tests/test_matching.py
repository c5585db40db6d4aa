import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortlane import MatchSpec
from cohortlane.errors import DataContractError
from cohortlane.operators.matching import (
    MatchLimits, caliper_bands, caliper_join, core_pool, criteria_violations, geometry, greedy_edges, grid_meetings,
    grid_radii, grid_sides, match_groups, match_pool, membership_violations, replacement_edges,
)
from cohortlane.session import numbered, running_total
from cohortlane.sources.store import fingerprint

SMALL = MatchLimits()
#: Limits that force every stratum through the chunked path.
CHUNKED = MatchLimits(stratum_rows=1, stratum_pairs=10**9, chunk=90, window=8)
#: And through the windowed one, where a task sees only cells near its cases.
WINDOWED = MatchLimits(stratum_rows=1, stratum_pairs=0, chunk=90, window=6)


def one_by_one(pool: pd.DataFrame, spec: MatchSpec, columns: list[str], distance) -> set:
    """The definition itself: serve agents in order, each takes the nearest free eligible control."""
    cases = pool[pool.is_case == 1].sort_values("person_id")
    controls = pool[pool.is_case == 0].sort_values("person_id")
    used, edges, last = set(), set(), {}
    for slot in range(1, spec.ratio + 1):
        for case in cases.itertuples():
            best = None
            for control in controls.itertuples():
                if not spec.replace and control.person_id in used:
                    continue
                if spec.replace and (case.person_id, control.person_id) in last:
                    continue
                if any(getattr(case, e) != getattr(control, e) for e in spec.exact):
                    continue
                if any(abs(getattr(case, c) - getattr(control, c)) > w for c, w in spec.calipers.items()):
                    continue
                key = (distance(case, control), control.person_id)
                best = key if best is None or key < best else best
            if best:
                used.add(best[1])
                last[case.person_id, best[1]] = True
                edges.add((case.person_id, slot, best[1]))
    return edges


def edges_of(people, spec, limits):
    pool = match_pool(people, spec)
    space = geometry(pool.filter("valid"), spec)
    core = core_pool(pool, spec, space)
    make = replacement_edges if spec.replace else greedy_edges
    return {(r.case_id, r.slot, r.control_id) for r in make(core, spec, space, limits).collect()}


def people_frame(seed, n, case_share=0.25, values=12, continuous=False):
    rng = np.random.default_rng(seed)
    age = rng.normal(50, 8, n).round(4) if continuous else rng.integers(40, 40 + values, n)
    return pd.DataFrame({
        "person_id": [str(i) for i in rng.permutation(n) + 1],
        "is_case": (rng.random(n) < case_share).astype(int),
        "age": age, "sex": np.where(rng.random(n) < 0.5, "f", "m"), "bmi": rng.normal(25, 4, n).round(2),
    })


def gap(case, control):
    return abs(case.age - control.age)


@pytest.mark.parametrize(
    "limits, changes",
    [
        (SMALL, {"exact": ["sex"], "calipers": {"age": 3}, "ratio": 2}),
        (SMALL, {"exact": [], "calipers": {"age": 0}, "ratio": 3}),
        (SMALL, {"exact": [], "ratio": 4}),
        (CHUNKED, {"exact": ["sex"], "calipers": {"age": 3}, "ratio": 4}),
        (CHUNKED, {"exact": [], "ratio": 4}),
        (WINDOWED, {"exact": ["sex"], "calipers": {"age": 2, "bmi": 3}, "ratio": 2}),
    ],
)
def test_greedy_equals_serving_one_by_one(spark, limits, changes):
    spec = MatchSpec(**changes)
    rows = people_frame(5, 130)
    assert edges_of(spark.createDataFrame(rows), spec, limits) == one_by_one(rows, spec, ["age"], gap)


@pytest.mark.parametrize("limits", [SMALL, WINDOWED], ids=["small", "windowed"])
def test_greedy_on_continuous_values(spark, limits):
    spec = MatchSpec(exact=["sex"], calipers={"age": 1.5}, ratio=2)
    rows = people_frame(6, 110, continuous=True)
    assert edges_of(spark.createDataFrame(rows), spec, limits) == one_by_one(rows, spec, ["age"], gap)


def test_a_hot_stratum_and_value_take_the_chunked_path(spark):
    rng = np.random.default_rng(9)
    rows = people_frame(9, 240, case_share=0.3, values=4)
    rows.loc[rng.random(240) < 0.5, "age"] = 41
    spec = MatchSpec(calipers={"age": 1}, ratio=3)
    expected = one_by_one(rows, spec, ["age"], gap)
    assert edges_of(spark.createDataFrame(rows), spec, CHUNKED) == expected
    assert edges_of(spark.createDataFrame(rows).repartition(7), spec, SMALL) == expected


@pytest.mark.parametrize("limits", [SMALL, WINDOWED], ids=["small", "windowed"])
def test_mahalanobis_with_several_columns(spark, limits):
    spec = MatchSpec(exact=["sex"], distance=["age", "bmi"], calipers={"age": 4}, ratio=2)
    rows = people_frame(11, 90)
    x = rows[["age", "bmi"]].to_numpy(float)
    parts = [x[rows.is_case == r] for r in (0, 1)]
    pooled = sum((len(p) - 1) * np.cov(p.T) for p in parts) / (len(x) - 2)
    inverse = np.linalg.inv(pooled)

    def distance(case, control):
        d = np.array([case.age - control.age, case.bmi - control.bmi])
        return round(float(np.sqrt(d @ inverse @ d)), 9)

    found = edges_of(spark.createDataFrame(rows), spec, limits)
    assert found == one_by_one(rows, spec, ["age", "bmi"], distance)


@pytest.mark.parametrize("limits", [SMALL, MatchLimits(stratum_rows=1, window=1)], ids=["small", "windowed"])
def test_replacement_takes_each_cases_nearest(spark, limits):
    rows = people_frame(13, 110)
    frame = spark.createDataFrame(rows)
    for changes in ({"exact": ["sex"], "calipers": {"age": 2}, "ratio": 3},
                    {"calipers": {"age": 3, "bmi": 1}, "ratio": 2}):
        spec = MatchSpec(replace=True, **changes)
        assert edges_of(frame, spec, limits) == one_by_one(rows, spec, ["age"], gap)


def test_propensity_is_a_one_dimensional_match_on_the_fitted_logit(spark, people):
    """The same sets come from matching on the logit as an ordinary column with a caliper of its own."""
    spec = MatchSpec(method="propensity", distance=["age", "hdl"], ratio=1)
    pool = match_pool(people, spec)
    space = geometry(pool.filter("valid"), spec)
    scored = pool.filter("valid").select("person_id", "is_case", space.coordinates[0].alias("logit")).toPandas()
    a, b, c = space.facts["coefficients"]
    plain = people.select("person_id", "age", "hdl").toPandas().set_index("person_id")
    own = scored.set_index("person_id").logit
    assert np.allclose(own, a + b * plain.age[own.index] + c * plain.hdl[own.index], atol=1e-8)
    plain_spec = MatchSpec(distance=["logit"], calipers={"logit": space.facts["caliper"]}, ratio=1)
    expected = one_by_one(scored, plain_spec, ["logit"], lambda x, y: abs(x.logit - y.logit))
    for limits in (SMALL, MatchLimits(stratum_rows=1, stratum_pairs=0, chunk=40, window=16)):
        members = match_groups(people, spec, limits=limits).members
        found = {(r.match_set_id[4:], r.person_id) for r in members.filter("is_case = 0").collect()}
        assert found == {(case, control) for case, _, control in expected}


def test_sets_keep_their_rules_and_do_not_depend_on_order(people, study, matched):
    """Each set read on its own, in plain Python, from rows that were handed over backwards."""
    again = match_groups(people.orderBy(F.desc("age"), F.desc("person_id")).repartition(5, "hdl"), study.matching)
    assert fingerprint(again.members) == fingerprint(matched.members)
    sets, seen = {}, set()
    for r in matched.members.collect():
        assert r.person_id not in seen
        seen.add(r.person_id)
        sets.setdefault(r.match_set_id, []).append(r)
    for name, rows in sets.items():
        rows.sort(key=lambda r: r.control_order)
        case, controls = rows[0], rows[1:]
        assert case.is_case == 1 and name == f"set_{case.person_id}" and case.weight == 1
        assert [c.control_order for c in controls] == list(range(1, len(controls) + 1)) and 1 <= len(controls) <= 2
        for c in controls:
            assert c.is_case == 0 and c.sex_at_birth == case.sex_at_birth and c.weight == 1 / len(controls)
            assert c.match_difference_age == c.age - case.age and abs(c.match_difference_age) <= 3
    assert criteria_violations(matched.members, study.matching).isEmpty()
    assert membership_violations(matched.members).filter("n > 0").isEmpty()


def test_one_far_cell_takes_few_rounds(spark, monkeypatch):
    """All cases want one value that no case has, beside many cells that nobody wants."""
    import cohortlane.operators.matching as matching

    rounds = []
    plain = matching._slices
    monkeypatch.setattr(matching, "_slices", lambda *a: rounds.append(1) or plain(*a))
    cases = [(f"a{i:03d}", 1, 0.0) for i in range(200)]
    controls = [(f"b{i:03d}", 0, 5.0) for i in range(260)] + [(f"c{i:03d}", 0, 100.0 + i) for i in range(300)]
    rows = pd.DataFrame(cases + controls, columns=["person_id", "is_case", "age"])
    spec = MatchSpec(distance=["age"], ratio=1)
    limits = MatchLimits(stratum_rows=1, stratum_pairs=10**9, chunk=200, window=8)
    assert edges_of(spark.createDataFrame(rows), spec, limits) == {(f"a{i:03d}", 1, f"b{i:03d}") for i in range(200)}
    assert len(rounds) <= 6


def test_a_small_first_chunk_costs_few_rounds(spark, monkeypatch):
    """600 agents from chunks of 20 on: rounds that go well take more, and every pair stays that of single service."""
    import cohortlane.operators.matching as matching

    rounds = []
    plain = matching._slices
    monkeypatch.setattr(matching, "_slices", lambda *a: rounds.append(1) or plain(*a))
    people = spark.createDataFrame(people_frame(5, 1200))
    spec = MatchSpec(distance=["age"], calipers={"age": 3}, ratio=2)
    limits = MatchLimits(stratum_rows=1, stratum_pairs=10**9, chunk=20)
    assert edges_of(people, spec, limits) == edges_of(people, spec, SMALL)
    assert len(rounds) <= 8


def test_factors_of_many_levels_are_measured_whole(spark):
    """The pooled covariance of a factor with over a thousand levels, against numpy."""
    from cohortlane.operators.matching import distance_columns, pooled_covariance

    rows = pd.DataFrame({
        "person_id": [f"p{i}" for i in range(2100)], "is_case": [i % 3 == 0 for i in range(2100)], "valid": True,
        "age": [30.0 + i % 41 for i in range(2100)], "site": [f"site{(i * 7) % 1010:04d}" for i in range(2100)],
    })
    rows["is_case"] = rows["is_case"].astype(int)
    spec = MatchSpec(distance=["age", "site"], categorical=["site"])
    frame = spark.createDataFrame(rows)
    found = pooled_covariance(frame, distance_columns(frame, spec))
    x = np.column_stack([rows.age, *[(rows.site == s).astype(float) for s in sorted(set(rows.site))[1:]]])
    parts = [(rows.is_case == role).to_numpy() for role in (0, 1)]
    expected = sum((m.sum() - 1) * np.cov(x[m].T) for m in parts) / (len(rows) - 2)
    assert np.allclose(found, expected, atol=1e-10)


def test_minimum_controls_drop_sets_and_name_the_unmatched(spark):
    rows = pd.DataFrame({
        "person_id": ["1", "2", "3", "4", "5", "6"], "is_case": [1, 1, 1, 0, 0, 0],
        "age": [30.0, 50.0, np.nan, 30.0, 31.0, 50.0],
    })
    spec = MatchSpec(calipers={"age": 2}, ratio=2, minimum_controls=2)
    result = match_groups(spark.createDataFrame(rows), spec)
    assert {r.person_id for r in result.members.collect()} == {"1", "4", "5"}
    reasons = {r.person_id: r.reason for r in result.unmatched.collect()}
    assert reasons == {"2": "no_sufficient_eligible_controls", "3": "missing_match_feature"}
    summary = result.summary.first()
    assert (summary.matched_cases, summary.controls, summary.missing_case_match_features, summary.unmatched_cases) == (
        1, 2, 1, 2,
    )
    assert {(r.controls, r.sets) for r in result.ratios.collect()} == {(2, 1)}


def test_violations_are_found(spark, study, matched):
    broken = matched.members.withColumn("age", F.col("age") + F.col("control_order") * 10)
    problems = {r.problem for r in criteria_violations(broken, study.matching).collect()}
    assert problems == {"caliper age"}
    doubled = matched.members.unionByName(matched.members.filter("control_order = 1"))
    counts = {r.problem: r.n for r in membership_violations(doubled).collect()}
    assert counts["repeated in a set"] > 0 and counts["reused"] > 0 and counts["roles"] == 0


def test_matching_needs_both_roles(people):
    with pytest.raises(DataContractError):
        match_groups(people.filter("is_case = 1"), MatchSpec())
    with pytest.raises(DataContractError):
        match_groups(people.unionByName(people.limit(1)), MatchSpec())
    with pytest.raises(DataContractError):
        match_groups(people, MatchSpec(distance=["nothing"]))


def test_caliper_join_equals_the_plain_condition(spark):
    rows = people_frame(21, 200, continuous=True)
    frame = spark.createDataFrame(rows)
    cases, controls = frame.filter("is_case = 1"), frame.filter("is_case = 0")
    for calipers in ({"age": 0.75}, {"age": 2.0, "bmi": 1.0}, {"age": 0.0}):
        joined = caliper_join(cases, controls, ["sex"], calipers)
        found = {(r.person_id, r.person_id_control) for r in joined.collect()}
        left, right = rows[rows.is_case == 1], rows[rows.is_case == 0]
        expected = {
            (a.person_id, b.person_id) for a in left.itertuples() for b in right.itertuples()
            if a.sex == b.sex and all(abs(getattr(a, c) - getattr(b, c)) <= w for c, w in calipers.items())
        }
        assert found == expected


def test_a_common_age_is_split_by_the_other_caliper(spark):
    """Everybody is 50; rows that meet in the join stay in proportion to the pairs it returns."""
    frame = spark.createDataFrame(pd.DataFrame({"person_id": range(2000), "age": 50.0, "bmi": np.arange(2000) / 10}))
    cases, controls = frame.filter("person_id % 4 = 0"), frame.filter("person_id % 4 > 0")
    calipers = {"age": 2.0, "bmi": 0.5}
    pairs = {
        side: {(r[0], r[1]) for r in caliper_join(cases, controls, [], calipers, copied=side).select(
            "person_id", "person_id_control").collect()}
        for side in ("cases", "controls", None)
    }
    # Differences are taken as the join takes them, in doubles.
    x = np.arange(2000) / 10
    assert pairs[None] == {(i, j) for i in range(0, 2000, 4) for j in range(max(i - 6, 0), min(i + 7, 2000))
                           if j % 4 and abs(x[i] - x[j]) <= 0.5}
    assert pairs["cases"] == pairs["controls"] == pairs[None]
    banded = [
        side.select(*[caliper_bands(F.col(c), w, copied=copied).alias(f"{c}_band") for c, w in calipers.items()][:1],
                    "bmi").select("age_band", caliper_bands(F.col("bmi"), 0.5, copied=copied).alias("bmi_band"))
        for side, copied in ((cases, True), (controls, False))
    ]
    assert banded[0].join(banded[1], ["age_band", "bmi_band"]).count() <= 4 * len(pairs[None])
    with pytest.raises(DataContractError):
        caliper_join(cases, controls, [], calipers, copied="both")


def test_caliper_join_on_the_very_edge_and_on_nothing(spark):
    values = [0.1, 0.2, 0.30000000000000004, 0.4, -0.1, -1e9, 1e9, None]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "person_id int, x double")
    expected = {(i, j) for i, a in enumerate(values) for j, b in enumerate(values)
                if a is not None and b is not None and abs(a - b) <= 0.1}
    for side in ("cases", "controls"):
        joined = caliper_join(frame, frame, [], {"x": 0.1}, copied=side)
        assert {(r.person_id, r.person_id_control) for r in joined.collect()} == expected
    assert caliper_join(frame.filter("false"), frame, [], {"x": 0.1}).count() == 0


def test_a_block_holds_every_cell_within_its_radius(spark):
    """Three whitened columns: whatever is nearer than the radius is met, at any side, and far types see the end."""
    rng = np.random.default_rng(4)
    rows = people_frame(4, 160, continuous=True).assign(hdl=rng.normal(50, 9, 160).round(1))
    rows.loc[rows.index[:2], "age"] = 400.0
    spec = MatchSpec(distance=["age", "bmi", "hdl"], replace=True)
    pool = match_pool(spark.createDataFrame(rows), spec)
    space = geometry(pool.filter("valid"), spec)
    core = core_pool(pool, spec, space)
    types = core.filter("is_case = 1").select("stratum", "values").distinct()
    cells = core.filter("is_case = 0").select("stratum", "values").distinct()
    weights = np.array(space.weights)
    every = [tuple(r["values"]) for r in cells.collect()]
    fewest = []
    for factor in (1.0, 4.0, 1e6):
        sides = grid_sides(cells, space, 8).withColumn("side", F.col("base") * factor)
        placed = grid_radii(types, sides, space)
        met: dict = {}
        for r in grid_meetings(placed, cells, sides, space).collect():
            met.setdefault(tuple(r["values"]), set()).add(tuple(r["cell"]))
        for r in placed.collect():
            mine = tuple(r["values"])
            near = {c for c in every if np.linalg.norm(weights @ (np.array(c) - np.array(mine))) < r["radius"] * space.floor}
            assert near <= met.get(mine, set())
        fewest.append(min(len(v) for v in met.values()))
    assert fewest[0] < len(every) and fewest[-1] == len(every)


def test_distributed_numbering_and_running_totals(spark):
    rng = np.random.default_rng(2)
    rows = pd.DataFrame({"k": np.where(rng.random(3000) < 0.7, "hot", "cold"), "v": rng.permutation(3000), "w": rng.integers(1, 9, 3000)})
    frame = spark.createDataFrame(rows).repartition(9)
    found = numbered(frame, ["k"], [F.col("v").asc()], "place").toPandas().set_index("v").place
    rows = rows.sort_values("v")
    expected = rows.assign(place=rows.groupby("k").cumcount() + 1).set_index("v")["place"]
    assert (found.sort_index() == expected).all()
    found = running_total(frame, ["k"], [F.col("v").asc()], "w", "upto").toPandas().set_index("v").upto
    assert (found.sort_index() == rows.assign(u=rows.groupby("k").w.cumsum()).set_index("v")["u"]).all()


def test_balance_before_is_of_the_pool_and_after_of_the_sets(spark):
    """Four cases and six controls, worked out by hand; one control stays unmatched."""
    rows = [("a", 1, 40, "f"), ("b", 1, 44, "f"), ("c", 1, 50, "m"), ("d", 1, 54, "m"),
            ("k", 0, 41, "f"), ("l", 0, 43, "f"), ("m", 0, 49, "m"), ("n", 0, 55, "m"), ("o", 0, 90, "m"), ("p", 0, 42, "f")]
    people = spark.createDataFrame(rows, "person_id string, is_case int, age int, sex string")
    result = match_groups(people, MatchSpec(exact=["sex"], calipers={"age": 2}, ratio=1))
    chosen = {r.match_set_id[4:]: r.person_id for r in result.members.filter("is_case = 0").collect()}
    assert chosen == {"a": "k", "b": "l", "c": "m", "d": "n"}
    table = {r.variable: r for r in result.balance.collect()}
    spread = np.std([40, 44, 50, 54], ddof=1)
    age = table.pop("age")
    assert age.diff_before == pytest.approx((47 - 320 / 6) / spread) and age.diff_after == pytest.approx(0, abs=1e-12)
    assert age.v_ratio_before == pytest.approx(np.var([40, 44, 50, 54], ddof=1) / np.var([41, 43, 49, 55, 90, 42], ddof=1))
    (name, sex), = table.items()
    assert name in ("sex_f", "sex_m") and abs(sex.diff_before) == pytest.approx(0, abs=1e-12) and sex.v_ratio_before is None
    one = people.withColumn("site", F.lit("only"))
    table = {r.variable: r for r in match_groups(one, MatchSpec(exact=["site"], calipers={"age": 9}, ratio=1)).balance.collect()}
    assert table["site"].type == "Constant" and table["site"].diff_before is None and table["site"].diff_after is None
