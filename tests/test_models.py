import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortlane import ModelSpec
from cohortlane.errors import DataContractError
from cohortlane.operators import estimation as est
from cohortlane.operators.models import attrition, fit_model, fit_models, packed_sets


def model(**changes):
    return ModelSpec.from_dict({"name": "m", "predictors": ["x"], **changes})


def sets_frame(spark, sets, extra=None):
    """``sets`` lists (case x, [control x, ...]); ``extra`` gives a further column by row number."""
    rows, person = [], 0
    for i, (case, controls) in enumerate(sets):
        for is_case, value in [(1, case), *[(0, c) for c in controls]]:
            rows.append((f"p{person}", f"set_{i}", is_case, value, (extra or (lambda n: 0.0))(person)))
            person += 1
    return spark.createDataFrame(rows, "person_id string, match_set_id string, is_case int, x double, z double")


def conditional_by_hand(members: pd.DataFrame, columns: list[str]):
    """Newton on the set likelihood written out over rows."""
    beta = np.zeros(len(columns))
    for _ in range(30):
        score, information = np.zeros(len(columns)), np.zeros((len(columns), len(columns)))
        for _, rows in members.groupby("match_set_id"):
            x = rows[columns].to_numpy(float)
            w = np.exp(x @ beta)
            w /= w.sum()
            mean = w @ x
            score += x[rows.is_case.to_numpy() == 1][0] - mean
            information += (x * w[:, None]).T @ x - np.outer(mean, mean)
        beta = beta + np.linalg.solve(information, score)
    return beta, np.sqrt(np.diag(np.linalg.inv(information)))


def test_one_to_one_sets_have_a_closed_form(spark):
    sets = [(1.0, [0.0])] * 30 + [(0.0, [1.0])] * 12 + [(1.0, [1.0])] * 9 + [(0.0, [0.0])] * 20
    row = fit_model(sets_frame(spark, sets), model(), "x")
    assert row["status"] == "estimated" and row["discordant_sets"] == 42
    assert row["coefficient"] == pytest.approx(math.log(30 / 12), abs=1e-9)
    assert row["standard_error"] == pytest.approx(math.sqrt(1 / 30 + 1 / 12), abs=1e-9)
    assert (row["case_with_condition"], row["control_without_condition"]) == (39, 50)


@pytest.mark.parametrize("limit", [50_000, 0], ids=["driver", "tasks"])
def test_conditional_fit_agrees_with_the_likelihood(matched, limit, monkeypatch):
    monkeypatch.setattr(est.PatternSums, "limit", limit)
    monkeypatch.setattr(est.PatternSums.__init__, "__defaults__", (None, None, None, limit))
    row = fit_model(matched.members, model(predictors=["reflux"], covariates=["age"]), "reflux")
    beta, error = conditional_by_hand(matched.members.toPandas(), ["reflux", "age"])
    assert row["status"] == "estimated", row
    assert row["coefficient"] == pytest.approx(beta[0], abs=1e-8)
    assert row["standard_error"] == pytest.approx(error[0], abs=1e-8)
    assert row["score_max"] <= 1e-3 and row["converged"]


def test_firth_on_a_saturated_table_adds_half_to_each_cell(spark):
    sets = [(1.0, [0.0, 0.0])] * 7 + [(0.0, [1.0, 0.0])] * 3 + [(0.0, [0.0, 0.0])] * 5
    row = fit_model(sets_frame(spark, sets), model(method="firth"), "x")
    a, b, c, d = 7.5, 8.5, 3.5, 27.5
    assert row["status"] == "estimated"
    assert row["coefficient"] == pytest.approx(math.log(a * d / (b * c)), abs=1e-8)
    assert row["ci_lower"] < row["odds_ratio"] < row["ci_upper"]


def test_firth_profile_bounds_lie_on_the_profile(spark):
    sets = [(1.0, [0.0, 0.0])] * 3 + [(0.0, [0.0, 0.0])] * 20
    frame = sets_frame(spark, sets, lambda n: float(n % 5))
    row = fit_model(frame, model(method="firth", covariates=["z"]), "x")
    assert row["status"] == "estimated" and math.isfinite(row["ci_upper"])
    data = frame.toPandas()
    x = np.column_stack([np.ones(len(data)), data.x, data.z])
    y = data.is_case.to_numpy(float)

    def value(beta):
        p = 1 / (1 + np.exp(-x @ beta))
        info = (x * (p * (1 - p))[:, None]).T @ x
        return (y * np.log(p) + (1 - y) * np.log(1 - p)).sum() + 0.5 * np.linalg.slogdet(info)[1]

    def best(fixed=None):
        beta = np.zeros(3)
        free = [0, 1, 2] if fixed is None else [0, 2]
        if fixed is not None:
            beta[1] = fixed
        for _ in range(400):
            p = 1 / (1 + np.exp(-x @ beta))
            w = p * (1 - p)
            info = (x * w[:, None]).T @ x
            h = w * np.einsum("ij,jk,ik->i", x, np.linalg.inv(info), x)
            score = x.T @ (y - p + h * (0.5 - p))
            step = np.zeros(3)
            step[free] = np.linalg.solve(info[np.ix_(free, free)], score[free])
            beta = beta + np.clip(step, -0.5, 0.5)
        return value(beta)

    top = best()
    for bound in ("ci_lower", "ci_upper"):
        assert 2 * (top - best(math.log(row[bound]))) == pytest.approx(est.CHI2_95, abs=1e-5)
    assert row["p_value"] == pytest.approx(math.erfc(math.sqrt((top - best(0.0)))), abs=1e-7)


def test_reasons_for_not_estimating(spark):
    def reason(sets, extra=None, **changes):
        row = fit_model(sets_frame(spark, sets, extra), model(**changes), "x")
        assert row["status"] == "non_estimable" and row["odds_ratio"] is None
        return row["reason"]

    mixed = [(1.0, [0.0])] * 5 + [(0.0, [1.0])] * 4
    assert reason([(0.0, [0.0])] * 4) == "empty_sample_or_constant_predictor"
    assert reason([(1.0, [1.0])] * 4 + [(0.0, [0.0])] * 4) == "no_within_set_predictor_information"
    assert reason(mixed, covariates=["z"], categorical=["z"], method="firth") == "constant_categorical_adjustment_term"
    assert reason(mixed, covariates=["z"], method="firth") == "rank_deficient_firth_design"
    assert reason([(1.0, [0.0])] * 9) == "unstable_or_nonconverged_conditional_fit"
    twin = sets_frame(spark, mixed).withColumn("z", F.col("x") * 2)
    row = fit_model(twin, model(covariates=["z"]), "x")
    assert row["reason"] == "rank_deficient_conditional_design"


def test_invariant_terms_are_conditioned_out(spark):
    sets = [(1.0, [0.0])] * 5 + [(0.0, [1.0])] * 4
    row = fit_model(sets_frame(spark, sets, lambda n: float(n // 2)), model(covariates=["z"]), "x")
    assert row["conditioned_out_terms"] == ["z"]
    assert row["coefficient"] == pytest.approx(math.log(5 / 4), abs=1e-9)


def test_attrition_by_hand(spark):
    """Five sets of three: one loses its case to the restriction, one its only remaining controls, one a value."""
    rows = []
    for i in range(5):
        for j in range(3):
            rows.append((f"p{i}{j}", f"set_{i}", int(j == 0), float((i + j) % 2), float(j), 1))
    lost = {"p10": 0, "p21": 0, "p22": 0, "p31": 0}
    rows = [(*r[:5], lost.get(r[0], 1)) for r in rows]
    schema = "person_id string, match_set_id string, is_case int, x double, z double, inside int"
    members = spark.createDataFrame(rows, schema).withColumn("z", F.when(F.col("person_id") != "p40", F.col("z")))
    spec = model(covariates=["z"], restriction={"field": "inside", "value": 1})
    row = attrition(packed_sets(members, spec, "x")).first().asDict()
    assert row["rows_before"] == 15 and row["rows_removed_by_restriction"] == 4
    # whole sets 1, 2 and 4 go, and of set 3 the one control outside
    assert row["sets_removed"] == 3 and row["rows_removed"] == 10
    assert fit_model(members, spec, "x")["sets_analyzed"] == 2


def test_models_without_estimate_still_count_in_their_family(spark):
    sets = [(1.0, [0.0, 1.0])] * 14 + [(0.0, [1.0, 0.0])] * 9 + [(1.0, [1.0, 0.0])] * 6
    members = sets_frame(spark, sets, lambda n: float(n * 7 % 5)).withColumn("all_same", F.lit(1.0)).withColumn(
        "y", F.when(F.col("z") > 2, 1.0).otherwise(0.0))
    spec = ModelSpec(name="three", predictors=("x", "y", "all_same"), primary=True)
    found = {r.predictor: r for r in fit_models(members, (spec,)).collect()}
    assert [r.family_size for r in found.values()] == [3, 3, 3]
    assert (found["all_same"].status, found["all_same"].p_value, found["all_same"].p_holm) == ("non_estimable", None, None)
    first, second = sorted((found["x"], found["y"]), key=lambda r: r.p_value)
    assert first.p_holm == pytest.approx(min(1, 3 * first.p_value))
    assert second.p_holm == pytest.approx(min(1, max(3 * first.p_value, 2 * second.p_value)))


def test_covariates_of_many_levels_end_in_a_reason(spark):
    members = sets_frame(spark, [(float(i % 2), [float(i % 3 == 0)]) for i in range(260)], float).withColumn(
        "born", F.concat(F.lit("day "), F.col("z").cast("string")))
    row = fit_model(members, model(covariates=["born"], categorical=["born"]), "x")
    assert row["status"] == "non_estimable" and row["reason"] == "rank_deficient_conditional_design"


def test_both_profile_bounds_take_few_passes(spark, monkeypatch):
    """Saturated table: the ends against a plain search over the closed profile, on the driver and in tasks."""
    a, b, c, e = 30, 21, 40, 66
    sets = [(y, [x]) for y, x, n in ((1.0, 1.0, a), (1.0, 0.0, b), (0.0, 1.0, c), (0.0, 0.0, e)) for _ in range(n)]
    rows = spark.createDataFrame(pd.DataFrame({"y": [y for y, _ in sets], "x": [[1.0, *x] for _, x in sets]}))

    def drop(v):
        counts = np.array([a, c, b, e]) + 0.5

        def value(t, r):
            p1, p0 = r * t / (1 + r * t), t / (1 + t)
            return counts @ np.log([p1, 1 - p1, p0, 1 - p0])

        k = (c + e + 1) * np.exp(v)
        m = (a + c + 1) * np.exp(v) + (b + e + 1) - (a + b + 1) * (1 + np.exp(v))
        t = (-m + np.sqrt(m * m + 4 * k * (a + b + 1))) / (2 * k)
        return value(t, np.exp(v))

    top = np.log((a + 0.5) * (e + 0.5) / ((b + 0.5) * (c + 0.5)))
    expected = []
    for side in (-1, 1):
        inner, outer = 0.0, 9.0
        for _ in range(80):
            middle = (inner + outer) / 2
            inside = 2 * (drop(top) - drop(top + side * middle)) < est.CHI2_95
            inner, outer = (middle, outer) if inside else (inner, middle)
        expected.append(top + side * inner)
    for limit in (50_000, 0):
        sums = est.PatternSums(est.row_patterns(rows), est.row_arrays, limit=limit)
        assert (sums.local is None) == (limit == 0)
        best = est.fit_firth(sums, 2, 50)
        passes, plain = [], est.PatternSums.__call__
        monkeypatch.setattr(est.PatternSums, "__call__", lambda self, *g: passes.append(1) or plain(self, *g))
        spread = np.sqrt(np.linalg.inv(best.information)[1, 1])
        found = est.profile_interval(sums, best, 1, 2 * spread, 50)
        monkeypatch.undo()
        assert found == pytest.approx(expected, abs=1e-8)
        assert len(passes) <= 50


def test_a_profile_that_never_drops_is_infinite(spark):
    """The search alone, over a made profile: a step at -3 on one side, flat on the other."""
    flat = est.Fit(np.zeros(2), 0.0, np.zeros(2), np.eye(2), True, 1)
    original = est.fit_profiles
    try:
        est.fit_profiles = lambda sums, p, iterations, index, values, starts: [
            est.Fit(np.array([0.0, v]), -2.0 if v < 0 and v < -3 else -1e-9, np.zeros(1), np.eye(1), True, 1) for v in values]
        low, high = est.profile_interval(None, flat, 1, 1.0, 10)
    finally:
        est.fit_profiles = original
    assert high == np.inf and low == pytest.approx(-3.0, abs=1e-6)


@pytest.mark.parametrize("spoiled", ["estimate", "profile"])
def test_firth_fits_that_stop_early_are_marked(spark, monkeypatch, spoiled):
    sets = [(1.0, [0.0])] * 12 + [(0.0, [1.0])] * 5 + [(1.0, [1.0])] * 4
    members = sets_frame(spark, sets, lambda n: float(n % 4))
    plain, profiles = est.fit_firth, est.fit_profiles

    def stopping_profiles(*arguments):
        return [est.Fit(f.beta, f.value, f.score, f.information, spoiled != "profile", f.iterations) for f in profiles(*arguments)]

    monkeypatch.setattr(est, "fit_profiles", stopping_profiles)

    def stopping(sums, p, iterations, fixed=None, start=None):
        fit = plain(sums, p, iterations, fixed=fixed, start=start)
        early = fixed is None and spoiled == "estimate"
        return est.Fit(fit.beta, fit.value, fit.score, fit.information, fit.converged and not early, fit.iterations)

    monkeypatch.setattr(est, "fit_firth", stopping)
    row = fit_model(members, model(method="firth", covariates=["z"]), "x")
    assert row["status"] == "non_estimable" and row["reason"] == "firth_engine_warning_requires_review"


def test_reused_people_and_other_values_are_rejected(spark, matched):
    with pytest.raises(DataContractError):
        fit_models(matched.members.unionByName(matched.members.limit(1)), (model(predictors=["reflux"]),))
    with pytest.raises(DataContractError):
        fit_model(sets_frame(spark, [(2.0, [0.0])] * 3), model(), "x")
