"""A cross-section of the registered queries against their oracles, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from checks import registry
from checks.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
SOME = (
    "c1_schema_contract", "v9_survey_rules", "p8_nested_mask", "f1_lookback", "f6_feature_frame", "h4_g16_flow",
    "m5_greedy_ratio_4", "m6_replacement", "m8_set_layout", "b1_b2_b3_balance", "a4_a11_conditional_fit",
    "r4_continuous", "r6_screened_characteristics", "r14_coverage",
)


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


@pytest.mark.parametrize("name", SOME)
def test_query_agrees_with_its_oracle(spark, database, name):
    good, note = compare(spark, database, FOLDER, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert good, note


def test_every_query_but_the_root_search_has_an_oracle():
    assert set(registry.QUERIES) - set(registry.ORACLES) == {"a8_firth_profile_interval"}
    assert set(registry.ORACLES) <= set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
