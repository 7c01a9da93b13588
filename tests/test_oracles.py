"""Every registered query against its SQL oracle."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry
from serplens.plans.oracles import ORACLES
from serplens.plans.queries import REGISTRY

# Selections of ranks and filters that the smallest tables leave empty.
MAY_BE_EMPTY = {"rank_range", "zero_click_filtered", "rewrite_skipped"}


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(ORACLES)
    assert set(REGISTRY) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(REGISTRY))
def test_matches_oracle(spark, tiny, key):
    problem = compare(spark, connect(tiny), tiny, REGISTRY[key], ORACLES[key])
    assert problem == "" or (problem == "no rows" and key in MAY_BE_EMPTY)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["path", "query", "impressions", "position", "page_impressions", "page_clicks"]
    assert df.count() > 0
