"""Every registered query that SQL can state, against that SQL."""

import compare
import pytest

import __spark_entry__ as entry

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con(sf):
    return compare.connect(sf)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, con, name):
    assert compare.differences(QUERIES[name](spark, sf), con, ORACLES[name]) == []


def test_campaign_tables_hold_rows(spark, sf):
    for name in ("campaign_audience", "customer_features", "customer_scoring_base", "capped_count_target"):
        assert QUERIES[name](spark, sf).count() > 0, name


def test_entry(spark):
    rows = entry.entry(spark).orderBy("scr_grp").collect()
    assert [r["scr_grp"] for r in rows] == list(range(1, 11))
    assert rows[-1]["cmltv_p_perc"] == 100.0
