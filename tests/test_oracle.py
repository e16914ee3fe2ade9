"""Every registered query against its DuckDB oracle (sf0.001 here; the driver runs sf0.01)."""

import pytest

import __spark_entry__ as E
from compare import compare, duck
from conftest import SF_SMALL
from touchpath.plans import registry

KEYS = sorted(registry.queries())


def test_every_query_has_an_oracle():
    assert set(registry.queries()) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    problems, _ = compare(E.queries()[key](spark, SF_SMALL), con, E.oracle_sql()[key])
    assert not problems, problems


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 733
    assert len(df.columns) == 17


def test_fixture_counts(spark):
    from touchpath.plans import registry as R
    assert R.t3(spark, SF_SMALL).select("channel_group").distinct().count() == 19
    assert R.queries()["conversions"](spark, SF_SMALL).count() == 12
    assert R.t4(spark, SF_SMALL).count() == 154
    raw = R.raw_chains(spark, SF_SMALL)
    assert raw.count() == 12
    assert raw.select("customer_id").distinct().count() == 8


@pytest.mark.parametrize("key", ["attribution_events", "chains_base", "chain_concatenation", "calendar_anchors"])
def test_results_do_not_depend_on_session_time_zone(spark, con, key):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        problems, _ = compare(E.queries()[key](spark, SF_SMALL), con, E.oracle_sql()[key])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert not problems, problems
