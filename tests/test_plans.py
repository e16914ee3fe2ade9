"""Physical plan checks: semi join, checked broadcast, codegen, pushdown, no Python outside M6."""

from conftest import SF_SMALL
from touchpath.plans import registry as R


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookback_shuffles_candidates_once(spark):
    """One equi join on (cookie, day); the country comes with the coverage row, not by a second join."""
    p = plan(R.t4(spark, SF_SMALL))
    assert p.count("Join") - p.count("JoinedRow") == 1 or p.count("SortMergeJoin") + p.count("BroadcastHashJoin") == 1


def test_category_join_is_broadcast(spark):
    assert "BroadcastHashJoin" in plan(R.t3(spark, SF_SMALL))


def test_no_python_in_events_and_chains(spark):
    for df in (R.t3(spark, SF_SMALL), R.raw_chains(spark, SF_SMALL), R.chains_final(spark, SF_SMALL)):
        p = plan(df)
        assert "Python" not in p and "ArrowEval" not in p and "BatchEval" not in p


def test_markov_is_the_only_pandas_step(spark):
    from touchpath.operators import models as M
    p = plan(M.markov_attribution(R.paths(spark, SF_SMALL)))
    assert "FlatMapGroupsInPandas" in p


def test_t3_first_aggregation_hashes_raw_events(spark):
    """One scan; nothing sorts below the first exchange, and no window spans a session."""
    p = plan(R.t3(spark, SF_SMALL))
    assert p.count("FileScan parquet") == 1 and "Window" not in p
    lines = p.split("\n")
    scan = next(i for i, x in enumerate(lines) if "FileScan parquet" in x)
    first = max(i for i, x in enumerate(lines[:scan]) if "Exchange hashpartitioning(session_id" in x)
    assert not any("Sort" in x for x in lines[first:scan]) and any("HashAggregate" in x for x in lines[first:scan])


def test_partition_pruning_and_pushdown(spark, tmp_dir):
    from pyspark.sql import functions as F

    from touchpath.sources.ga4 import read_ga4_events
    from touchpath.sources.testdata import ga4_events_from_driver, read_driver_table
    ga4 = ga4_events_from_driver(read_driver_table(spark, SF_SMALL, "events"))
    ga4.write.partitionBy("event_date").parquet(f"{tmp_dir}/ga4")
    df = read_ga4_events(spark, f"{tmp_dir}/ga4", start_date="20240115").select("user_pseudo_id", "event_timestamp")
    p = plan(df)
    assert "PartitionFilters: [isnotnull(event_date" in p and "20240115" in p
    assert "ReadSchema: struct<user_pseudo_id:string,event_timestamp:bigint>" in p
    assert df.count() == ga4.where(F.col("event_date") >= "20240115").count()


def test_nested_schema_pruning_on_ga4_scan(spark, tmp_dir):
    import re

    from touchpath.operators.events import base_events
    from touchpath.sources.ga4 import read_ga4_events
    from touchpath.sources.testdata import ga4_events_from_driver, read_driver_table
    ga4_events_from_driver(read_driver_table(spark, SF_SMALL, "events")).write.partitionBy("event_date") \
        .parquet(f"{tmp_dir}/ga4n")
    df = base_events(read_ga4_events(spark, f"{tmp_dir}/ga4n", "20240101"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # untruncated ReadSchema
    try:
        schema = re.search(r"ReadSchema: (struct<\S*)", plan(df)).group(1)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "manual_campaign_name" not in schema          # only read with campaign_from='campaign'
    assert "gclid" in schema and "analytics_storage" in schema
