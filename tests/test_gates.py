"""Q1-Q6 as gates of a run, and tables that change in one step."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from touchpath.config import ChainConfig
from touchpath.operators import checks as Q
from touchpath.operators import units as U
from touchpath.operators.chains import numbered_sessions
from touchpath.sinks.versioned import commit, entries, read_current, vacuum
from touchpath.sinks.writers import create_or_replace, table_size, write_results
from touchpath.sources.tables import fingerprint, materialise
from test_units import random_t4


def build_fails(spark, tmp_dir, df, gates, name):
    """The write of ``df`` raises on ``name`` alone and leaves no table."""
    path = f"{tmp_dir}/{abs(hash(name))}"
    with pytest.raises(Q.QualityError) as e:
        materialise(spark, lambda: df, path, gates=gates)
    assert name in str(e.value) and entries(spark, path) == []
    return str(e.value)


def test_each_planted_violation_stops_its_stage(spark, tmp_dir):
    t4 = random_t4(spark, 2)
    materialise(spark, lambda: t4, f"{tmp_dir}/t4", gates=Q.base_gates())
    materialise(spark, lambda: numbered_sessions(t4), f"{tmp_dir}/sessions", gates=Q.session_gates())
    one = F.col("session_id") == "c1.5"
    build_fails(spark, tmp_dir, t4.withColumn("channel_group", F.when(~one, F.col("channel_group"))), Q.base_gates(), "(Q1)")
    both = t4.unionByName(t4.where(one).withColumn("channel_group", F.lit("Audio"))
                          .withColumn("last_event_timestamp", F.timestamp_add("DAY", F.lit(1), F.col("last_event_timestamp"))))
    text = build_fails(spark, tmp_dir, numbered_sessions(both), Q.session_gates(), "several dates (Q2): 1")
    assert "Q3" not in text
    flags = t4.unionByName(t4.where(one).withColumn("channel_group", F.lit("Audio")).withColumn("f_converted", 1 - F.col("f_converted")))
    build_fails(spark, tmp_dir, numbered_sessions(flags), Q.session_gates(), "several flags (Q3): 1")
    heads, steps = U.raw_units(numbered_sessions(t4))
    shared = heads.withColumn("conversion_id", F.when(F.col("chain_no") < 2, F.concat("customer_id", F.lit("x"))).otherwise(F.col("conversion_id")))
    merged, _ = U.merged_units(heads, steps, 3)
    merged_shared = merged.withColumn("conversion_id", F.lit("same"))
    for df, check in ((shared, "Q4"), (merged_shared, "Q5"), (U.with_prefixes(shared, 10), "Q6")):
        build_fails(spark, tmp_dir, Q.with_id_counts(df), Q.id_gates(check), f"({check})")
    for df, check in ((heads, "Q4"), (merged, "Q5"), (U.with_prefixes(heads, 10), "Q6")):
        materialise(spark, lambda df=df: Q.with_id_counts(df), f"{tmp_dir}/ok{check}", gates=Q.id_gates(check))


def test_a_run_stops_on_a_violation_or_reports(spark, tmp_dir):
    from conftest import SF_SMALL
    from touchpath.plans import registry as R
    from touchpath.plans.attribution import run_pipeline
    from touchpath.sources.testdata import FIXTURE_WINDOWS, fixture_categories
    events = R.ga4(spark, SF_SMALL)
    broken = R.queries()["check_session_flags"](spark, SF_SMALL).count() + R.queries()["check_session_dates"](spark, SF_SMALL).count()
    day = R.CHAIN_CFG.run_date
    args = (spark, events, fixture_categories(spark), FIXTURE_WINDOWS)
    if broken:
        with pytest.raises(Q.QualityError):
            run_pipeline(*args, ChainConfig(run_date=day), R.EVENTS_CFG, stage_dir=f"{tmp_dir}/a")
    out = run_pipeline(*args, ChainConfig(run_date=day, on_violation="report"), R.EVENTS_CFG, stage_dir=f"{tmp_dir}/b", output_dir=f"{tmp_dir}/o")
    assert tuple(out["summary"].select("input_rows", "nr_chains").first()) == (out["chains_base"].count(), out["raw_chains"].count())
    assert tuple(out["written"].first()) == (19, len(out["results"].columns))


def test_a_write_cut_half_way_leaves_the_old_table(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    create_or_replace(spark.range(5), path)
    dies = spark.range(100).withColumn("x", F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.lit(1)))
    with pytest.raises(Exception, match="lost"):
        create_or_replace(dies.select("id", "x"), path)
    assert read_current(spark, path).count() == 5

    def stops():
        raise RuntimeError("killed before the manifest")

    with pytest.raises(RuntimeError):
        commit(spark.range(7), path, before=stops)
    assert read_current(spark, path).count() == 5
    create_or_replace(spark.range(9), path)
    assert read_current(spark, path).count() == 9
    assert len(vacuum(spark, path)) >= 2 and vacuum(spark, path) == [] and read_current(spark, path).count() == 9


def test_a_repeated_append_of_one_run_is_held_once(spark, tmp_dir):
    path = f"{tmp_dir}/r"
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "channel_name string, v double")
    for run_id, want in (("one", 2), ("one", 2), ("two", 4), ("one", 4)):
        write_results(df, path, dt.date(2024, 2, 1), "append", run_id)
        assert table_size(spark, path) == (want, 3)
    write_results(df, path, dt.date(2024, 2, 2), "append", "three")
    write_results(df, path, dt.date(2024, 2, 1), "replace_day", "four")
    assert sorted(e.run_id for e in entries(spark, path)) == ["four", "three"]


def test_no_table_no_rows(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        read_current(spark, f"{tmp_dir}/none")


def test_a_cached_stage_knows_what_it_was_made_from(spark, tmp_dir):
    a, b = f"{tmp_dir}/a", f"{tmp_dir}/b"
    for p in (a, b):
        spark.range(3).write.parquet(p)
    key = lambda p, option: fingerprint("stage", spark.read.parquet(p), option)
    assert key(a, 1) == key(a, 1) and len({key(a, 1), key(a, 2), key(b, 1)}) == 3
    made = []

    def build():
        made.append(1)
        return spark.range(len(made))

    path = f"{tmp_dir}/cache"
    for option, want in ((1, 1), (1, 1), (2, 2), (2, 2), (1, 3)):
        assert materialise(spark, build, path, key=key(a, option)).count() == want
    spark.range(4).write.mode("overwrite").parquet(a)  # other files
    assert materialise(spark, build, path, key=key(a, 1)).count() == 4
