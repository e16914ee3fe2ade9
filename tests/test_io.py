"""Sources and sinks: S3-S9."""

import csv
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from touchpath.config import MediaChannel, MediaConfig
from touchpath.functions.channels import CATEGORIES
from touchpath.operators.media import media_recap
from touchpath.plans import registry as R
from touchpath.sinks.versioned import read_current
from touchpath.sinks.writers import create_or_replace, table_size, write_chains, write_report, write_results
from touchpath.sources.categories import read_source_categories, source_flags
from touchpath.sources.tables import materialise, normalise_columns, read_table, read_weekly_csv


def test_normalise_columns(spark):
    df = spark.createDataFrame([(1, 2)], "`Session ID` int, `Last  Event` int")
    assert normalise_columns(df).columns == ["session_id", "last_event"]


def test_materialise_reads_through(spark, tmp_dir):
    path = f"{tmp_dir}/cache"
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    assert materialise(spark, build, path).count() == 5
    assert materialise(spark, build, path).count() == 5
    assert len(calls) == 1
    materialise(spark, build, path, force=True)
    assert len(calls) == 2


def test_create_or_replace_and_read_table(spark, tmp_dir):
    path = f"{tmp_dir}/t3"
    t3 = R.t3(spark, SF_SMALL)
    create_or_replace(t3, path, sort_within=["cookie_id", "event_timestamp"])
    create_or_replace(t3, path)
    assert normalise_columns(read_current(spark, path)).count() == t3.count()
    t3.write.parquet(f"{tmp_dir}/plain")
    assert read_table(spark, f"{tmp_dir}/plain").count() == t3.count()


def test_write_chains_keeps_arrays(spark, tmp_dir):
    write_chains(R.chains_final(spark, SF_SMALL), f"{tmp_dir}/chains")
    back = read_current(spark, f"{tmp_dir}/chains")
    assert dict(back.dtypes)["chain"] == "array<string>"


def test_write_results_modes(spark, tmp_dir):
    path = f"{tmp_dir}/results"
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "channel_name string, v double")
    for day, mode, want in ((1, "append", 2), (2, "append", 4), (2, "replace_day", 4), (2, "append", 6), (3, "truncate", 2)):
        write_results(df, path, dt.date(2024, 2, day), mode)
        assert table_size(spark, path) == (want, 3)
    with pytest.raises(ValueError):
        write_results(df, path, dt.date(2024, 2, 1), "overwrite")


def test_materialise_rebuilds_an_interrupted_stage(spark, tmp_dir):
    path = f"{tmp_dir}/cut"
    spark.range(5).write.parquet(path)  # written, but never marked
    assert materialise(spark, lambda: spark.range(100), path).count() == 100


def test_source_categories_csv(spark, tmp_dir):
    """A dimension of the real size: every source keeps its category, whatever else its row holds."""
    names = list(CATEGORIES.values())
    rows = [(names[i % 4], f"Source {i}, \"x\"" if i % 50 == 0 else f"source{i}.com") for i in range(819)]
    with open(f"{tmp_dir}/cats.csv", "w") as f:
        csv.writer(f).writerows([("category", "sources"), *rows])
    cats = read_source_categories(spark, f"{tmp_dir}/cats.csv")
    flags = {r["source"]: r.asDict() for r in source_flags(cats).collect()}
    assert len(flags) == 819
    for category, source in rows:
        assert [c for k, c in CATEGORIES.items() if flags[source][k]] == [category]


def test_weekly_csv_and_report(spark, tmp_dir):
    path = os.path.join(tmp_dir, "weekly.csv")
    with open(path, "w") as f:
        f.write("week_end_date,m_tot_num,m_tot_inv,m_a_num,m_a_inv\n")
        f.write("10/01/2021,10,100,4,40\n17/01/2021,0,50,0,10\n09/01/2022,5,100,5,80\n16/01/2022,5,60,1,30\n")
    w = read_weekly_csv(spark, path, ["week_end_date", "m_tot_num", "m_tot_inv", "m_a_num", "m_a_inv"])
    assert dict(w.dtypes)["week_end_date"] == "date"
    cfg = MediaConfig(perimeter=(dt.date(2021, 1, 4), dt.date(2022, 12, 31)),
                      years=(("year1", dt.date(2021, 1, 4), dt.date(2022, 1, 2)),
                             ("year2", dt.date(2022, 1, 3), dt.date(2022, 12, 31))),
                      channels=(MediaChannel("Media", "m", ("a", "tot"), ("num", "inv")),))
    recap = media_recap(w, cfg)["Media"]
    r = {(x["year_rolling"], x["split"]): x for x in recap.collect()}
    assert r[("year1", "TOT")]["cost"] == 150 and r[("year1", "TOT")]["cost_per_number"] == 15
    assert abs(r[("year2", "A")]["cost_per_number_yoy"] - ((110 / 6) / (50 / 4) - 1)) < 1e-12
    assert r[("year1", "A")]["number_perc"] == 0.4
    paths = write_report({"Media recap": recap}, f"{tmp_dir}/report", fmt="csv")
    assert spark.read.csv(paths["Media recap"], header=True).count() == 4


def test_recap_year_gap_gives_null_yoy(spark):
    q = R.queries()["channel_recap"](spark, SF_SMALL)
    y5 = q.where((F.col("year_rolling") == "year5") & (F.col("split") == "TOT")).first()
    y2 = q.where((F.col("year_rolling") == "year2") & (F.col("split") == "TOT")).first()
    assert y5["cost_per_number_yoy"] is None and y2["cost_per_number_yoy"] is not None
