"""End-to-end plan (written stages) and report views."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from touchpath.operators.stats import PERIMETER_LABELS, perimeter_report
from touchpath.plans import registry as R
from touchpath.plans.attribution import T4_ORDER, run_pipeline
from touchpath.session import checkpoint_dir
from touchpath.sinks.versioned import read_current
from touchpath.sources.testdata import FIXTURE_WINDOWS, fixture_categories

# the fixture holds sessions with two flags
REPORTING = dataclasses.replace(R.CHAIN_CFG, on_violation="report")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_run_pipeline_matches_stage_queries(spark, tmp_dir):
    out = run_pipeline(spark, R.ga4(spark, SF_SMALL), fixture_categories(spark), FIXTURE_WINDOWS, REPORTING,
                       R.EVENTS_CFG, stage_dir=tmp_dir, output_dir=f"{tmp_dir}/out")
    assert rows(out["attribution_events"]) == rows(R.t3(spark, SF_SMALL))
    assert rows(out["chains_base"]) == rows(R.t4(spark, SF_SMALL))
    assert out["chains"].count() == R.chains_final(spark, SF_SMALL).count()
    res = out["results"]
    assert res.count() == 19 and "_run_date" in res.columns
    total = res.agg(F.sum("markov_volume")).first()[0]
    assert total == pytest.approx(out["paths"].agg(F.sum("nr_chains")).first()[0])
    # results, report and chains are written
    table = read_current(spark, f"{tmp_dir}/out/attribution_results")
    assert table.count() == 19 and table.select("_run_date").distinct().count() == 1
    assert spark.read.parquet(f"{tmp_dir}/out/report/Perimeter").count() == len(PERIMETER_LABELS)
    assert spark.read.parquet(f"{tmp_dir}/out/report/Attribution").count() == 19
    assert read_current(spark, f"{tmp_dir}/out/preprocessed_chains").count() == out["chains"].count()
    # written stages are re-read from storage, not recomputed
    assert read_current(spark, f"{tmp_dir}/attribution_chains_base").count() == out["chains_base"].count()


def test_t4_files_are_sorted(spark, tmp_dir):
    run_pipeline(spark, R.ga4(spark, SF_SMALL), fixture_categories(spark), FIXTURE_WINDOWS, REPORTING, R.EVENTS_CFG, stage_dir=tmp_dir)
    t4 = read_current(spark, f"{tmp_dir}/attribution_chains_base")
    by_file = {}
    for r in t4.select(F.input_file_name().alias("f"), *T4_ORDER).collect():
        by_file.setdefault(r["f"], []).append(tuple(r)[1:])
    assert by_file and all(v == sorted(v) for v in by_file.values())


def test_perimeter_report_sheet(spark):
    recap = R.queries()["perimeter_recap"](spark, SF_SMALL)
    sheet = perimeter_report(recap).collect()
    assert [r["info"] for r in sheet] == [label for label, _ in PERIMETER_LABELS]
    values = {r["info"]: r["value"] for r in sheet}
    assert values["Nr conversions"] == "12"
    assert values["Run date"] == "2024-02-15"


def test_checkpoint_dir_is_the_configured_one(spark):
    assert checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir() is not None
