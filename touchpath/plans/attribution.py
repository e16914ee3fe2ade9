"""Entries 2-3: chains base, chain building, statistics and attribution models."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpath.config import ChainConfig, EventsConfig, WindowConfig
from touchpath.operators import units as U
from touchpath.operators.chains import chain_concatenation, chain_measures, chain_merge, conversion_chains, numbered_sessions
from touchpath.operators.checks import base_gates, id_gates, session_gates, with_id_counts
from touchpath.operators.lookback import chains_base
from touchpath.operators.models import attribution_results, markov_removal_effects
from touchpath.operators.stats import chain_summary, model_paths, perimeter_recap, perimeter_report
from touchpath.plans.events_preparation import attribution_events
from touchpath.session import checkpoint_dir, stage
from touchpath.sinks.writers import table_size, write_chains, write_report, write_results
from touchpath.sources.tables import fingerprint, materialise

# O1: order of T4 rows within a file.
T4_ORDER = ["cookie_id", "last_event_timestamp", "event_timestamp"]


def final_chains(raw: DataFrame, cfg: ChainConfig) -> DataFrame:
    """Merged chains, or concatenated ones (from raw or merged chains, D17)."""
    if not cfg.concat_chains:
        return chain_measures(chain_merge(raw, cfg.merge_gap_days))
    source = raw if cfg.concat_input == "raw" else chain_merge(raw, cfg.merge_gap_days).drop("rank")
    concat = chain_concatenation(source, cfg.concat_within_days)
    return chain_measures(concat.drop("chain").withColumnRenamed("concat_chain", "chain"))


def _units(heads: DataFrame, steps: DataFrame, cfg: ChainConfig) -> tuple[DataFrame, DataFrame]:
    """(conversions, steps) of the final chains, as long rows."""
    if cfg.merges:
        heads, steps = U.merged_units(heads, steps, cfg.merge_gap_days)
    return U.with_prefixes(heads, cfg.window_days), steps


def chain_units(t4: DataFrame, cfg: ChainConfig) -> tuple[DataFrame, DataFrame]:
    """T4 -> (conversions, steps) of the final chains; sessions and conversions are staged."""
    conversions, steps = _units(*U.raw_units(stage(numbered_sessions(t4), "sessions")), cfg)
    return stage(conversions, "conversions"), steps


def _analysis(conversions: DataFrame, steps: DataFrame, chains: DataFrame, cfg: ChainConfig) -> dict[str, DataFrame]:
    """Statistics, models and results; no statistic or model reads an array of touches, only ``paths`` does."""
    measures = stage(U.channel_measures(conversions, steps, cfg.window_days), "measures")  # one row per channel
    stats, heur = U.stats_of(measures), U.heuristics_of(measures)
    markov = markov_removal_effects(U.transitions_of(conversions, steps)).select("channel_name", "markov_volume", "markov_value")
    return {
        "chains": chains,
        "conversions": conversions,
        "perimeter": perimeter_recap(conversions, cfg.run_date),
        "channel_stats": stats,
        "paths": model_paths(chains),
        "markov": markov,
        "heuristics": heur,
        "results": attribution_results(stats, markov, heur, cfg.run_date),
    }


def run_attribution(chains_base_df: DataFrame, cfg: ChainConfig) -> dict[str, DataFrame]:
    """Entry 3: T4 -> chains, perimeter recap, channel statistics, models, results.

    What several outputs read is staged.
    """
    conversions, steps = chain_units(chains_base_df, cfg)
    raw = stage(conversion_chains(chains_base_df), "raw-chains")
    return {"raw_chains": raw, **_analysis(conversions, stage(steps, "steps"), stage(final_chains(raw, cfg), "chains"), cfg)}


def run_pipeline(spark: SparkSession, events: DataFrame, categories: DataFrame, window_cfg: WindowConfig, chain_cfg: ChainConfig,
                 events_cfg: EventsConfig = EventsConfig(), stage_dir: str | None = None, force: bool = True,
                 output_dir: str | None = None, mode: str = "append", run_id: str | None = None) -> dict[str, DataFrame]:
    """T1 -> T8 with the stages written to shared storage in between.

    The written stages play the role of the reference's warehouse tables and
    local caches; they also cut lineage so a lost executor re-reads a stage
    instead of recomputing the pipeline. ``stage_dir`` defaults to a fresh
    folder in the cluster's ``spark.checkpoint.dir``. Without ``force`` a stage
    made from the same inputs and options is read as it is. The checks Q1-Q6 are
    counted by the stages' own writes, and a violation stops the run
    (``ChainConfig.on_violation``). With ``output_dir`` the results (S7,
    ``mode``, ``run_id``), the report sheets (S9) and the chains (S6) are
    written there, and ``written`` has the results table's rows and columns.
    ``summary`` is the row of log counters (A14).
    """
    base = (stage_dir or f"{checkpoint_dir(spark)}/run-{uuid.uuid4().hex}").rstrip("/")
    stops = chain_cfg.on_violation == "raise"

    def staged(name: str, build, key: str, gates=None) -> DataFrame:
        return materialise(spark, build, f"{base}/{name}", force, key, gates if stops else None)

    t3_key = fingerprint("attribution_events", events, categories, events_cfg)
    t3 = staged("attribution_events", lambda: attribution_events(events, categories, events_cfg), t3_key)
    t4_key = fingerprint("chains_base", t3_key, window_cfg)
    t4 = staged("attribution_chains_base", lambda: chains_base(t3, window_cfg).sortWithinPartitions(*T4_ORDER), t4_key, base_gates())
    key = fingerprint("chains", t4_key, chain_cfg)
    sessions = staged("sessions", lambda: numbered_sessions(t4), key, session_gates())
    heads, steps = U.raw_units(sessions)
    heads = staged("raw_conversions", lambda: with_id_counts(heads), key, id_gates("Q4")).drop("same_id")
    merged, _ = U.merged_units(heads, steps, chain_cfg.merge_gap_days)
    merged = staged("merged_conversions", lambda: with_id_counts(merged), key, id_gates("Q5")).drop("same_id")
    conversions, steps = _units(heads, steps, chain_cfg)
    conversions = staged("conversions", lambda: with_id_counts(conversions), key, id_gates("Q6")).drop("same_id")
    steps = staged("steps", lambda: steps, key)
    raw = staged("raw_chains", lambda: conversion_chains(t4), key)
    chains = staged("attribution_chains", lambda: final_chains(raw, chain_cfg), key)
    size = F.col("own_len").alias("chain_len")
    summary = chain_summary(t4, heads.select("*", size), merged.select("*", size), conversions)
    out = {"attribution_events": t3, "chains_base": t4, "raw_chains": raw, "summary": summary, **_analysis(conversions, steps, chains, chain_cfg)}
    if output_dir:
        target = output_dir.rstrip("/")
        write_chains(chains, f"{target}/preprocessed_chains")
        results = f"{target}/attribution_results"
        write_results(out["results"].drop("_run_date"), results, chain_cfg.run_date, mode, run_id)
        write_report({"Perimeter": perimeter_report(out["perimeter"]), "Attribution": out["results"]}, f"{target}/report")
        out["written"] = spark.createDataFrame([table_size(spark, results)], "nr_rows long, nr_columns long")
    return out
