"""Q1-Q6: data-quality checks as violation DataFrames (empty means the check passes), and as gates of a run.

A gate is a count of violations that the write of a stage takes as it goes
(``DataFrame.observe``), so a run is stopped without another scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchpath.functions.dates import utc_date


def check_null_channel(t4: DataFrame) -> DataFrame:
    """Q1: sessions with a NULL channel."""
    return t4.where(F.col("channel_group").isNull()).select("session_id").distinct()


def check_session_dates(t4: DataFrame) -> DataFrame:
    """Q2: sessions with more than one last-event date."""
    return (t4.groupBy("session_id").agg(F.countDistinct(utc_date("last_event_timestamp")).alias("n_dates"))
            .where(F.col("n_dates") > 1))


def check_session_flags(t4: DataFrame) -> DataFrame:
    """Q3: sessions with more than one conversion flag (e.g. midnight crossing, D9)."""
    return (t4.groupBy("session_id").agg(F.countDistinct("f_converted").alias("n_flags"))
            .where(F.col("n_flags") > 1))


def check_chain_counts(t4: DataFrame, chains: DataFrame) -> DataFrame:
    """Q4: converted sessions, chains and distinct conversion ids, one row; flags a mismatch."""
    conv = t4.where(F.col("f_converted") == 1).select(F.lit("converted").alias("k"), F.col("session_id").alias("id"))
    ch = chains.select(F.lit("chain").alias("k"), F.col("conversion_id").alias("id"))
    counts = conv.unionByName(ch).agg(
        F.countDistinct(F.when(F.col("k") == "converted", F.col("id"))).alias("converted_sessions"),
        F.count(F.when(F.col("k") == "chain", 1)).alias("nr_chains"),
        F.countDistinct(F.when(F.col("k") == "chain", F.col("id"))).alias("nr_conversion_ids"),
    )
    ok = (F.col("converted_sessions") == F.col("nr_chains")) & (F.col("nr_chains") == F.col("nr_conversion_ids"))
    return counts.withColumn("consistent", ok)


def _duplicate_ids(chains: DataFrame) -> DataFrame:
    return chains.groupBy("conversion_id").agg(F.count("*").alias("n")).where(F.col("n") > 1)


def check_merge_unique(merged: DataFrame) -> DataFrame:
    """Q5: conversion ids assigned to several merged chains."""
    return _duplicate_ids(merged)


def check_concat_unique(concatenated: DataFrame) -> DataFrame:
    """Q6: conversion ids assigned to several concatenated chains."""
    return _duplicate_ids(concatenated)


class QualityError(ValueError):
    """A stage breaks a data-quality check."""


def raise_violations(counts: dict[str, int]) -> None:
    """Stop on the checks of a stage that counted violations."""
    broken = {name: n for name, n in counts.items() if n}
    if broken:
        raise QualityError(", ".join(f"{name}: {n}" for name, n in sorted(broken.items())))


def session_gates() -> dict[str, Column]:
    """Q2, Q3 over ``numbered_sessions``."""
    return {"sessions with several dates (Q2)": F.count_if("mixed_dates"), "sessions with several flags (Q3)": F.count_if("mixed_flags")}


def base_gates() -> dict[str, Column]:
    """Q1 over T4."""
    return {"touchpoints without a channel (Q1)": F.count_if(F.col("channel_group").isNull())}


def with_id_counts(heads: DataFrame) -> DataFrame:
    """Conversions with how many share their id."""
    return heads.withColumn("same_id", F.count(F.lit(1)).over(Window.partitionBy("conversion_id")))


def id_gates(check: str) -> dict[str, Column]:
    """Q4-Q6 over conversions ``with_id_counts``. A converted session closes one chain, so Q4 is that ids are unique and known."""
    return {f"conversion ids of several chains ({check})": F.count_if(F.col("same_id") > 1),
            f"conversions without an id ({check})": F.count_if(F.col("conversion_id").isNull())}
