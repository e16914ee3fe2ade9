"""Path table, channel statistics and perimeter recap."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpath.functions.dates import utc_date
from touchpath.operators.quantiles import exact_medians

PATH_SEPARATOR = " > "


def model_paths(chains: DataFrame) -> DataFrame:
    """P17 + A8: one row per distinct path with its chain count and revenue.

    Grouping is on the array itself; ``path`` is the ``' > '`` label.
    The count is of non-NULL customers, as in the reference.
    """
    return (chains.groupBy("chain")
            .agg(F.count("customer_id").alias("nr_chains"), F.sum("purchase_value").alias("total_revenue"))
            .select("chain", F.array_join("chain", PATH_SEPARATOR).alias("path"), "nr_chains",
                    F.col("total_revenue").cast("double").alias("total_revenue")))


def touch_positions(chains: DataFrame) -> DataFrame:
    """P18 + P19: one row per touch with 1-based position and role flags.

    A mono-touch chain's only channel is last but not first; assists are all
    non-last touches.
    """
    exploded = chains.select("conversion_id", "purchase_value", F.size("chain").alias("chain_len"),
                             F.posexplode("chain").alias("pos", "channel_name"))
    order = F.col("pos") + 1
    n = F.col("chain_len")
    first = F.when((order == 1) & (order < n), 1).otherwise(0)
    last = F.when(order == n, 1).otherwise(0)
    return exploded.select(
        "conversion_id", "channel_name", order.alias("order"), "chain_len", "purchase_value",
        first.alias("first_channel"), last.alias("last_channel"),
        F.when(order < n, 1).otherwise(0).alias("assist_channel"),
        F.when(n == 1, 1).otherwise(0).alias("f_mono_touch"),
        F.when(first == 1, F.col("purchase_value")).otherwise(0).alias("first_touch_value"),
        F.when(last == 1, F.col("purchase_value")).otherwise(0).alias("last_touch_value"),
    )


def channel_stats(chains: DataFrame) -> DataFrame:
    """A9-A11 + P27: per-channel appearance, role and assist statistics.

    Two algebraic steps instead of three merged frames: collapse touches to
    (channel, conversion), then aggregate per channel. Assists and mean length
    count each conversion once per channel however often it appears.
    """
    t = touch_positions(chains)
    per_conv = t.groupBy("channel_name", "conversion_id").agg(
        F.count("*").alias("appearances"),
        F.sum("f_mono_touch").alias("mono"),
        F.sum("first_channel").alias("first"),
        F.sum("first_touch_value").alias("first_value"),
        F.sum("last_channel").alias("last"),
        F.sum("last_touch_value").alias("last_value"),
        F.max("assist_channel").alias("assisted"),
        F.max("purchase_value").alias("value"),
        F.max("chain_len").alias("chain_len"),
    )
    assisted = F.col("assisted") == 1
    stats = per_conv.groupBy("channel_name").agg(
        F.sum("appearances").alias("nr_appearances"),
        F.count("*").alias("nr_chains"),
        F.sum("mono").alias("nr_mono_touch_chains"),
        F.sum("first").alias("nr_first_touch_chains"),
        F.sum("first_value").alias("first_touch_chains_value"),
        F.sum("last").alias("nr_last_touch_chains"),
        F.sum("last_value").alias("last_touch_chains_value"),
        F.count(F.when(assisted, 1)).alias("nr_assisted_chains"),
        F.sum(F.when(assisted, F.col("value"))).alias("assisted_chains_value"),
        F.avg("chain_len").alias("mean_chain_len"),
    )
    # pandas' outer merge leaves channels without assists as NaN (D14: NULL here).
    n_assisted = F.when(F.col("nr_assisted_chains") > 0, F.col("nr_assisted_chains"))
    return stats.select(
        "channel_name", "nr_appearances", "nr_chains", "nr_mono_touch_chains", "nr_first_touch_chains",
        "first_touch_chains_value", "nr_last_touch_chains", "last_touch_chains_value",
        n_assisted.alias("nr_assisted_chains"), "assisted_chains_value", "mean_chain_len",
        F.try_divide(n_assisted, F.col("nr_last_touch_chains")).alias("assisted_per_last_touch"),
        F.try_divide(F.col("nr_first_touch_chains"), F.col("nr_last_touch_chains")).alias("first_per_last_touch"),
    )


def _joined(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """One-row frames side by side, the others as scalar subqueries."""
    held = first.select("*", *[df.select(F.struct("*")).scalar().alias(f"_row{i}") for i, df in enumerate(rest)])
    return held.select(*first.columns, *[F.col(f"_row{i}")[c].alias(c) for i, df in enumerate(rest) for c in df.columns])


def _length(chains: DataFrame):
    """A chain's number of touches: known, or its array's."""
    return F.col("chain_len") if "chain_len" in chains.columns else F.size("chain").alias("chain_len")


def perimeter_recap(chains: DataFrame, run_date: dt.date) -> DataFrame:
    """One typed row of perimeter metrics (all chains, and multi-touch ones).

    ``chains`` needs its conversions and their ``chain_len`` alone, no touches
    (``units.with_prefixes``; else the length of its array). Distinct customers
    and conversions are counted from one row per id, so no aggregation
    multiplies rows for several distinct counts, and the four medians come from
    one ``exact_medians``. The whole row is one lazy plan; ``chains`` is read by
    several branches, so give it staged. ``perimeter_report`` renders the
    (info, value) sheet.
    """
    c = chains.select("customer_id", "conversion_id", "first_event", "conversion_timestamp", "purchase_value", _length(chains))
    multi, value = F.col("chain_len") > 1, F.col("purchase_value").cast("double")
    totals = c.agg(
        F.min("first_event").alias("events_start_date"), F.max("first_event").alias("events_end_date"),
        utc_date(F.min("conversion_timestamp")).alias("conversions_start_date"),
        utc_date(F.max("conversion_timestamp")).alias("conversions_end_date"),
        F.sum("purchase_value").alias("conversions_value"), F.avg(value).alias("mean_conversions_value"),
        F.avg("chain_len").alias("mean_chain_len"),
        F.sum(F.when(multi, F.col("purchase_value"))).alias("multi_tp_conversions_value"),
        F.avg(F.when(multi, value)).alias("multi_tp_mean_conversions_value"),
        F.avg(F.when(multi, F.col("chain_len"))).alias("multi_tp_mean_chain_len"))

    names = {"customer_id": "customers", "conversion_id": "conversions"}
    id_rows = c.select(F.explode(F.array(*[F.struct(F.lit(n).alias("kind"), F.col(col).cast("string").alias("id")) for col, n in names.items()])).alias("i"),
                       F.when(multi, 1).alias("multi"))
    once = id_rows.where(F.col("i.id").isNotNull()).groupBy("i").agg(F.max("multi").alias("multi"))
    distinct = once.agg(*[F.count(F.when(F.col("i.kind") == n, v)).alias(f"{k}nr_{n}") for n in names.values()
                          for k, v in (("", F.lit(1)), ("multi_tp_", F.col("multi")))])

    # doubles keep the order of values and lengths, and a median is a double
    kinds = {"conversions_value": value, "chain_len": F.col("chain_len").cast("double")}
    tagged = F.explode(F.array(*[F.struct(F.lit(f"{k}median_{n}").alias("tag"), F.when(multi | F.lit(k == ""), v).alias("v"))
                                 for n, v in kinds.items() for k in ("", "multi_tp_")])).alias("t")
    middle = exact_medians(c.select(tagged).select("t.*")).agg(*[
        F.max(F.when(F.col("tag") == f"{k}median_{n}", F.col("median"))).alias(f"{k}median_{n}") for n in kinds for k in ("", "multi_tp_")])
    return _joined(totals, distinct, middle).withColumn("run_date", F.lit(run_date)).select(*[c for _, c in PERIMETER_LABELS])


# The labels of the report.
PERIMETER_LABELS = [
    ("Events start date", "events_start_date"),
    ("Events end date", "events_end_date"),
    ("Conversions start date", "conversions_start_date"),
    ("Conversions end date", "conversions_end_date"),
    ("Nr customers", "nr_customers"),
    ("Nr conversions", "nr_conversions"),
    ("Conversions value", "conversions_value"),
    ("Mean conversions value", "mean_conversions_value"),
    ("Median conversions value", "median_conversions_value"),
    ("Mean chain len", "mean_chain_len"),
    ("Median chain len", "median_chain_len"),
    ("Multi-TP nr customers", "multi_tp_nr_customers"),
    ("Multi-TP nr conversion", "multi_tp_nr_conversions"),
    ("Multi-TP conversions value", "multi_tp_conversions_value"),
    ("Multi-TP mean conversions value", "multi_tp_mean_conversions_value"),
    ("Multi-TP median conversions value", "multi_tp_median_conversions_value"),
    ("Multi-TP mean chain len", "multi_tp_mean_chain_len"),
    ("Multi-TP median chain len", "multi_tp_median_chain_len"),
    ("Run date", "run_date"),
]


def perimeter_report(recap: DataFrame) -> DataFrame:
    """The 19-row (info, value) sheet; chain lengths rounded to 2 digits for display."""
    two_digits = {"mean_chain_len", "median_chain_len", "multi_tp_mean_chain_len", "multi_tp_median_chain_len"}
    parts = []
    for label, col in PERIMETER_LABELS:
        v = F.round(F.col(col), 2) if col in two_digits else F.col(col)
        parts.append(F.struct(F.lit(label).alias("info"), v.cast("string").alias("value")))
    return recap.select(F.inline(F.array(*parts)))


def chain_summary(rows: DataFrame, raw: DataFrame, merged: DataFrame, final: DataFrame) -> DataFrame:
    """The driver's log counters as one row.

    Plain counters are one aggregation over the tagged union of the stages.
    Distinct ids collapse to one row per (stage, kind, id) first and are then
    plainly counted. ``rows`` is T4; give all four staged. The chains need no
    touches, their ``chain_len`` is enough.
    """
    def tagged(df, tag, length):
        return df.select(F.lit(tag).alias("stage"), length.alias("chain_len"))

    at = lambda tag, c: F.when(F.col("stage") == tag, c)
    stages = [("raw", raw), ("merged", merged), ("final", final)]
    union = tagged(rows, "input", F.lit(None).cast("int"))
    for tag, df in stages:
        union = union.unionByName(tagged(df, tag, _length(df).cast("int")))
    plain = union.agg(
        F.count(at("input", F.lit(1))).alias("input_rows"), F.count(at("raw", F.lit(1))).alias("nr_chains"),
        F.avg(at("raw", F.col("chain_len"))).alias("avg_chain_len"), F.count(at("merged", F.lit(1))).alias("nr_merged_chains"),
        F.avg(at("merged", F.col("chain_len"))).alias("avg_merged_chain_len"), F.avg(at("final", F.col("chain_len"))).alias("avg_final_chain_len"))
    converted = F.when(F.col("f_converted") == 1, F.col("event_timestamp"))
    dates = rows.agg(utc_date(F.min("first_event_timestamp")).alias("input_start_date"), utc_date(F.max("last_event_timestamp")).alias("input_end_date"),
                     utc_date(F.min(converted)).alias("conversions_start_date"), utc_date(F.max(converted)).alias("conversions_end_date"))

    def ids(df, tag, kind, column, flag=None):
        return df.select(F.lit(tag).alias("stage"), F.lit(kind).alias("kind"), F.col(column).alias("id"),
                         (flag if flag is not None else F.lit(0)).alias("flag"))

    every = ids(rows, "input", "session", "session_id", F.when(F.col("f_converted") == 1, 1)).unionByName(ids(rows, "input", "customer", "cookie_id"))
    for tag, df in stages:
        every = every.unionByName(ids(df, tag, "customer", "customer_id"))
    every = every.unionByName(ids(final, "final", "conversion", "conversion_id", F.when(_length(final) == 1, 1)))
    once = every.where(F.col("id").isNotNull()).groupBy("stage", "kind", "id").agg(F.max("flag").alias("flag"))
    of = lambda tag, kind, c=F.lit(1): F.count(F.when((F.col("stage") == tag) & (F.col("kind") == kind), c))
    flagged = F.when(F.col("flag") == 1, 1)
    distinct = once.agg(
        of("input", "session").alias("input_sessions"), of("input", "session", flagged).alias("input_conversions"),
        of("input", "customer").alias("input_customers"), of("raw", "customer").alias("chain_customers"),
        of("merged", "customer").alias("merged_customers"), of("final", "customer").alias("final_customers"),
        of("final", "conversion").alias("nr_final_chains"), of("final", "conversion", flagged).alias("nr_mono_touch_chains"))
    away = F.col("nr_chains") - F.col("nr_merged_chains")
    return _joined(plain, distinct, dates).select(
        "*", away.alias("nr_merged_away"), F.try_divide(away * 100.0, F.col("nr_chains")).alias("merged_pct"),
        F.try_divide(F.col("nr_mono_touch_chains") * 100.0, F.col("nr_final_chains")).alias("mono_touch_pct"))
