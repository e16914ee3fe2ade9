"""Conversion chains, gap merge, range concatenation, measures.

All three sequence operators are written so that no per-customer window runs
over raw rows: ordered work per customer happens on (customer, hour) or
(customer, day) summaries, whose size per customer is bounded by the length of
the window, and the rest is equi-joins and grouped aggregates that Spark
partitions freely.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchpath.functions.dates import months_and_days_between, ts_to_micros, utc_date

T5_COLUMNS = ["customer_id", "conversion_id", "conversion_timestamp", "chain", "first_event",
              "purchase_date", "purchase_value", "chain_no"]


def to_customer_rows(t4: DataFrame) -> DataFrame:
    """Rename once at the T4 -> T5 boundary."""
    return (t4.withColumnRenamed("cookie_id", "customer_id")
            .withColumnRenamed("f_converted", "f_purchased")
            .withColumnRenamed("session_revenue_usd", "session_revenue"))


def _running_before(value, window):
    """Sum of the window's earlier rows."""
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("bigint")


def numbered_sessions(t4: DataFrame) -> DataFrame:
    """Per (customer, session): its channels, whether it closes a chain, its chain number and what comes before it.

    Rows are ordered by (first_event_timestamp, session_id, event_timestamp,
    channel_group) (D10), so each session is contiguous and a chain closes on
    the last row of a session whose flag is 1. T4 has one row per (session,
    channel), so a session's channels are bounded by their number.
    The chain number is the count of closing sessions before the session, and
    ``touches_before`` the customer's touches before it. Both are two-level
    prefix sums over hour buckets of the session start: sums of earlier hours
    (window over one row per customer-hour, at most 24 per day of the lookback
    range) plus sums earlier in the same hour (window per customer-hour), so no
    window spans a customer's history. ``previous`` is the session before, found
    the same way: the one before in its hour, or the last of the hour before.
    Hours are whole numbers since the epoch: no session time zone is involved.
    """
    rows = to_customer_rows(t4)
    last = F.max_by(F.struct("f_purchased", "last_event_timestamp", "session_revenue"),
                    F.struct("event_timestamp", "channel_group"))
    sess = (rows.groupBy("customer_id", "session_id")
            .agg(F.min("first_event_timestamp").alias("first_ts"), last.alias("last"),
                 F.array_sort(F.collect_list(F.struct("event_timestamp", "channel_group"))).alias("items"),
                 (F.min(utc_date("last_event_timestamp")) < F.max(utc_date("last_event_timestamp"))).alias("mixed_dates"),
                 (F.min("f_purchased") < F.max("f_purchased")).alias("mixed_flags"))
            .withColumn("closes", F.when(F.col("last.f_purchased") == 1, 1).otherwise(0))
            .withColumn("channels", F.col("items.channel_group")).drop("items")
            .withColumn("end", F.struct("first_ts", "session_id", F.element_at("channels", -1).alias("channel"), "closes"))
            .withColumn("bucket", F.floor(ts_to_micros("first_ts") / F.lit(3_600_000_000))))
    by_hour = Window.partitionBy("customer_id").orderBy("bucket")
    hours = (sess.groupBy("customer_id", "bucket")
             .agg(F.sum("closes").alias("n_closes"), F.sum(F.size("channels")).alias("n_touches"), F.max("end").alias("tail"))
             .select("customer_id", "bucket", F.lag("tail").over(by_hour).alias("before"),
                     _running_before("n_closes", by_hour).alias("closes_before"), _running_before("n_touches", by_hour).alias("hour_touches")))
    in_hour = Window.partitionBy("customer_id", "bucket").orderBy("first_ts", "session_id")
    local = sess.select("*", _running_before("closes", in_hour).alias("n"), _running_before(F.size("channels"), in_hour).alias("t"),
                        F.lag("end").over(in_hour).alias("p"))
    return (local.join(hours, ["customer_id", "bucket"])
            .select("customer_id", "session_id", "first_ts", "closes", "last", "channels", "mixed_dates", "mixed_flags", (F.col("closes_before") + F.col("n")).alias("chain_no"),
                    (F.col("hour_touches") + F.col("t")).alias("touches_before"), F.coalesce("p", "before").alias("previous")))


def conversion_chains(t4: DataFrame) -> DataFrame:
    """T4 -> T5, one row per closed chain (an unclosed tail is dropped).

    ``first_event`` is the date of the chain's first session start; id,
    timestamp, date and value come from the closing session. The chain is one
    array, as the table holds it; ``units`` has the same chains as long rows.
    """
    sess = numbered_sessions(t4)
    closing = F.when(F.col("closes") == 1, F.struct("session_id", "last"))
    grouped = sess.groupBy("customer_id", "chain_no").agg(
        F.array_sort(F.collect_list(F.struct("first_ts", "session_id", "channels"))).alias("parts"),
        F.min("first_ts").alias("first_ts"),
        F.max(closing).alias("closing"),
    ).where(F.col("closing").isNotNull())
    end_ts = F.col("closing.last.last_event_timestamp")
    return grouped.select(
        "customer_id",
        F.concat(F.col("closing.session_id"), F.lit("."), F.replace(utc_date(end_ts).cast("string"), F.lit("-"), F.lit(""))).alias("conversion_id"),
        end_ts.alias("conversion_timestamp"),
        F.flatten("parts.channels").alias("chain"),
        utc_date("first_ts").alias("first_event"),
        utc_date(end_ts).alias("purchase_date"),
        F.col("closing.last.session_revenue").alias("purchase_value"),
        "chain_no",
    )


def chain_merge(chains: DataFrame, gap_days: int = 3) -> DataFrame:
    """W3 + A7: merge a customer's purchases into islands.

    A new island starts when a purchase date is more than ``gap_days`` after
    the previous purchase date (so an island may span more than ``gap_days``).
    Same-day purchases always share an island, so islands are numbered on one
    row per (customer, purchase_date) and joined back.
    """
    days = chains.select("customer_id", "purchase_date").distinct()
    w = Window.partitionBy("customer_id").orderBy("purchase_date")
    gap = F.datediff("purchase_date", F.lag("purchase_date").over(w)) > gap_days
    days = days.withColumn("new_island", F.when(gap, 1).otherwise(0))
    days = days.withColumn("rank", F.sum("new_island").over(w.rowsBetween(Window.unboundedPreceding, 0)) + 1)
    order = F.struct("conversion_timestamp", "chain_no")
    merged = (chains.join(days.select("customer_id", "purchase_date", "rank"), ["customer_id", "purchase_date"])
              .groupBy("customer_id", "rank")
              .agg(F.max_by(F.struct("conversion_id", "conversion_timestamp", "chain_no"), order).alias("last"),
                   F.min("first_event").alias("first_event"),
                   F.max("purchase_date").alias("purchase_date"),
                   F.sum("purchase_value").alias("purchase_value"),
                   F.array_sort(F.collect_list(F.struct("conversion_timestamp", "chain_no", "chain"))).alias("parts")))
    return merged.select(
        "customer_id", F.col("rank").cast("bigint").alias("rank"), "last.conversion_id", "last.conversion_timestamp",
        F.flatten(F.transform("parts", lambda x: x["chain"])).alias("chain"),
        "first_event", "purchase_date", "purchase_value", "last.chain_no",
    )


def chain_concatenation(chains: DataFrame, within_days: int = 10) -> DataFrame:
    """Prefix each chain with the customer's chains from 1..``within_days`` days earlier.

    Oldest first; chains of one earlier day come in reverse chain order (the
    reference walks newest-first and prepends). Not transitive: only raw
    chains are prefixed. Per day, the chains form one block; a RANGE window
    over one row per (customer, day) gathers the blocks of the previous days.
    """
    blocks = (chains.groupBy("customer_id", "purchase_date")
              .agg(F.array_sort(F.collect_list(F.struct((-F.col("chain_no")).alias("k"), "chain"))).alias("parts"))
              .select("customer_id", "purchase_date",
                      F.flatten(F.transform("parts", lambda x: x["chain"])).alias("block"),
                      F.unix_date("purchase_date").alias("dn")))
    w = Window.partitionBy("customer_id").orderBy("dn").rangeBetween(-within_days, -1)
    prefixes = blocks.select(
        "customer_id", "purchase_date",
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("dn", "block")).over(w)),
                              lambda x: x["block"])).alias("prefix"))
    return (chains.join(prefixes, ["customer_id", "purchase_date"])
            .withColumn("concat_chain", F.concat("prefix", "chain")).drop("prefix"))


def chain_measures(chains: DataFrame) -> DataFrame:
    """P15 + P16 (+ D21): chain length, month-remainder duration and plain day count."""
    return chains.select(
        "*",
        F.size("chain").alias("chain_len"),
        months_and_days_between("first_event", "purchase_date").alias("chain_duration"),
        F.datediff("purchase_date", "first_event").alias("chain_duration_days"),
    )
