"""Conversions and their lookback touchpoints (T3 -> T4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchpath.config import WindowConfig
from touchpath.functions.dates import minus_days, utc_date

ZEROED = ["f_converted", "total_transactions", "total_item_quantity", "session_revenue_usd"]


def calendar_anchors(dates: DataFrame, as_of_col: str, cfg: WindowConfig) -> DataFrame:
    """P11 as columns: for each ``as_of`` date, the month-end anchor and window starts."""
    last = F.date_sub(F.trunc(F.col(as_of_col), "month"), 1)
    return dates.select(
        F.col(as_of_col),
        last.alias("last_day_of_previous_month"),
        F.date_sub(last, cfg.conversion_period).alias("conversion_start"),
        F.date_sub(last, cfg.conversion_period + cfg.lookback_window).alias("candidate_start"),
    )


def _first_date():
    return utc_date("first_event_timestamp")


def conversions(t3: DataFrame, cfg: WindowConfig) -> DataFrame:
    """F6 + O5: distinct converted sessions whose first hit falls in the conversion period."""
    return (t3.where((F.col("f_converted") == 1)
                     & _first_date().between(F.lit(cfg.conversion_start), F.lit(cfg.last_day)))
            .select("session_id", "cookie_id", F.col("last_event_timestamp").alias("conversion_timestamp"),
                    "total_transactions", "total_item_quantity", "session_revenue_usd")
            .distinct())


def lookback_candidates(t3: DataFrame, cfg: WindowConfig) -> DataFrame:
    """F7 + P13: touchpoints of sessions starting in the conversion+lookback window.

    Conversion measures are zeroed when the touchpoint precedes the conversion
    period, so earlier purchases count as plain touchpoints. T3 is unique on
    (session, channel), so the warehouse DISTINCT is a no-op and is not planned.
    """
    in_period = utc_date("event_timestamp") >= F.lit(cfg.conversion_start)
    zeroed = [F.when(in_period, F.col(c)).otherwise(F.lit(0).cast(t3.schema[c].dataType)).alias(c) for c in ZEROED]
    return (t3.where(_first_date().between(F.lit(cfg.candidate_start), F.lit(cfg.last_day)))
            .select("session_id", "cookie_id", "country_web", "is_engaged", "event_timestamp", "source", "medium",
                    "campaign_name", "source_medium", "channel_group", *zeroed,
                    "first_event_timestamp", "last_event_timestamp"))


def last_country(candidates: DataFrame) -> DataFrame:
    """Latest known web country per cookie, over all candidate touchpoints."""
    has = F.col("country_web").isNotNull()
    return (candidates.groupBy("cookie_id")
            .agg(F.max_by(F.when(has, F.col("country_web")),
                          F.when(has, F.struct("event_timestamp", "country_web"))).alias("country")))


def lookback_coverage(convs: DataFrame, lookback_days: int, candidate_days: DataFrame) -> DataFrame:
    """Per (cookie, day): the part of that day covered by some ``(c - L, c]`` window, and the cookie's country.

    A conversion c covers whole days strictly between ``date(c) - L`` and
    ``date(c)``, the tail of day ``date(c) - L`` after ``c - L`` and the head of
    day ``date(c)`` up to ``c``. Each conversion emits three rows: a +1/-1
    difference pair bracketing its whole days (the -1 row also carries ``c``
    as the head bound) and the tail bound ``c - L``. Rows for every candidate
    (cookie, day) are added with no effect, one aggregation collapses each
    (cookie, day) to sum/max/min, and a running sum of the differences per
    cookie, over at most one row per day of the window, marks whole-day
    coverage. Three rows per conversion instead of ``L + 1``. The candidates'
    days bring their latest known country, and the same days of a cookie give
    its latest one (A6).
    """
    c = F.col("conversion_timestamp")
    d = utc_date(c)
    null_ts = F.lit(None).cast("timestamp_ntz")
    rows = convs.select("cookie_id", F.explode(F.array(
        F.struct(F.date_sub(d, lookback_days - 1).alias("day"), F.lit(1).alias("delta"),
                 null_ts.alias("until"), null_ts.alias("after")),
        F.struct(d.alias("day"), F.lit(-1).alias("delta"), c.alias("until"), null_ts.alias("after")),
        F.struct(F.date_sub(d, lookback_days).alias("day"), F.lit(0).alias("delta"),
                 null_ts.alias("until"), minus_days(c, lookback_days).alias("after")),
    )).alias("r")).select("cookie_id", "r.*")
    keys = candidate_days.select("cookie_id", "day", F.lit(0).alias("delta"),
                                 null_ts.alias("until"), null_ts.alias("after"), "latest")
    per_day = (rows.unionByName(keys, allowMissingColumns=True).groupBy("cookie_id", "day")
               .agg(F.sum("delta").alias("delta"), F.max("until").alias("covered_until"),
                    F.min("after").alias("covered_after"), F.max("latest").alias("latest")))
    days = Window.partitionBy("cookie_id").orderBy("day")
    running = F.sum("delta").over(days.rowsBetween(Window.unboundedPreceding, 0))
    country = F.max("latest").over(days.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))["country_web"]
    return per_day.select("cookie_id", "day", (running > 0).alias("full_day"), "covered_until", "covered_after", country.alias("country"))


def in_lookback(candidates: DataFrame, convs: DataFrame, lookback_days: int) -> DataFrame:
    """J4 + F8 + J5: candidates whose first hit lies in ``(c - L, c]`` of some conversion of the cookie, with its country.

    A range semi join written as an equi join on (cookie, day) with the
    coverage summary, which has one row per (cookie, day) and so at most one
    match: one lookup per candidate, no pairwise comparison, and a hot cookie
    is split across days (and by AQE skew handling within a day).
    """
    f = F.col("first_event_timestamp")
    known = F.when(F.col("country_web").isNotNull(), F.struct("event_timestamp", "country_web"))
    days = candidates.groupBy("cookie_id", utc_date(f).alias("day")).agg(F.max(known).alias("latest"))
    cov = lookback_coverage(convs, lookback_days, days).withColumnRenamed("cookie_id", "cov_cookie")
    cond = ((F.col("cookie_id") == F.col("cov_cookie")) & (utc_date(f) == F.col("day"))
            & (F.col("full_day") | (f <= F.col("covered_until")) | (f > F.col("covered_after"))))
    return candidates.join(cov, cond).select(*candidates.columns, "country")


T4_COLUMNS = [
    "session_id", "cookie_id", "country", "is_engaged", "source", "medium", "campaign_name", "source_medium",
    "channel_group", "event_timestamp", "f_converted", "total_transactions", "total_item_quantity",
    "session_revenue_usd", "first_event_timestamp", "last_event_timestamp",
]


def chains_base(t3: DataFrame, cfg: WindowConfig) -> DataFrame:
    """Entry 2: T3 -> T4 (attribution_chains_base).

    Rows are unique (session, channel) touchpoints and each meets at most one
    coverage row, so the final DISTINCT has nothing to do. The warehouse ORDER BY is a presentation sort;
    writers apply it with ``sortWithinPartitions`` (O1).
    """
    cand = lookback_candidates(t3, cfg)
    # The coverage summary is built from max/min only, so duplicate conversion
    # rows (one per channel of the session) need no DISTINCT exchange.
    convs = (t3.where((F.col("f_converted") == 1)
                      & _first_date().between(F.lit(cfg.conversion_start), F.lit(cfg.last_day)))
             .select("cookie_id", F.col("last_event_timestamp").alias("conversion_timestamp")))
    kept = in_lookback(cand.where(F.col("cookie_id").isNotNull()), convs, cfg.lookback_window)
    return kept.where(F.col("channel_group").isNotNull()).select(*T4_COLUMNS)
