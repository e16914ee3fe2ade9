"""Session roll-up, traffic origins and the (session, channel) table.

One first aggregation serves all of them. Its keys hold every text a later
step chooses from (origin, cookie, country, first touch), which are nearly
constant in a session, so its measures are plain numbers: it runs as a hash
aggregation that combines map-side and never sorts raw events. What picks a
first or last value works on its few rows per session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpath.functions.dates import micros_to_ts
from touchpath.schemas import REVENUE

PURCHASE = "purchase"
NONE_LABEL = "(none)"

ORIGIN = ["source", "medium", "campaign_name"]
T3_COLUMNS = [
    "session_id", "cookie_id", "is_engaged", "country_web", "f_tp", "event_timestamp", "source", "medium",
    "campaign_name", "source_medium", "channel_group", "f_converted", "total_transactions",
    "total_item_quantity", "session_revenue_usd", "first_event_timestamp", "last_event_timestamp",
]


def origin_groups(base: DataFrame) -> DataFrame:
    """One row per (session, origin, cookie, country): the shared first aggregation.

    Hits with an origin (``f_tp`` 1) have '(none)' for its missing parts (D5),
    so a NULL and an explicit '(none)' collapse; hits without one (``f_tp`` 0)
    carry their first touch instead.
    """
    tp = F.col("source").isNotNull() | F.col("medium").isNotNull()
    ts = F.col("event_timestamp")
    bought = F.col("event_name") == PURCHASE
    origin = [F.when(tp, F.coalesce(c, F.lit(NONE_LABEL))).otherwise(F.col(f"first_{c}")).alias(c) for c in ORIGIN]
    return (base.groupBy("session_id", F.when(tp, 1).otherwise(0).alias("f_tp"), *origin, "cookie_id", "country_web")
            .agg(F.min(ts).alias("t_min"), F.max(ts).alias("t_max"), F.max("is_engaged").alias("engaged"),
                 F.sum(F.when(bought, 1).otherwise(0)).alias("n_purchase"),
                 F.sum(F.when(bought, F.col("total_item_quantity")).otherwise(0)).alias("qty"),
                 F.sum(F.when(bought, F.col("purchase_revenue_in_usd")).otherwise(0.0)).alias("revenue"))
            .withColumn("source_medium", F.concat("source", F.lit("/"), "medium")))


def _partial_facts() -> list:
    """A2 measures of some of a session's groups; ``_merged_facts`` finishes them."""
    known = F.col("country_web").isNotNull()
    return [F.max(F.struct(F.col("t_max").alias("t"), F.col("cookie_id").alias("v"))).alias("cookie"),
            F.max(F.when(known, F.struct(F.col("t_max").alias("t"), F.col("country_web").alias("v")))).alias("country"),
            F.max("engaged").alias("engaged"), F.sum("n_purchase").alias("n_purchase"), F.sum("qty").alias("qty"),
            F.sum("revenue").alias("revenue"), F.min("t_min").alias("t_min"), F.max("t_max").alias("t_max")]


def _merged_facts() -> list:
    n = F.sum("n_purchase")
    return [F.max("cookie")["v"].alias("cookie_id"), F.max("engaged").alias("is_engaged"), F.max("country")["v"].alias("country_web"),
            F.when(n > 0, 1).otherwise(0).alias("f_converted"), n.cast("bigint").alias("total_transactions"),
            F.sum("qty").cast("bigint").alias("total_item_quantity"), F.sum("revenue").try_cast(REVENUE).alias("session_revenue_usd"),
            micros_to_ts(F.min("t_min")).alias("first_event_timestamp"), micros_to_ts(F.max("t_max")).alias("last_event_timestamp")]


def _earliest():
    """The earliest origin of some groups: ties go to the smallest texts."""
    return F.min(F.struct(F.col("t_min").alias("t"), *ORIGIN, "source_medium"))


def session_rollup(groups: DataFrame) -> DataFrame:
    """A2: one row per session with last cookie, engagement, country and totals."""
    return groups.groupBy("session_id").agg(*_partial_facts()).groupBy("session_id").agg(*_merged_facts())


def session_touchpoints(groups: DataFrame) -> DataFrame:
    """A3: earliest hit per (session, source, medium, campaign) among hits with an origin."""
    return (groups.where("f_tp = 1").groupBy("session_id", *ORIGIN, "f_tp").agg(F.min("t_min").alias("event_timestamp"))
            .select("session_id", *ORIGIN, "event_timestamp", "f_tp"))


def session_fallback_origin(groups: DataFrame) -> DataFrame:
    """A4: first-touch origin of the earliest origin-less hit of each session."""
    return (groups.where("f_tp = 0").groupBy("session_id").agg(_earliest().alias("o"))
            .select("session_id", *[f"o.{c}" for c in ORIGIN], F.col("o.t").alias("event_timestamp"), F.lit(0).alias("f_tp")))


def _chosen(rows, has_tp):
    """A session's touchpoints if it has any, else its one earliest fallback."""
    first = F.array_min(F.transform(rows, lambda r: r["o"]))
    return F.filter(rows, lambda r: F.when(has_tp == 1, r["f_tp"] == 1).otherwise(r["o"].eqNullSafe(first)))


def session_origins(groups: DataFrame) -> DataFrame:
    """J1 + O3: touchpoints, plus the fallback origin of sessions without any.

    ``FULL JOIN USING(session_id)`` with per-column COALESCE keeps whole
    touchpoint rows whenever a session has one, so it equals
    ``tp UNION (fallback ANTI JOIN tp)``; NULL session ids are dropped.
    """
    known = groups.where(F.col("session_id").isNotNull())
    tp, fallback = session_touchpoints(known), session_fallback_origin(known)
    alone = fallback.join(tp.select("session_id"), "session_id", "left_anti")
    return tp.unionByName(alone).select(
        "session_id", "f_tp", *ORIGIN, F.concat("source", F.lit("/"), "medium").alias("source_medium"),
        micros_to_ts("event_timestamp").alias("event_timestamp"))


def session_channels_with_facts(classified: DataFrame) -> DataFrame:
    """A5 + J1 + J2: T3 from classified origin groups.

    Groups first collapse to (session, f_tp, channel), map-side, so whatever
    number of origins a session has, at most two rows per channel of it meet in
    one task. There the fallback is decided and the roll-up finished.
    """
    per = (classified.groupBy("session_id", "f_tp", "channel_group").agg(_earliest().alias("o"), *_partial_facts()))
    sessions = (per.groupBy("session_id")
                .agg(F.collect_list(F.struct("f_tp", "channel_group", "o")).alias("rows"), F.max("f_tp").alias("has_tp"), *_merged_facts())
                .withColumn("r", F.explode(_chosen(F.col("rows"), F.col("has_tp")))))
    return (sessions.withColumns({**{c: F.col(f"r.o.{c}") for c in [*ORIGIN, "source_medium"]}, "f_tp": F.col("r.f_tp"),
                                  "channel_group": F.col("r.channel_group"), "event_timestamp": micros_to_ts("r.o.t")})
            .select(*T3_COLUMNS))
