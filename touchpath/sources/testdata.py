"""Deterministic adapters from the driver tables to the reference inputs.

``events`` (event_id, ts, user_id, event_type, value, props) becomes a GA4
export (T1); ``lineitem`` becomes a wide weekly media table (T10). Both are
plain projections/aggregations, so their work grows with the input. The same
rules are written in SQL in ``oracle/``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchpath.config import MediaChannel, MediaConfig, WindowConfig
from touchpath.functions.channels import CATEGORY_SEARCH, CATEGORY_SHOPPING, CATEGORY_SOCIAL, CATEGORY_VIDEO
from touchpath.functions.dates import ts_to_micros
from touchpath.sources.ga4 import PROTOCOL_EVENT_NAME
from touchpath.schemas import EVENT_PARAM

# Traffic fields of fixture row n = k % 26
# (manual_source, manual_medium, manual_campaign_name, gclid, first source, first medium, first name).
TRAFFIC_ROWS = [
    ("(direct)", "(none)", None, None, None, None, None),
    ("google", "organic", "winter cross-network", "g1", "google", "cpc", "brand"),
    ("Google", "Organic", None, None, "google", "organic", "(organic)"),
    ("ads", "cross-network", "x", None, "google", "cpc", "x"),
    ("amazon.com", "cpc", "sale", None, "amazon.com", "cpc", "sale"),
    ("facebook.com", "paid-social", "spring", None, "facebook.com", "paid", "spring"),
    ("youtube.com", "cpv", "clip", None, "youtube.com", "cpv", "clip"),
    ("adnet", "banner", "b1", None, "adnet", "banner", "b1"),
    ("adnet", "retargeting", "b2", None, "adnet", "retargeting", "b2"),
    ("partner", "shopping", "summer shop", None, "partner", "shopping", "summer shop"),
    ("facebook.com", "post", None, None, "facebook.com", "post", None),
    ("youtube.com", "watch", None, None, "youtube.com", "watch", None),
    ("blog.example", "referral", None, None, "blog.example", "referral", None),
    ("newsletter", "e-mail", "weekly", None, "newsletter", "e-mail", "weekly"),
    ("awin", "affiliate", "a", None, "awin", "affiliate", "a"),
    ("radio", "audio", "r", None, "radio", "audio", "r"),
    ("crm", "sms", "s", None, "crm", "sms", "s"),
    ("firebase", "x", "p", None, "firebase", "x", "p"),
    ("app1", "web-push", "p", None, "app1", "web-push", "p"),
    ("misc", "misc", "m", None, "misc", "misc", "m"),
    (None, None, None, None, None, None, None),
    (None, None, None, None, "google", "organic", "(organic)"),
    (None, None, None, None, "IGShopping", "Social", "ig"),
    ("linkedin.com", None, None, None, "linkedin.com", None, None),
    (None, "display", "d", None, "x", "display", "d"),
    ("bing", "cpc", "brand", None, "bing", "cpc", "brand"),
]

# Fixture source categories (category, source).
FIXTURE_CATEGORIES = [
    (CATEGORY_SEARCH, "google"),
    (CATEGORY_SEARCH, "bing"),
    (CATEGORY_SOCIAL, "facebook.com"),
    (CATEGORY_SOCIAL, "linkedin.com"),
    (CATEGORY_VIDEO, "youtube.com"),
    (CATEGORY_SHOPPING, "amazon.com"),
    (CATEGORY_SHOPPING, "IGShopping"),
]

# Fixture windows.
FIXTURE_WINDOWS = WindowConfig(as_of=dt.date(2024, 2, 15), conversion_period=12, lookback_window=10)
FIXTURE_START_DATE = "20240102"  # after the first day of the driver's events

# Media recap fixture over lineitem.
FIXTURE_MEDIA = MediaConfig(
    perimeter=(dt.date(1995, 1, 2), dt.date(1999, 12, 26)),
    years=(
        ("year1", dt.date(1995, 1, 2), dt.date(1995, 12, 31)),
        ("year2", dt.date(1996, 1, 1), dt.date(1996, 12, 29)),
        ("year3", dt.date(1996, 12, 30), dt.date(1997, 12, 28)),
        ("year5", dt.date(1998, 12, 28), dt.date(1999, 12, 26)),
    ),
    channels=(MediaChannel("Lineitems", "li", ("a", "n", "r", "tot"), ("num", "inv")),
              MediaChannel("Off TV", "off_tv", ("f", "o", "tot"), ("imp", "grp", "inv"))),
)
RETURN_FLAGS = ("A", "N", "R")


# All per-``k`` rules repeat with period lcm(26, 7, 5, 3) = 2730.
K_PERIOD = 2730
_COUNTRIES = ("Italy", "France", "Europe", "international")


def _param(key, string_value=None, int_value=None):
    return {"key": key, "value": {"string_value": string_value, "int_value": int_value}}


def _k_row(k: int) -> dict:
    src, med, camp, gclid, ts_src, ts_med, ts_name = TRAFFIC_ROWS[k % 26]
    k7 = k % 7
    if k7 == 0:
        engaged = _param(None)  # absent: a NULL key never matches a lookup
    elif k7 < 3:
        engaged = _param("session_engaged", "1")
    elif k7 < 5:
        engaged = _param("session_engaged", None, 1)
    else:
        engaged = _param("session_engaged", "x")
    country = _param("country_long", _COUNTRIES[k % 5]) if k % 5 < 4 else _param(None)
    return {"k_key": k, "manual_source": src, "manual_medium": med, "manual_campaign_name": camp, "gclid": gclid,
            "ts_source": ts_src, "ts_medium": ts_med, "ts_name": ts_name, "engaged_param": engaged,
            "country_param": country, "quantity": 1 + k % 5, "purchase_kept": k % 3 == 0}


_K_SCHEMA = T.StructType(
    [T.StructField("k_key", T.IntegerType())]
    + [T.StructField(c, T.StringType()) for c in ("manual_source", "manual_medium", "manual_campaign_name", "gclid",
                                                    "ts_source", "ts_medium", "ts_name")]
    + [T.StructField("engaged_param", EVENT_PARAM), T.StructField("country_param", EVENT_PARAM),
       T.StructField("quantity", T.LongType()), T.StructField("purchase_kept", T.BooleanType())])


def fixture_dimension(spark: SparkSession) -> DataFrame:
    """Per-``k`` fixture fields (traffic row, parameters, quantity), generated by rule.

    2730 rows, fixed by construction, so it is broadcast without a size check.
    """
    return spark.createDataFrame([_k_row(k) for k in range(K_PERIOD)], _K_SCHEMA)


def ga4_events_from_driver(events: DataFrame) -> DataFrame:
    """Driver ``events`` -> GA4 export rows (T1 schema).

    ``k`` is parsed once; everything derived from it comes from a broadcast
    lookup, so predicates on those fields stay above the join instead of
    being pushed into the scan with the JSON parsing inlined into each.
    Absent parameters are entries with a NULL key (no lookup matches them).
    """
    k = F.get_json_object("props", "$.k").cast("int")
    df = events.select("event_id", "ts", "user_id", "event_type", "value", F.pmod(k, F.lit(K_PERIOD)).alias("k_key"))
    # The driver files are single row groups, so the scan is one task; spread
    # the per-row adapter work when the scan is narrower than the cluster.
    parallelism = events.sparkSession.sparkContext.defaultParallelism
    if len(events.inputFiles()) < parallelism:
        df = df.repartition(parallelism)
    df = df.join(F.broadcast(fixture_dimension(events.sparkSession)), "k_key", "left")
    eid = F.col("event_id")
    day = F.date_format("ts", "yyyyMMdd")
    session_day = F.date_format(F.col("ts") - F.expr("INTERVAL 6 HOURS"), "yyyyMMdd")  # sessions cross midnight
    session_param = F.struct(
        F.when(eid % 50 != 7, F.lit("ga_session_id")).alias("key"),
        F.struct(F.lit(None).cast("string").alias("string_value"), session_day.cast("bigint").alias("int_value")).alias("value"))
    params = F.array(session_param, F.col("engaged_param"), F.col("country_param")).cast(T.ArrayType(EVENT_PARAM))
    event_name = (F.when(eid % 97 == 0, F.lit("x_iBQML"))
                  .when(eid % 89 == 0, F.lit(PROTOCOL_EVENT_NAME))
                  .when((F.col("event_type") == "purchase") & ~F.col("purchase_kept"), F.lit("add_to_cart"))
                  .otherwise(F.col("event_type")))
    storage = F.when(eid % 10 < 5, F.lit(None).cast("string")).when(eid % 10 < 9, F.lit("Yes")).otherwise(F.lit("No"))
    return df.select(
        F.col("user_id").cast("string").alias("user_pseudo_id"),
        event_name.alias("event_name"),
        day.alias("event_date"),
        ts_to_micros(F.col("ts")).alias("event_timestamp"),
        params.alias("event_params"),
        F.struct("gclid", "manual_source", "manual_medium", "manual_campaign_name").alias("collected_traffic_source"),
        F.struct(F.col("ts_source").alias("source"), F.col("ts_medium").alias("medium"),
                 F.col("ts_name").alias("name")).alias("traffic_source"),
        F.struct(F.col("quantity").alias("total_item_quantity"),
                 F.col("value").cast("double").alias("purchase_revenue_in_usd")).alias("ecommerce"),
        F.struct(storage.alias("analytics_storage")).alias("privacy_info"),
    )


def fixture_categories(spark: SparkSession) -> DataFrame:
    """The seven-row fixture category dimension."""
    schema = T.StructType([T.StructField("category", T.StringType()), T.StructField("sources", T.StringType())])
    return spark.createDataFrame(FIXTURE_CATEGORIES, schema)


def weekly_media_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Driver ``lineitem`` -> wide weekly table ``li_<flag>_<num|inv>`` and ``off_tv_<status>_<imp|grp|inv>``.

    One partial aggregation by week; the output has one row per week.
    """
    # Sunday closing the ISO week of the ship date (on or after it).
    week_end = F.next_day(F.date_sub(F.to_date("l_shipdate"), 1), "Sun")
    aggs = []
    for flag in RETURN_FLAGS:
        is_flag = F.col("l_returnflag") == flag
        aggs.append(F.sum(F.when(is_flag, F.col("l_quantity")).otherwise(0.0)).alias(f"li_{flag.lower()}_num"))
        aggs.append(F.sum(F.when(is_flag, F.col("l_extendedprice")).otherwise(0.0)).alias(f"li_{flag.lower()}_inv"))
    for name, is_status in (("f", F.col("l_linestatus") == "F"), ("o", F.col("l_linestatus") == "O"), ("tot", F.lit(True))):
        aggs += [F.count(F.when(is_status, 1)).alias(f"off_tv_{name}_imp"),
                 F.sum(F.when(is_status, F.col("l_linenumber")).otherwise(0)).alias(f"off_tv_{name}_grp"),
                 F.sum(F.when(is_status, F.col("l_extendedprice")).otherwise(0.0)).alias(f"off_tv_{name}_inv")]
    aggs.append(F.sum("l_quantity").alias("li_tot_num"))
    aggs.append(F.sum("l_extendedprice").alias("li_tot_inv"))
    return (lineitem.select("l_shipdate", "l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_extendedprice")
            .groupBy(week_end.alias("week_end_date")).agg(*aggs))


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
