"""Tiny inline frames for hand fixtures (tests only)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from touchpath.schemas import GA4_EVENTS

NTZ = T.TimestampNTZType()
DEC = T.DecimalType(38, 9)

T4_SCHEMA = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("cookie_id", T.StringType()),
    T.StructField("channel_group", T.StringType()),
    T.StructField("event_timestamp", NTZ),
    T.StructField("f_converted", T.IntegerType()),
    T.StructField("session_revenue_usd", DEC),
    T.StructField("first_event_timestamp", NTZ),
    T.StructField("last_event_timestamp", NTZ),
])

CHAIN_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("conversion_id", T.StringType()),
    T.StructField("conversion_timestamp", NTZ),
    T.StructField("chain", T.ArrayType(T.StringType())),
    T.StructField("first_event", T.DateType()),
    T.StructField("purchase_date", T.DateType()),
    T.StructField("purchase_value", DEC),
    T.StructField("chain_no", T.LongType()),
])

D0 = dt.date(2024, 1, 1)


def ts(day: int, hour: int = 12, minute: int = 0, micro: int = 0) -> dt.datetime:
    return dt.datetime(2024, 1, 1, hour, minute) + dt.timedelta(days=day, microseconds=micro)


def t4_rows(spark, rows):
    """rows: (session, cookie, channel, event_ts, flag, revenue, first_ts, last_ts)."""
    return spark.createDataFrame(
        [(s, c, ch, e, f, Decimal(str(v)), a, b) for s, c, ch, e, f, v, a, b in rows], T4_SCHEMA)


def chains(spark, rows):
    """rows: (customer, conversion_id, day, chain, value, chain_no)."""
    out = []
    for cust, cid, day, chain, value, no in rows:
        d = D0 + dt.timedelta(days=day)
        out.append((cust, cid, dt.datetime.combine(d, dt.time(12)) + dt.timedelta(seconds=no), chain, d, d,
                    Decimal(str(value)), no))
    return spark.createDataFrame(out, CHAIN_SCHEMA)


def ga4_rows(spark, rows):
    """rows: dicts with optional keys; missing fields are NULL."""
    data = []
    for r in rows:
        params = [{"key": k, "value": {"string_value": sv, "int_value": iv}} for k, sv, iv in r.get("params", [])]
        data.append({
            "user_pseudo_id": r.get("user", "u1"),
            "event_name": r.get("name", "page_view"),
            "event_date": r.get("date", "20240105"),
            "event_timestamp": r.get("ts", 1704412800000000),
            "event_params": params,
            "collected_traffic_source": {"gclid": r.get("gclid"), "manual_source": r.get("source"),
                                         "manual_medium": r.get("medium"),
                                         "manual_campaign_name": r.get("campaign")},
            "traffic_source": {"source": r.get("first_source"), "medium": r.get("first_medium"),
                               "name": r.get("first_name")},
            "ecommerce": {"total_item_quantity": r.get("qty"), "purchase_revenue_in_usd": r.get("revenue")},
            "privacy_info": {"analytics_storage": r.get("storage")},
        })
    return spark.createDataFrame(data, GA4_EVENTS)
