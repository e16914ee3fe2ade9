"""Explicit schemas of the input tables (no inference)."""

from pyspark.sql import types as T

PARAM_VALUE = T.StructType([
    T.StructField("string_value", T.StringType()),
    T.StructField("int_value", T.LongType()),
])

EVENT_PARAM = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", PARAM_VALUE),
])

# GA4 export, only the columns the preparation reads.
GA4_EVENTS = T.StructType([
    T.StructField("user_pseudo_id", T.StringType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("event_date", T.StringType()),
    T.StructField("event_timestamp", T.LongType()),
    T.StructField("event_params", T.ArrayType(EVENT_PARAM)),
    T.StructField("collected_traffic_source", T.StructType([
        T.StructField("gclid", T.StringType()),
        T.StructField("manual_source", T.StringType()),
        T.StructField("manual_medium", T.StringType()),
        T.StructField("manual_campaign_name", T.StringType()),
    ])),
    T.StructField("traffic_source", T.StructType([
        T.StructField("source", T.StringType()),
        T.StructField("medium", T.StringType()),
        T.StructField("name", T.StringType()),
    ])),
    T.StructField("ecommerce", T.StructType([
        T.StructField("total_item_quantity", T.LongType()),
        T.StructField("purchase_revenue_in_usd", T.DoubleType()),
    ])),
    T.StructField("privacy_info", T.StructType([
        T.StructField("analytics_storage", T.StringType()),
    ])),
])

# Source -> category dimension.
SOURCE_CATEGORIES = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("sources", T.StringType()),
])

REVENUE = T.DecimalType(38, 9)
