"""S1 + F1-F3: scan of the GA4 export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpath.schemas import GA4_EVENTS

# Hits removed before sessionisation.
PROTOCOL_EVENT_NAME = "privacy_info.analytics_storage"
BQML_EVENT_PATTERN = "%_iBQML"
CONSENT_GRANTED = "Yes"


def read_ga4_events(spark: SparkSession, path: str, start_date: str = "20230101") -> DataFrame:
    """Parquet export partitioned by ``event_date`` (yyyyMMdd).

    The ``event_date >= start_date`` literal reaches the file index, so older
    partitions are pruned without being listed or read.
    """
    df = spark.read.schema(GA4_EVENTS).parquet(path)
    return df.where(F.col("event_date") >= F.lit(start_date))


def scope_filter() -> Column:
    """Consented hits, no measurement-protocol hits, no BQML hits.

    ``!=`` and ``NOT LIKE`` both drop NULL event names, as the warehouse does.
    ``_`` in the LIKE pattern is a single-character wildcard.
    """
    storage = F.col("privacy_info.analytics_storage")
    return ((storage.isNull() | (storage == CONSENT_GRANTED))
            & (F.col("event_name") != PROTOCOL_EVENT_NAME)
            & ~F.col("event_name").like(BQML_EVENT_PATTERN))


def ga4_scan(events: DataFrame, start_date: str = "20230101") -> DataFrame:
    """S1 + F1-F3 applied to an already loaded export."""
    return events.where((F.col("event_date") >= F.lit(start_date)) & scope_filter())
