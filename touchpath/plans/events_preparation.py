"""Entry 1: GA4 events -> attribution_events (T3), one row per (session, channel)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpath.config import EventsConfig
from touchpath.operators.channels import classify_channels
from touchpath.operators.events import base_events
from touchpath.operators.sessions import origin_groups, session_channels_with_facts


def attribution_events(events: DataFrame, categories: DataFrame, cfg: EventsConfig = EventsConfig()) -> DataFrame:
    """T1 + T2 -> T3 from one scan.

    NULL session ids are dropped before any shuffle: they would form one giant
    group and never survive the final join anyway. Plan: hash aggregation per
    (session, origin) -> broadcast category join and channel classification ->
    aggregation per (session, f_tp, channel) -> one row set per session, where
    the fallback is chosen and the roll-up finished.
    """
    base = base_events(events, cfg).where(F.col("session_id").isNotNull())
    return session_channels_with_facts(classify_channels(origin_groups(base), categories, cfg.broadcast_max_rows))
