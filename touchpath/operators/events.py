"""events_base: scoped GA4 hits projected to flat, typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpath.config import EventsConfig
from touchpath.functions import params as P
from touchpath.sources.ga4 import ga4_scan


def base_events(events: DataFrame, cfg: EventsConfig = EventsConfig()) -> DataFrame:
    """T1 -> one flat row per in-scope hit.

    Only the nested fields used here are read (nested schema pruning), and the
    scope predicates sit directly above the scan.
    """
    scoped = ga4_scan(events, cfg.start_date)
    session = P.param("event_params", "ga_session_id", cfg.strict_params)
    engaged = P.param("event_params", "session_engaged", cfg.strict_params)
    country = P.param("event_params", "country_long", cfg.strict_params)
    return scoped.select(
        P.session_key("user_pseudo_id", session["int_value"]).alias("session_id"),
        F.col("user_pseudo_id").alias("cookie_id"),
        "event_name",
        P.engaged_flag(engaged).alias("is_engaged"),
        P.country_cleanup(country).alias("country_web"),
        P.normalised_source().alias("source"),
        P.normalised_medium().alias("medium"),
        P.campaign_name(campaign_from=cfg.campaign_from).alias("campaign_name"),
        *P.first_touch_defaults(),
        F.col("ecommerce.total_item_quantity").alias("total_item_quantity"),
        F.col("ecommerce.purchase_revenue_in_usd").alias("purchase_revenue_in_usd"),
        "event_date",
        "event_timestamp",
    )
