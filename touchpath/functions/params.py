"""GA4 event-parameter lookups and traffic-origin normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def param(params_col: str, key: str, strict: bool = False) -> Column:
    """The ``value`` struct of the first ``event_params`` entry with ``key``.

    NULL when the key is absent. Written with ``array_position`` on the key
    array and a safe 0-based ``get`` (no lambda), so it stays in whole-stage
    codegen. ``strict`` raises on duplicate keys (the warehouse aborts a scalar
    subquery returning more than one row).
    """
    keys = F.col(params_col)["key"]
    first = F.get(F.col(params_col), (F.array_position(keys, F.lit(key)) - 1).cast("int"))["value"]
    if not strict:
        return first
    n_matches = F.size(keys) - F.size(F.array_remove(keys, F.lit(key)))
    return F.when(n_matches > 1, F.raise_error(F.lit(f"duplicate event_params key '{key}'"))).otherwise(first)


def session_key(user_col: str, session_param: Column) -> Column:
    """``user_pseudo_id || '_' || ga_session_id``; NULL if either side is NULL."""
    return F.concat(F.col(user_col), F.lit("_"), session_param.cast("string"))


def engaged_flag(value: Column) -> Column:
    """Safe integer of string_value, else int_value, else 0; NULL without the key."""
    parsed = F.coalesce(value["string_value"].try_cast("bigint"),
                        value["int_value"], F.lit(0).cast("bigint"))
    return F.when(value.isNotNull(), parsed)


# Country labels that are not a country.
GENERIC_COUNTRIES = ("Europe", "international")


def country_cleanup(value: Column) -> Column:
    """``country_long`` string value with generic labels turned into NULL."""
    s = value["string_value"]
    return F.when(s.isin(*GENERIC_COUNTRIES), F.lit(None).cast("string")).otherwise(s)


def _google_paid(traffic: str) -> Column:
    t = F.col(traffic)
    return t["gclid"].isNotNull() & (F.lower(t["manual_source"]) == "google")


def normalised_source(traffic: str = "collected_traffic_source") -> Column:
    """P5: lower-case source, 'google' when a gclid is present on a google hit."""
    return F.when(_google_paid(traffic), F.lit("google")).otherwise(F.lower(F.col(traffic)["manual_source"]))


def normalised_medium(traffic: str = "collected_traffic_source") -> Column:
    """P5: lower-case medium, 'cpc' when a gclid is present on a google hit."""
    return F.when(_google_paid(traffic), F.lit("cpc")).otherwise(F.lower(F.col(traffic)["manual_medium"]))


def campaign_name(traffic: str = "collected_traffic_source", campaign_from: str = "medium") -> Column:
    """Lower-case campaign; the shipped query reads the medium field (option)."""
    field = "manual_medium" if campaign_from == "medium" else "manual_campaign_name"
    return F.lower(F.col(traffic)[field])


def first_touch_defaults(traffic: str = "traffic_source") -> list[Column]:
    """Session first-touch source/medium/name with defaults, case kept."""
    t = F.col(traffic)
    return [
        F.coalesce(t["source"], F.lit("(direct)")).alias("first_source"),
        F.coalesce(t["medium"], F.lit("(none)")).alias("first_medium"),
        F.coalesce(t["name"], F.lit("(none)")).alias("first_campaign_name"),
    ]
