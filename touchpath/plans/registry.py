"""Query registry: every stage over the driver tables, keyed as in the survey inventory.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame built from the
driver ``events`` / ``lineitem`` tables through the fixture adapters.
Array columns are rendered as ``' > '`` paths and floating results rounded here
(operators don't round) so that an independent SQL engine can be compared value
by value. A stage that several branches read is written as Parquet while the
query is built; what follows it is lazy.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpath.config import ChainConfig, EventsConfig
from touchpath.functions import params as P
from touchpath.functions.dates import minus_days
from touchpath.operators import chains as CH
from touchpath.operators import checks as Q
from touchpath.operators import lookback as L
from touchpath.operators import media as MD
from touchpath.operators import models as M
from touchpath.operators import sessions as S
from touchpath.operators import stats as ST
from touchpath.operators import units as U
from touchpath.operators.channels import classify_channels
from touchpath.operators.events import base_events
from touchpath.plans.attribution import chain_units, final_chains
from touchpath.plans.events_preparation import attribution_events
from touchpath.session import stage
from touchpath.sources.ga4 import ga4_scan
from touchpath.sources.tables import normalise_columns
from touchpath.sources.testdata import (FIXTURE_MEDIA, FIXTURE_START_DATE, FIXTURE_WINDOWS, fixture_categories,
                                        ga4_events_from_driver, read_driver_table, weekly_media_from_lineitem)

EVENTS_CFG = EventsConfig(start_date=FIXTURE_START_DATE)
CHAIN_CFG = ChainConfig(run_date=FIXTURE_WINDOWS.as_of)
SEP = " > "


def _path(c: str):
    return F.array_join(F.col(c), SEP).alias(c)


def _round(df: DataFrame, digits: int, cols: list[str]) -> DataFrame:
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c) for c in df.columns])


# --- stage builders -------------------------------------------------------

def ga4(spark, d):
    return ga4_events_from_driver(read_driver_table(spark, d, "events"))


def base(spark, d):
    return base_events(ga4(spark, d), EVENTS_CFG)


def t3(spark, d):
    return attribution_events(ga4(spark, d), fixture_categories(spark), EVENTS_CFG)


def t4(spark, d):
    # read three times: candidates, their days, conversions
    return L.chains_base(stage(t3(spark, d), "t3"), FIXTURE_WINDOWS)


def raw_chains(spark, d):
    return CH.conversion_chains(t4(spark, d))


def chains_final(spark, d):
    # the concatenation reads the chains twice
    return final_chains(stage(raw_chains(spark, d), "raw-chains"), CHAIN_CFG)


def units(spark, d):
    """(conversions, steps) of the final chains, as long rows."""
    return chain_units(t4(spark, d), CHAIN_CFG)


def measures(spark, d):
    return U.channel_measures(*units(spark, d), CHAIN_CFG.window_days)


def transitions(spark, d):
    return U.transitions_of(*units(spark, d))


def paths(spark, d):
    return ST.model_paths(chains_final(spark, d))


def weekly(spark, d):
    return weekly_media_from_lineitem(read_driver_table(spark, d, "lineitem"))


def recap(spark, d, ch=FIXTURE_MEDIA.channels[0]):
    return MD.channel_recap(MD.with_rolling_year(weekly(spark, d), FIXTURE_MEDIA), ch)


# --- registered queries ---------------------------------------------------

def q_ga4_scan(spark, d):
    e = ga4_scan(ga4(spark, d), FIXTURE_START_DATE)
    return e.select("user_pseudo_id", "event_name", "event_date", "event_timestamp",
                    F.col("privacy_info.analytics_storage").alias("analytics_storage"))


def q_event_param_lookup(spark, d):
    e = ga4_scan(ga4(spark, d), FIXTURE_START_DATE)
    s = P.param("event_params", "ga_session_id")
    g = P.param("event_params", "session_engaged")
    c = P.param("event_params", "country_long")
    return e.select("user_pseudo_id", "event_timestamp", s["int_value"].alias("ga_session_id"),
                    g["string_value"].alias("engaged_string_value"), g["int_value"].alias("engaged_int_value"),
                    c["string_value"].alias("country_long"))


def _base_cols(*cols):
    def q(spark, d):
        return base(spark, d).select("cookie_id", "event_timestamp", *cols)
    return q


def q_normalise_columns(spark, d):
    """T3 exported with display labels ('Session Id', 'F Tp', ...) read back normalised."""
    t = t3(spark, d)
    labelled = t.toDF(*[c.replace("_", " ").title() for c in t.columns])
    return normalise_columns(labelled)


def q_campaign_name(spark, d):
    e = ga4_scan(ga4(spark, d), FIXTURE_START_DATE)
    return e.select(F.col("user_pseudo_id").alias("cookie_id"), "event_timestamp",
                    P.campaign_name(campaign_from="medium").alias("campaign_name"),
                    P.campaign_name(campaign_from="campaign").alias("campaign_name_from_campaign"))


def groups(spark, d):
    return S.origin_groups(base(spark, d))


def q_channel_classification(spark, d):
    return classify_channels(S.session_origins(groups(spark, d)), fixture_categories(spark))


def q_session_channels(spark, d):
    """A5 as T3 holds it."""
    return t3(spark, d).select("session_id", *S.ORIGIN, "source_medium", "channel_group", "f_tp", "event_timestamp")


def q_calendar_anchors(spark, d):
    dates = ga4(spark, d).select(F.to_date("event_date", "yyyyMMdd").alias("as_of")).distinct()
    return L.calendar_anchors(dates, "as_of", FIXTURE_WINDOWS)


def q_last_country(spark, d):
    return L.last_country(L.lookback_candidates(t3(spark, d), FIXTURE_WINDOWS))


def q_period_zeroing(spark, d):
    c = L.lookback_candidates(t3(spark, d), FIXTURE_WINDOWS)
    return c.select("session_id", "channel_group", "event_timestamp", *L.ZEROED)


def _chains_out(df: DataFrame) -> DataFrame:
    return df.select(*[_path(c) if c in ("chain", "concat_chain") else F.col(c) for c in df.columns])


def q_chain_merge(spark, d):
    return _chains_out(CH.chain_merge(stage(raw_chains(spark, d), "raw-chains"), CHAIN_CFG.merge_gap_days))


def q_chain_concatenation(spark, d):
    return _chains_out(CH.chain_concatenation(stage(raw_chains(spark, d), "raw-chains"), CHAIN_CFG.concat_within_days))


def q_chain_measures(spark, d):
    return _chains_out(chains_final(spark, d))


def q_model_paths(spark, d):
    return _round(paths(spark, d).drop("path").select(_path("chain"), "nr_chains", "total_revenue"), 6, ["total_revenue"])


def q_touch_positions(spark, d):
    return ST.touch_positions(chains_final(spark, d))


STATS_RATIOS = ["mean_chain_len", "assisted_per_last_touch", "first_per_last_touch"]


def q_channel_stats(spark, d):
    return _round(U.stats_of(measures(spark, d)), 6, STATS_RATIOS)


PERIMETER_MEANS = [f"{m}{k}_{c}" for m in ("", "multi_tp_") for k in ("mean", "median") for c in ("conversions_value", "chain_len")]


def q_perimeter_recap(spark, d):
    return _round(ST.perimeter_recap(units(spark, d)[0], CHAIN_CFG.run_date), 6, PERIMETER_MEANS)


SUMMARY_MEANS = ["avg_chain_len", "avg_merged_chain_len", "avg_final_chain_len", "merged_pct", "mono_touch_pct"]


def q_chain_summary(spark, d):
    rows = stage(t4(spark, d), "t4")
    heads, steps = U.raw_units(stage(CH.numbered_sessions(rows), "sessions"))
    heads = stage(heads, "heads")
    size = F.col("own_len").alias("chain_len")
    merged = stage(U.merged_units(heads, steps, CHAIN_CFG.merge_gap_days)[0], "merged")
    final = stage(U.with_prefixes(heads, CHAIN_CFG.window_days), "conversions")
    return _round(ST.chain_summary(rows, heads.select("*", size), merged.select("*", size), final), 6, SUMMARY_MEANS)


def q_chain_touches(spark, d):
    """W1 + W5: every touch of every chain as a row."""
    sessions = stage(CH.numbered_sessions(t4(spark, d)), "sessions")
    return U.chain_touches(sessions, U.chain_heads(sessions))


def _heur(spark, d, prefix):
    h = U.heuristics_of(measures(spark, d))
    cols = [f"{prefix}_conversions", f"{prefix}_value"]
    return _round(h.select("channel_name", *cols), 6, cols)


def q_markov_transitions(spark, d):
    return _round(transitions(spark, d), 6, ["transition_value"])


def q_markov_probabilities(spark, d):
    return _round(M.markov_probabilities(transitions(spark, d)), 6, ["probability"])


MARKOV_COLS = ["removal_effect_volume", "removal_effect_value", "markov_volume", "markov_value"]


def q_markov_removal_effects(spark, d):
    eff = M.markov_removal_effects(transitions(spark, d))
    return _round(eff.select("channel_name", "removal_effect_volume", "removal_effect_value"), 4, MARKOV_COLS)


def q_attr_markov(spark, d):
    return _round(M.markov_removal_effects(transitions(spark, d)).select("channel_name", "markov_volume", "markov_value"), 4, MARKOV_COLS)


HEUR_COLS = ["first_touch_conversions", "first_touch_value", "last_touch_conversions", "last_touch_value",
             "linear_touch_conversions", "linear_touch_value"]


def q_attribution_results(spark, d):
    conversions, steps = units(spark, d)
    m = stage(U.channel_measures(conversions, steps, CHAIN_CFG.window_days), "measures")  # read by statistics and heuristics
    effects = M.markov_removal_effects(U.transitions_of(conversions, steps))
    out = M.attribution_results(U.stats_of(m), effects.select("channel_name", "markov_volume", "markov_value"), U.heuristics_of(m), CHAIN_CFG.run_date)
    return _round(_round(out, 4, ["markov_volume", "markov_value"]), 6, HEUR_COLS + STATS_RATIOS)


def q_check_chain_counts(spark, d):
    rows = stage(t4(spark, d), "t4")
    return Q.check_chain_counts(rows, CH.conversion_chains(rows))


def q_check_merge_unique(spark, d):
    return Q.check_merge_unique(CH.chain_merge(stage(raw_chains(spark, d), "raw-chains"), CHAIN_CFG.merge_gap_days))


def q_check_concat_unique(spark, d):
    return Q.check_concat_unique(CH.chain_concatenation(stage(raw_chains(spark, d), "raw-chains"), CHAIN_CFG.concat_within_days))


# --- checks over rows that break them: the given rows, broken by a rule that SQL can follow

def q_null_channel_planted(spark, d):
    """Q1 where SMS sessions lost their channel."""
    return Q.check_null_channel(t4(spark, d).withColumn("channel_group", F.when(F.col("channel_group") != "SMS", F.col("channel_group"))))


def q_session_dates_planted(spark, d):
    """Q2 where the last event of Email touchpoints is a day late."""
    late = F.when(F.col("channel_group") == "Email", minus_days("last_event_timestamp", -1)).otherwise(F.col("last_event_timestamp"))
    return Q.check_session_dates(t4(spark, d).withColumn("last_event_timestamp", late))


def _by_day(chains: DataFrame) -> DataFrame:
    """Chains whose conversion id is their purchase day alone."""
    return chains.withColumn("conversion_id", F.col("purchase_date").cast("string"))


def q_merge_unique_planted(spark, d):
    """Q5 where ids are days, so merged chains of several customers share them."""
    heads, steps = U.raw_units(stage(CH.numbered_sessions(t4(spark, d)), "sessions"))
    return Q.check_merge_unique(_by_day(U.merged_units(heads, steps, CHAIN_CFG.merge_gap_days)[0]))


def q_concat_unique_planted(spark, d):
    """Q6 where ids are days."""
    return Q.check_concat_unique(_by_day(units(spark, d)[0]))


def q_weekly_media(spark, d):
    w = weekly(spark, d)
    return _round(w, 2, [c for c in w.columns if c.endswith(("_inv", "_num"))])


def q_rolling_year(spark, d):
    w = MD.with_rolling_year(weekly(spark, d), FIXTURE_MEDIA)
    return _round(w.select("week_end_date", "year_rolling", "year_nr", "li_tot_num", "li_tot_inv"), 2,
                  ["li_tot_num", "li_tot_inv"])


RECAP_RATIOS = ["number_perc", "cost_perc", "cost_per_number", "cost_per_number_yoy"]


def q_channel_recap(spark, d):
    return _round(_round(recap(spark, d), 2, ["number", "cost"]), 6, RECAP_RATIOS)


def q_media_recap_off_tv(spark, d):
    """Entry 4 for a channel with two units and an underscore in its prefix, sorted as the report is."""
    out = MD.media_recap(weekly(spark, d), FIXTURE_MEDIA)["Off TV"]
    return _round(_round(out, 2, ["cost"]), 6, [c for c in out.columns if c.endswith("_perc") or c.startswith("cost_per")])


def _recap_cols(*cols):
    def q(spark, d):
        return _round(recap(spark, d).select("year_rolling", "split", *cols), 6, list(cols))
    return q


def queries():
    return {
        "ga4_scan": q_ga4_scan,
        "normalise_columns": q_normalise_columns,
        "event_param_lookup": q_event_param_lookup,
        "base_events": lambda s, d: base(s, d),
        "session_key": _base_cols("session_id"),
        "engaged_flag": _base_cols("is_engaged"),
        "country_cleanup": _base_cols("country_web"),
        "source_medium_normalise": _base_cols("source", "medium"),
        "campaign_name": q_campaign_name,
        "first_touch_defaults": _base_cols("first_source", "first_medium", "first_campaign_name"),
        "session_rollup": lambda s, d: S.session_rollup(groups(s, d)),
        "session_touchpoints": lambda s, d: S.session_touchpoints(groups(s, d)),
        "session_fallback_origin": lambda s, d: S.session_fallback_origin(groups(s, d)),
        "session_origins": lambda s, d: S.session_origins(groups(s, d)),
        "channel_classification": q_channel_classification,
        "session_channels": q_session_channels,
        "attribution_events": t3,
        "calendar_anchors": q_calendar_anchors,
        "conversions": lambda s, d: L.conversions(t3(s, d), FIXTURE_WINDOWS),
        "lookback_candidates": lambda s, d: L.lookback_candidates(t3(s, d), FIXTURE_WINDOWS),
        "period_zeroing": q_period_zeroing,
        "last_country": q_last_country,
        "chains_base": t4,
        "conversion_chains": lambda s, d: _chains_out(raw_chains(s, d)),
        "chain_touches": q_chain_touches,
        "chain_merge": q_chain_merge,
        "chain_concatenation": q_chain_concatenation,
        "chain_measures": q_chain_measures,
        "model_paths": q_model_paths,
        "touch_positions": q_touch_positions,
        "channel_stats": q_channel_stats,
        "perimeter_recap": q_perimeter_recap,
        "chain_summary": q_chain_summary,
        "attr_first_touch": partial(_heur, prefix="first_touch"),
        "attr_last_touch": partial(_heur, prefix="last_touch"),
        "attr_linear_touch": partial(_heur, prefix="linear_touch"),
        "markov_transitions": q_markov_transitions,
        "markov_probabilities": q_markov_probabilities,
        "markov_removal_effects": q_markov_removal_effects,
        "attr_markov": q_attr_markov,
        "attribution_results": q_attribution_results,
        "check_null_channel": lambda s, d: Q.check_null_channel(t4(s, d)),
        "check_session_dates": lambda s, d: Q.check_session_dates(t4(s, d)),
        "check_session_flags": lambda s, d: Q.check_session_flags(t4(s, d)),
        "check_chain_counts": q_check_chain_counts,
        "check_merge_unique": q_check_merge_unique,
        "check_concat_unique": q_check_concat_unique,
        "check_null_channel_planted": q_null_channel_planted,
        "check_session_dates_planted": q_session_dates_planted,
        "check_merge_unique_planted": q_merge_unique_planted,
        "check_concat_unique_planted": q_concat_unique_planted,
        "weekly_media": q_weekly_media,
        "rolling_year": q_rolling_year,
        "channel_recap": q_channel_recap,
        "media_recap_off_tv": q_media_recap_off_tv,
        "recap_cost_per_unit": _recap_cols("cost_per_number"),
        "recap_yoy": _recap_cols("cost_per_number_yoy"),
        "recap_share": _recap_cols("number_perc", "cost_perc"),
    }
