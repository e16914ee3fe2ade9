"""Documented options: campaign source (D2), chain merge/concatenation variants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from touchpath.config import ChainConfig, EventsConfig, WindowConfig
from touchpath.plans import registry as R
from touchpath.plans.attribution import final_chains
from touchpath.plans.events_preparation import attribution_events
from touchpath.sources.testdata import fixture_categories


RUN = dt.date(2024, 2, 15)


def test_dates_have_no_default():
    for make in (ChainConfig, WindowConfig):
        with pytest.raises(TypeError):
            make()


def _channels_by_fixture_row(spark, campaign_from):
    """Channel of the touchpoint origin of each fixture traffic row n (sessions with one event)."""
    ga4 = R.ga4(spark, SF_SMALL)
    t3 = attribution_events(ga4, fixture_categories(spark), EventsConfig(campaign_from=campaign_from))
    return {(r["source"], r["medium"], r["campaign_name"]): r["channel_group"]
            for r in t3.where(F.col("f_tp") == 1).select("source", "medium", "campaign_name", "channel_group")
            .distinct().collect()}


def test_campaign_from_medium_default(spark):
    got = _channels_by_fixture_row(spark, "medium")
    assert got[("google", "cpc", "organic")] == "Paid Search"          # fixture row 1
    assert got[("ads", "cross-network", "cross-network")] == "Cross Network"  # row 3


def test_campaign_from_campaign_option(spark):
    got = _channels_by_fixture_row(spark, "campaign")
    assert got[("google", "cpc", "winter cross-network")] == "Cross Network"  # row 1
    assert got[("ads", "cross-network", "x")] == "Unassigned"               # row 3
    assert got[("partner", "shopping", "summer shop")] == "Organic Shopping"  # row 9


def test_invalid_options_rejected():
    with pytest.raises(ValueError):
        EventsConfig(campaign_from="name")
    with pytest.raises(ValueError):
        ChainConfig(RUN, concat_input="other")


@pytest.mark.parametrize("cfg", [ChainConfig(RUN, concat_chains=False), ChainConfig(RUN, concat_input="merged"), ChainConfig(RUN)])
def test_chain_variants_keep_value(spark, cfg):
    raw = R.raw_chains(spark, SF_SMALL)
    out = final_chains(raw, cfg)
    total = raw.agg(F.sum("purchase_value")).first()[0]
    if not cfg.concat_chains:
        assert out.count() == R.queries()["chain_merge"](spark, SF_SMALL).count()
        assert out.agg(F.sum("purchase_value")).first()[0] == total
    else:
        # concatenation keeps one row per conversion of its input (raw or merged)
        ids = {r[0] for r in out.select("conversion_id").collect()}
        assert len(ids) == out.count()
        assert {"chain_len", "chain_duration", "chain_duration_days"} <= set(out.columns)
