"""Hand fixtures H1-H18 (FIXTURES.md section 4)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import chains, ga4_rows, t4_rows, ts
from touchpath.config import EventsConfig, WindowConfig
from touchpath.operators import chains as CH
from touchpath.operators import checks as Q
from touchpath.operators import lookback as L
from touchpath.operators import media as MD
from touchpath.operators import models as M
from touchpath.operators import stats as ST
from touchpath.operators.channels import classify_channels
from touchpath.operators.events import base_events
from touchpath.operators.sessions import origin_groups, session_origins
from touchpath.sources.categories import source_category_lists, source_flags
from touchpath.sources.testdata import fixture_categories


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_h1_gap_merge(spark):
    c = chains(spark, [("u", f"c{d}", d, [f"x{d}"], 1, i) for i, d in enumerate([0, 3, 6, 10])])
    m = CH.chain_merge(c, 3).orderBy("rank").collect()
    assert [r["chain"] for r in m] == [["x0", "x3", "x6"], ["x10"]]
    assert [r["conversion_id"] for r in m] == ["c6", "c10"]
    assert m[0]["purchase_value"] == Decimal(3)
    assert m[0]["first_event"] == dt.date(2024, 1, 1) and m[0]["purchase_date"] == dt.date(2024, 1, 7)


def test_h2_concatenation_order(spark):
    c = chains(spark, [("u", "a", 0, ["a"], 1, 0), ("u", "b", 0, ["b"], 1, 1),
                       ("u", "c", 4, ["c"], 1, 2), ("u", "e", 11, ["e"], 1, 3)])
    out = by(CH.chain_concatenation(c, 10), "conversion_id")
    assert out["a"]["concat_chain"] == ["a"]
    assert out["b"]["concat_chain"] == ["b"]
    assert out["c"]["concat_chain"] == ["b", "a", "c"]
    assert out["e"]["concat_chain"] == ["c", "e"]


def test_h3_concatenation_boundary(spark):
    c = chains(spark, [("u", "p", 0, ["p"], 1, 0), ("u", "q", 10, ["q"], 1, 1),
                       ("v", "r", 0, ["r"], 1, 0), ("v", "s", 11, ["s"], 1, 1)])
    out = by(CH.chain_concatenation(c, 10), "conversion_id")
    assert out["q"]["concat_chain"] == ["p", "q"]
    assert out["s"]["concat_chain"] == ["s"]


def test_h4_lookback_boundary(spark):
    conv_ts = ts(20)
    lb = 10
    edge = conv_ts - dt.timedelta(days=lb)
    cand = t4_rows(spark, [
        ("s_edge", "u", "Direct", edge, 0, 0, edge, edge),
        ("s_after", "u", "Direct", edge, 0, 0, edge + dt.timedelta(microseconds=1), edge),
        ("s_equal", "u", "Direct", conv_ts, 0, 0, conv_ts, conv_ts),
        ("s_late", "u", "Direct", conv_ts, 0, 0, conv_ts + dt.timedelta(microseconds=1), conv_ts),
        ("s_other", "w", "Direct", conv_ts, 0, 0, conv_ts, conv_ts),
    ])
    convs = spark.createDataFrame([("u", conv_ts)], "cookie_id string, conversion_timestamp timestamp_ntz")
    kept = {r["session_id"] for r in L.in_lookback(cand.withColumn("country_web", F.lit(None).cast("string")), convs, lb).collect()}
    assert kept == {"s_after", "s_equal"}


def test_h5_unclosed_tail_dropped(spark):
    rows = t4_rows(spark, [
        ("s1", "u", "Direct", ts(0), 1, 10, ts(0), ts(0, 13)),
        ("s2", "u", "Email", ts(1), 0, 0, ts(1), ts(1, 13)),
    ])
    out = CH.conversion_chains(rows).collect()
    assert len(out) == 1 and out[0]["chain"] == ["Direct"]


def test_h6_close_on_last_row_of_session(spark):
    rows = t4_rows(spark, [
        ("s1", "u", "Email", ts(0, 12), 1, 10, ts(0, 12), ts(0, 14)),
        ("s1", "u", "Direct", ts(0, 13), 1, 10, ts(0, 12), ts(0, 14)),
        ("s2", "u", "SMS", ts(2, 12), 1, 5, ts(2, 12), ts(2, 13)),
    ])
    out = CH.conversion_chains(rows).orderBy("chain_no").collect()
    assert [r["chain"] for r in out] == [["Email", "Direct"], ["SMS"]]
    assert out[0]["conversion_id"] == "s1.20240101"
    assert out[0]["first_event"] == dt.date(2024, 1, 1)
    assert out[1]["purchase_value"] == Decimal(5)


def test_h7_mono_chain(spark):
    c = chains(spark, [("u", "m", 0, ["a"], 7, 0)])
    t = ST.touch_positions(c).collect()[0]
    assert (t["first_channel"], t["last_channel"], t["assist_channel"], t["f_mono_touch"]) == (0, 1, 0, 1)
    h = by(M.heuristic_attribution(ST.model_paths(c)), "channel_name")["a"]
    assert h["first_touch_conversions"] == 1.0 and h["first_touch_value"] == 7.0


def test_h8_repeated_channel(spark):
    c = chains(spark, [("u", "k", 0, ["a", "a", "b"], 9, 0)])
    s = by(ST.channel_stats(c), "channel_name")
    assert s["a"]["nr_appearances"] == 2 and s["a"]["nr_chains"] == 1
    assert s["a"]["nr_assisted_chains"] == 1 and s["a"]["assisted_chains_value"] == Decimal(9)
    assert s["b"]["nr_assisted_chains"] is None
    h = by(M.heuristic_attribution(ST.model_paths(c)), "channel_name")
    assert h["a"]["linear_touch_conversions"] == pytest.approx(2 / 3)


def _base(spark, rows, **cfg):
    return base_events(ga4_rows(spark, rows), EventsConfig(**cfg))


def test_h9_engaged_flag(spark):
    rows = [{"ts": 1, "params": []}, {"ts": 2, "params": [("session_engaged", "x", None)]},
            {"ts": 3, "params": [("session_engaged", "1", None)]}, {"ts": 4, "params": [("session_engaged", None, 1)]}]
    got = {r["event_timestamp"]: r["is_engaged"] for r in _base(spark, rows).collect()}
    assert got == {1: None, 2: 0, 3: 1, 4: 1}


def test_h10_duplicate_params(spark):
    rows = [{"params": [("ga_session_id", None, 11), ("ga_session_id", None, 22)]}]
    assert _base(spark, rows).first()["session_id"] == "u1_11"
    with pytest.raises(Exception):
        _base(spark, rows, strict_params=True).collect()


def test_h11_case_sensitive_categories(spark):
    rows = [{"ts": 1, "params": [("ga_session_id", None, 1)], "source": "IGShopping", "medium": "social"},
            {"ts": 2, "params": [("ga_session_id", None, 2)], "first_source": "IGShopping", "first_medium": "Social"}]
    b = _base(spark, rows)
    origins = session_origins(origin_groups(b))
    ch = {r["session_id"]: r["channel_group"] for r in classify_channels(origins, fixture_categories(spark)).collect()}
    assert ch == {"u1_1": "Organic Social", "u1_2": "Organic Shopping"}


def test_h12_gclid_imputation(spark):
    rows = [{"ts": 1, "source": "Google", "medium": "organic", "gclid": "g"},
            {"ts": 2, "source": "Google", "medium": "organic"}]
    got = {r["event_timestamp"]: (r["source"], r["medium"], r["campaign_name"]) for r in _base(spark, rows).collect()}
    assert got == {1: ("google", "cpc", "organic"), 2: ("google", "organic", "organic")}


def test_h13_event_name_filters(spark):
    rows = [{"ts": 1, "name": None}, {"ts": 2, "name": "iBQML"}, {"ts": 3, "name": "x_iBQML"},
            {"ts": 4, "name": "privacy_info.analytics_storage"}, {"ts": 5, "storage": "No"},
            {"ts": 6, "storage": "Yes"}, {"ts": 7, "date": "20221231"}]
    assert {r["event_timestamp"] for r in _base(spark, rows).collect()} == {2, 6}


def test_h14_midnight_crossing_reported(spark):
    cfg = WindowConfig(as_of=dt.date(2024, 2, 15), conversion_period=12, lookback_window=10)
    start = dt.datetime.combine(cfg.conversion_start, dt.time())
    t3 = spark.createDataFrame([
        ("s", "u", None, None, 1, start - dt.timedelta(minutes=5), "a", "b", "c", "a/b", "Direct", 1, 1, 1,
         Decimal(5), start - dt.timedelta(minutes=5), start + dt.timedelta(minutes=5)),
        ("s", "u", None, None, 1, start + dt.timedelta(minutes=1), "a", "b", "c", "a/b", "Email", 1, 1, 1,
         Decimal(5), start - dt.timedelta(minutes=5), start + dt.timedelta(minutes=5)),
    ], "session_id string, cookie_id string, is_engaged bigint, country_web string, f_tp int, "
       "event_timestamp timestamp_ntz, source string, medium string, campaign_name string, source_medium string, "
       "channel_group string, f_converted int, total_transactions bigint, total_item_quantity bigint, "
       "session_revenue_usd decimal(38,9), first_event_timestamp timestamp_ntz, last_event_timestamp timestamp_ntz")
    cand = L.lookback_candidates(t3, cfg)
    assert [r["session_id"] for r in Q.check_session_flags(cand).collect()] == ["s"]


def test_h15_equal_first_timestamps(spark):
    same = ts(0)
    rows = [
        ("sB", "u", "Email", ts(0, 12, 5), 0, 0, same, ts(0, 13)),
        ("sA", "u", "Direct", ts(0, 12, 1), 0, 0, same, ts(0, 13)),
        ("sA", "u", "SMS", ts(0, 12, 9), 1, 3, same, ts(0, 13)),
        ("sB", "u", "Audio", ts(0, 12, 7), 1, 4, same, ts(0, 13)),
    ]
    for parts in (1, 3):
        out = CH.conversion_chains(t4_rows(spark, rows).repartition(parts)).orderBy("chain_no").collect()
        assert [r["chain"] for r in out] == [["Direct", "SMS"], ["Email", "Audio"]]


def test_h16_chain_duration(spark):
    c = chains(spark, [("u", "d", 0, ["a"], 1, 0)]).withColumn("first_event", F.lit(dt.date(2024, 1, 31))) \
        .withColumn("purchase_date", F.lit(dt.date(2024, 3, 15)))
    r = CH.chain_measures(c).first()
    assert (r["chain_duration"], r["chain_duration_days"], r["chain_len"]) == (15, 44, 1)


def test_h17_zero_metric_cost_per_unit(spark):
    from touchpath.config import MediaChannel
    w = spark.createDataFrame([("year1", 1, 0.0, 10.0, 0.0, 10.0)],
                              "year_rolling string, year_nr int, m_tot_num double, m_tot_inv double, "
                              "m_x_num double, m_x_inv double")
    r = MD.channel_recap(w, MediaChannel("M", "m", ("tot",), ("num", "inv"))).first()
    assert r["cost_per_number"] is None and r["number_perc"] is None and r["cost_perc"] == 1.0


def test_h18_source_in_two_categories(spark):
    cats = spark.createDataFrame([("SOURCE_CATEGORY_SEARCH", "dual"), ("SOURCE_CATEGORY_SOCIAL", "dual")],
                                 "category string, sources string")
    f = source_flags(cats).collect()
    assert len(f) == 1 and f[0]["is_search"] and f[0]["is_social"] and not f[0]["is_video"]
    lists = by(source_category_lists(cats), "category")
    assert lists["SOURCE_CATEGORY_SEARCH"]["sources_list"] == ["dual"]


@pytest.mark.parametrize("lookback", [1, 2, 5, 30])
def test_lookback_semi_join_matches_brute_force(spark, lookback):
    import random
    rnd = random.Random(lookback)
    base = dt.datetime(2024, 1, 1)
    convs, cands = [], []
    for cookie in ("u1", "u2", "u3"):
        for _ in range(rnd.randint(0, 6)):
            convs.append((cookie, base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 40))))
        for i in range(60):
            f = base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 40))
            cands.append((f"{cookie}-{i}", cookie, "Direct", f, 0, 0, f, f))
    # exact boundary cases for the first conversion of u1
    if convs:
        cu, ct = convs[0]
        edge = ct - dt.timedelta(days=lookback)
        cands += [("edge", cu, "Direct", edge, 0, 0, edge, edge),
                  ("edge+1", cu, "Direct", edge, 0, 0, edge + dt.timedelta(microseconds=1), edge),
                  ("at", cu, "Direct", ct, 0, 0, ct, ct)]
    cand_df = t4_rows(spark, cands)
    conv_df = spark.createDataFrame(convs, "cookie_id string, conversion_timestamp timestamp_ntz")
    cand_df = cand_df.withColumn("country_web", F.when(F.hash("session_id") % 3 != 0, F.element_at(F.split("session_id", "-"), -1)))
    rows = L.in_lookback(cand_df, conv_df, lookback).collect()
    got = {r["session_id"] for r in rows}
    assert len(rows) == len(got)
    latest = {}
    for r in cand_df.collect():  # A6: over all candidates of the cookie
        if r["country_web"] is not None:
            latest[r["cookie_id"]] = max(latest.get(r["cookie_id"], (r["event_timestamp"], "")), (r["event_timestamp"], r["country_web"]))
    assert all(r["country"] == latest.get(r["cookie_id"], (0, None))[1] for r in rows)
    want = {s for s, u, _, _, _, _, f, _ in cands
            if any(cu == u and ct - dt.timedelta(days=lookback) < f <= ct for cu, ct in convs)}
    assert got == want
