"""Chains as long rows: every sum over (concatenated) chains against the arrays themselves."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from touchpath.config import ChainConfig
from touchpath.operators import chains as CH
from touchpath.operators import models as M
from touchpath.operators import stats as ST
from touchpath.operators import units as U
from touchpath.plans.attribution import chain_units, final_chains
from touchpath.session import stage

T4 = ("session_id string, cookie_id string, channel_group string, event_timestamp timestamp_ntz, f_converted int, session_revenue_usd decimal(38,9), "
      "first_event_timestamp timestamp_ntz, last_event_timestamp timestamp_ntz")
CHANNELS = ["Direct", "Email", "Paid Search", "Display", "SMS"]


def random_t4(spark, seed, customers=6, sessions=60, days=35):
    """Sessions of a few touches, crowded on days and hours, some of them conversions, several on one day."""
    r = random.Random(seed)
    rows = []
    for c in range(customers):
        for s in range(sessions):
            start = dt.datetime(2024, 1, 1) + dt.timedelta(days=r.randrange(days), hours=r.choice([0, 9, 9, 9, 23]), minutes=r.choice([0, 0, 7, 40]))
            end = start + dt.timedelta(minutes=r.choice([0, 5, 90]))
            bought = int(r.random() < 0.3)
            for i, channel in enumerate(r.sample(CHANNELS, r.choice([1, 1, 2, 4]))):
                rows.append((f"c{c}.{s}", f"c{c}", channel, start + dt.timedelta(seconds=r.choice([0, i])), bought, r.choice([None, 10 * s, 3]), start, end))
    return stage(spark.createDataFrame([(*x[:5], None if x[5] is None else __import__("decimal").Decimal(x[5]), *x[6:]) for x in rows], T4).repartition(5), "t4")


def table(df):
    def plain(v):
        return round(float(v), 6) if isinstance(v, float) or type(v).__name__ == "Decimal" else v
    names = sorted(df.columns)
    return sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)


CONFIGS = [{}, {"concat_chains": False}, {"concat_input": "merged"}, {"concat_within_days": 1}, {"concat_within_days": 40, "merge_gap_days": 0}]


@pytest.mark.parametrize("seed,kw", [(i, kw) for i, kw in enumerate(CONFIGS)])
def test_sums_equal_those_of_the_arrays(spark, seed, kw):
    cfg = ChainConfig(run_date=dt.date(2024, 2, 15), **kw)
    t4 = random_t4(spark, seed)
    chains = stage(final_chains(stage(CH.conversion_chains(t4), "raw"), cfg), "chains")
    conversions, steps = chain_units(t4, cfg)
    key = ["customer_id", "conversion_id", "conversion_timestamp", "first_event", "purchase_date", "purchase_value", "chain_no"]
    assert table(conversions.select(*key, "chain_len")) == table(chains.select(*key, F.col("chain_len").cast("long").alias("chain_len")))
    measures = stage(U.channel_measures(conversions, steps, cfg.window_days), "measures")
    paths = M.chain_weights(chains)
    assert table(U.stats_of(measures)) == table(ST.channel_stats(chains))
    assert table(U.heuristics_of(measures)) == table(M.heuristic_attribution(paths))
    assert table(U.transitions_of(conversions, steps)) == table(M.markov_transitions(paths))
    assert table(ST.perimeter_recap(conversions, cfg.run_date)) == table(ST.perimeter_recap(chains, cfg.run_date))


def test_touches_are_the_chain_in_order(spark):
    t4 = random_t4(spark, 11)
    sessions = CH.numbered_sessions(t4)
    rows = U.chain_touches(sessions, U.chain_heads(sessions)).orderBy("customer_id", "chain_no", "position").collect()
    held = {}
    for r in rows:
        chain = held.setdefault((r.customer_id, r.chain_no), [])
        assert r.position == len(chain) + 1
        chain.append(r.channel_name)
    assert held == {(r.customer_id, r.chain_no): r.chain for r in CH.conversion_chains(t4).collect()}


def test_one_customer_with_very_many_touches(spark):
    """One chain of 10^5 touches: no row grows with it, and its rows lie in many tasks."""
    n = 100_000
    start = F.timestamp_add("SECOND", F.col("id") * 20, F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'"))
    t4 = spark.range(n).select(
        F.concat(F.lit("hot."), F.col("id")).alias("session_id"), F.lit("hot").alias("cookie_id"),
        F.element_at(F.array(*[F.lit(c) for c in CHANNELS]), (F.col("id") % 5 + 1).cast("int")).alias("channel_group"), start.alias("event_timestamp"),
        (F.col("id") == n - 1).cast("int").alias("f_converted"), F.lit(7).cast("decimal(38,9)").alias("session_revenue_usd"),
        start.alias("first_event_timestamp"), start.alias("last_event_timestamp"))
    conversions, steps = chain_units(t4, ChainConfig(run_date=dt.date(2024, 2, 15)))
    head = conversions.collect()
    assert len(head) == 1 and head[0].chain_len == n and (head[0].first_channel, head[0].last_channel) == ("Direct", "SMS")
    steps = steps.collect()
    assert sum(s.n for s in steps) == n and len(steps) == 6  # five steps of the cycle and the start
    sessions = CH.numbered_sessions(t4)
    per_task = sessions.groupBy(F.spark_partition_id()).agg(F.max(F.size("channels")).alias("row"), F.count("*").alias("rows")).collect()
    assert len(per_task) > 1 and all(r.row == 1 and r.rows < n for r in per_task)
    touches = U.chain_touches(stage(sessions, "s"), conversions.withColumn("touches_before", F.lit(0)))
    assert touches.where((F.col("position") - 1) % 5 != F.array_position(F.array(*[F.lit(c) for c in CHANNELS]), F.col("channel_name")) - 1).count() == 0


def plan(df):
    return df._jdf.queryExecution().toString()


def test_no_statistic_reads_a_concatenation(spark):
    from conftest import SF_SMALL
    from touchpath.plans import registry as R
    for key in ("channel_stats", "attr_linear_touch", "markov_transitions", "attr_markov", "attribution_results", "perimeter_recap", "chain_summary"):
        p = plan(R.queries()[key](spark, SF_SMALL))
        assert "concat_chain" not in p and "collect_list" not in p, key


def test_medians_take_few_shuffles(spark):
    from conftest import SF_SMALL
    from touchpath.plans import registry as R
    q = R.queries()["perimeter_recap"](spark, SF_SMALL)
    p = q._jdf.queryExecution().executedPlan().toString()
    # the limits stand in the plan twice and are shuffled once
    assert 0 < p.count("Exchange hashpartitioning") + p.count("Exchange SinglePartition") - 1 <= 8
