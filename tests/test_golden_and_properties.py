"""Golden numbers (Markov worked example) and pipeline properties."""


import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from touchpath.operators import chains as CH
from touchpath.operators import models as M
from touchpath.operators import stats as ST
from touchpath.operators.quantiles import exact_medians
from touchpath.plans import registry as R


@pytest.fixture(scope="module")
def worked_paths(spark):
    return spark.createDataFrame([(["A", "B"], 2, 20.0), (["B"], 1, 5.0), (["A"], 1, 10.0)],
                                 "chain array<string>, nr_chains bigint, total_revenue double")


def test_markov_worked_example(worked_paths):
    eff = {r["channel_name"]: r for r in M.markov_removal_effects(M.markov_transitions(worked_paths)).collect()}
    assert eff["A"]["removal_effect_volume"] == pytest.approx(0.75)
    assert eff["B"]["removal_effect_volume"] == pytest.approx(0.75)
    assert eff["A"]["removal_effect_value"] == pytest.approx(0.761905, abs=1e-6)
    assert eff["B"]["removal_effect_value"] == pytest.approx(0.714286, abs=1e-6)
    assert eff["A"]["markov_volume"] == pytest.approx(2.0)
    assert eff["A"]["markov_value"] == pytest.approx(18.064516, abs=1e-6)
    assert eff["B"]["markov_value"] == pytest.approx(16.935484, abs=1e-6)


def test_transition_probabilities(worked_paths):
    p = {(r["from_state"], r["to_state"]): r["probability"]
         for r in M.markov_probabilities(M.markov_transitions(worked_paths)).collect()}
    assert p[("(start)", "A")] == pytest.approx(0.75)
    assert p[("A", "B")] == pytest.approx(2 / 3)
    assert p[("A", "(conversion)")] == pytest.approx(1 / 3)
    assert p[("B", "(conversion)")] == pytest.approx(1.0)


def test_heuristics_worked_example(worked_paths):
    h = {r["channel_name"]: r for r in M.heuristic_attribution(worked_paths).collect()}
    assert (h["A"]["first_touch_conversions"], h["A"]["first_touch_value"]) == (3.0, 30.0)
    assert (h["B"]["first_touch_conversions"], h["B"]["first_touch_value"]) == (1.0, 5.0)
    assert (h["A"]["last_touch_conversions"], h["A"]["last_touch_value"]) == (1.0, 10.0)
    assert (h["B"]["last_touch_conversions"], h["B"]["last_touch_value"]) == (3.0, 25.0)
    assert (h["A"]["linear_touch_conversions"], h["A"]["linear_touch_value"]) == (2.0, 20.0)
    assert (h["B"]["linear_touch_conversions"], h["B"]["linear_touch_value"]) == (2.0, 15.0)


@pytest.fixture(scope="module")
def final(spark):
    return R.chains_final(spark, SF_SMALL).persist()


def test_attribution_totals(final):
    paths = ST.model_paths(final)
    tot = paths.agg(F.sum("nr_chains").alias("n"), F.sum("total_revenue").alias("v")).first()
    h = M.heuristic_attribution(paths).agg(*[F.sum(c).alias(c) for c in M.heuristic_attribution(paths).columns[1:]]).first()
    mk = M.markov_attribution(paths).agg(F.sum("markov_volume").alias("mv"), F.sum("markov_value").alias("vv")).first()
    for model in ("first_touch", "last_touch", "linear_touch"):
        assert h[f"{model}_conversions"] == pytest.approx(tot["n"])
        assert h[f"{model}_value"] == pytest.approx(tot["v"])
    assert mk["mv"] == pytest.approx(tot["n"]) and mk["vv"] == pytest.approx(tot["v"])


def test_linear_equals_last_on_mono_paths(final):
    mono = ST.model_paths(final.where(F.size("chain") == 1))
    for r in M.heuristic_attribution(mono).collect():
        assert r["linear_touch_conversions"] == pytest.approx(r["last_touch_conversions"])


def test_merge_keeps_value_and_length(spark):
    raw = R.raw_chains(spark, SF_SMALL)
    merged = CH.chain_merge(raw, 3)
    a = raw.agg(F.sum("purchase_value"), F.sum(F.size("chain"))).first()
    b = merged.agg(F.sum("purchase_value"), F.sum(F.size("chain"))).first()
    assert tuple(a) == tuple(b)


def test_concatenation_keeps_ids(spark):
    raw = R.raw_chains(spark, SF_SMALL)
    cat = CH.chain_concatenation(raw, 10)
    assert {r[0] for r in raw.select("conversion_id").collect()} == {r[0] for r in cat.select("conversion_id").collect()}
    bad = cat.where(F.size("concat_chain") < F.size("chain")).count()
    assert bad == 0


def test_partition_count_independence(spark):
    a = sorted(map(tuple, R.t3(spark, SF_SMALL).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        b = sorted(map(tuple, R.t3(spark, SF_SMALL).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert a == b


def test_stagewise_t3_equals_single_pass(spark):
    """Roll-up, origins, classification and channel choice, each on its own, give T3."""
    from touchpath.operators import sessions as S
    from touchpath.operators.channels import classify_channels
    from touchpath.sources.testdata import fixture_categories
    g = S.origin_groups(R.base(spark, SF_SMALL))
    origins = classify_channels(S.session_origins(g), fixture_categories(spark))
    first = F.min_by(F.struct(*S.ORIGIN, "source_medium", "event_timestamp"), F.struct("event_timestamp", *S.ORIGIN))
    channels = origins.groupBy("session_id", "channel_group").agg(first.alias("o"), F.max("f_tp").alias("f_tp")).select("session_id", "channel_group", "f_tp", "o.*")
    stagewise = S.session_rollup(g).join(channels, "session_id").select(*S.T3_COLUMNS)
    assert sorted(map(tuple, stagewise.collect())) == sorted(map(tuple, R.t3(spark, SF_SMALL).collect()))


def test_exact_medians(spark):
    import statistics
    from decimal import Decimal
    groups = {1: [10.0 ** (i / 20 - 300) for i in range(12_000)], 2: [3.0], 3: [1.0, 1.0, 2.0, 9.0], 4: [7.0] * 500 + [8.0] * 500, 5: [None]}
    rows = [(t, v) for t, vs in groups.items() for v in vs]
    for margin in (0.0005, 0.4):
        got = dict(exact_medians(spark.createDataFrame(rows, "tag int, v double").repartition(5), margin).collect())
        assert got == {t: statistics.median(vs) for t, vs in groups.items() if vs != [None]}
    big = [Decimal(f"{10**20 + i}.000000001") for i in range(5)]  # ranks need more digits than a double has
    got = exact_medians(spark.createDataFrame([(0, v) for v in big], "tag int, v decimal(38,9)")).first()
    assert got.median == float(big[2])


def test_one_factorisation_equals_a_solve_per_removed_channel(spark):
    """A thousand states, some of which never convert: each channel's effect against a system without it."""
    import random

    import numpy as np
    r, n = random.Random(4), 1_000
    edges = {(f"c{i}", f"c{r.randrange(n)}"): r.randint(1, 9) for i in range(n) for _ in range(3)}
    edges |= {("(start)", f"c{r.randrange(n)}"): r.randint(1, 9) for _ in range(40)}
    edges |= {(f"c{i}", "(conversion)"): r.randint(1, 3) for i in range(0, n, 4)} | {("dead", "dead"): 2, ("c1", "dead"): 1}
    rows = [(a, b, k, 5.0 * k if b == "(conversion)" else 0.0) for (a, b), k in edges.items()]
    out = {x.channel_name: x for x in M.markov_removal_effects(
        spark.createDataFrame(rows, "from_state string, to_state string, nr_transitions bigint, transition_value double").repartition(4)).collect()}
    names = sorted({x[0] for x in rows})
    at = {s: i for i, s in enumerate(names)}
    total = {s: sum(k for a, _, k, _ in rows if a == s) for s in names}
    q, step = np.zeros((len(names), len(names))), np.zeros(len(names))
    for a, b, k, _ in rows:
        if b == "(conversion)":
            step[at[a]] += k / total[a]
        else:
            q[at[a], at[b]] += k / total[a]
    alive = [i for s, i in at.items() if s != "dead"]

    def start_converts(without=None):
        left = [i for i in alive if names[i] != without]
        return np.linalg.solve(np.eye(len(left)) - q[np.ix_(left, left)], step[left])[left.index(at["(start)"])]

    whole = start_converts()
    for name in ["c0", "c1", "c17", "c500", "c999"]:
        assert out[name].removal_effect_volume == pytest.approx(1 - start_converts(name) / whole, abs=1e-9)
        assert out[name].removal_effect_value == pytest.approx(out[name].removal_effect_volume, abs=1e-9)  # all conversions are worth the same
    assert out["dead"].removal_effect_volume == 0 and "(start)" not in out


def test_markov_with_many_states(spark):
    """No bound on states: a long cycle of labels, solved and split by removed channel."""
    n = 40
    rows = [([f"c{i}", f"c{(i * 7 + 1) % n}", f"c{(i + 1) % n}"], 1, 2.0) for i in range(n)]
    out = M.markov_attribution(spark.createDataFrame(rows, "chain array<string>, nr_chains bigint, total_revenue double")).collect()
    assert len(out) == n
    assert sum(r.markov_volume for r in out) == pytest.approx(n) and sum(r.markov_value for r in out) == pytest.approx(2.0 * n)
