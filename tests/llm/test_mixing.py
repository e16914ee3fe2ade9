import random
import re

import pytest

from tests.conftest import SF_SMALL
from tests.llm import edge
from touchpath.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        left = total - sum(target.values())
        dealt = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if dealt[s] > most * sizes[s]}
        if not over:
            return target | dealt
        target |= {s: most * sizes[s] for s in over}
        open_ -= over
    return target


def check(rows, docs):
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.size) for r in rows) == sorted(
        (i if i is not None else -1, len(WORD.findall(t or ""))) for i, t, _ in docs)
    sizes = {}
    for _, t, s in docs:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    want, source = brute_targets(sizes), {}
    for i, t, s in docs:
        source.setdefault((i, len(WORD.findall(t or ""))), set()).add(s)
    taken = {}
    for r in rows:
        fits = [s for s in source[r.doc_id, r.size] if sizes[s] == r.source_size and abs(want[s] - r.target) < 1e-6 * max(1, want[s])]
        assert fits and 0 <= r.taken <= 2 * r.size
        taken[r.source_size, r.target] = taken.get((r.source_size, r.target), 0) + r.taken
    return taken


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    taken = check(mixing.mix_documents(docs).collect(), [(r.doc_id, r.text, r.source) for r in docs.collect()])
    for (_, target), words in taken.items():
        assert abs(words - target) <= 1.5


@pytest.mark.parametrize("fan", [5, 64])
def test_hot_source_many_levels(spark, fan):
    rng = random.Random(fan)
    rows = [(i, rng.choice(["hot"] * 6 + ["b", "c", None, "é"]), rng.choice([0, 1, 3, 50, 700])) for i in range(400)] + [(900, "é", 4)] * 30
    df = spark.createDataFrame(rows, "doc_id long, source string, size long").repartition(7)
    out = mixing.mix(df, fan=fan).collect()
    again = mixing.mix(df.repartition(3), fan=fan).collect()
    key = lambda r: (r.doc_id, r.size, r.source_size, r.taken)
    assert sorted(map(key, out)) == sorted(map(key, again))
    taken = check(out, [(i, "w " * n, s) for i, s, n in rows])
    for (size, target), words in taken.items():
        assert abs(words - target) <= 1
    whole = [r for r in out if r.size]
    assert sum(r.taken % r.size != 0 for r in whole) <= 5  # one row of each source at most is taken in part


@pytest.mark.parametrize("repeats", [65_536, 7])
@pytest.mark.parametrize("rows", [[(7, "s", 1)] * 1_000, [(7, "s", 3)] * 333 + [(None, "s", 5)] * 101, [(None, "s", 2)] * 64 + [(1, "t", 9)] * 3])
def test_repeated_rows_meet_the_target(spark, monkeypatch, rows, repeats):
    monkeypatch.setattr(mixing, "REPEATS", repeats)
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, size long").repartition(3)).collect()
    taken = check(out, [(i, "w " * n, s) for i, s, n in rows])
    for (_, target), words in taken.items():
        assert abs(words - target) <= 1
    assert len(out) == len(rows) and all(r.taken <= 2 * r.size for r in out)


def test_copies_are_unbiased(spark):
    rows = [(i, "s" if i % 2 else "t", 10) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    sums = {}
    for seed in range(3):
        for r in mixing.mix(df, weights=(1, 3), share=0.8, seed=seed).collect():
            sums[r.doc_id] = sums.get(r.doc_id, 0) + r.taken
    assert len(set(sums.values())) > 2  # the draw changes with the seed


def test_edges(spark):
    rows = [r[:5] for r in edge.rows()]
    out = mixing.mix_documents(edge.documents(spark)).collect()
    check(out, [(r[0], r[1], r[3]) for r in rows])
    assert mixing.mix_documents(edge.documents(spark, [])).collect() == []
    nameless = spark.createDataFrame([(None, "s" if i % 3 else None, i % 4) for i in range(60)], "doc_id long, source string, size long")
    assert nameless.count() == mixing.mix(nameless).count()  # null ids are units like others
    one = mixing.mix_documents(spark.createDataFrame([(1, None, None), (2, "", None)], "doc_id long, text string, source string")).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in one] == [(0, 0, 0.0, 0)] * 2


def test_native_plan(spark):
    plan = mixing.mix_documents(edge.documents(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
