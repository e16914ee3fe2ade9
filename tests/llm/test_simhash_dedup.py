import random

import numpy as np
import xxhash

from tests.conftest import SF_ORACLE
from tests.llm import edge
from touchpath.llm import simhash_dedup as S


def brute_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    n = min(k, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + n]), 42) for i in range(len(words) - n + 1)]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def brute_components(pairs, bits=2):
    """pairs of (doc_id, fingerprint): fingerprint -> smallest doc_id."""
    points = sorted({f for _, f in pairs})
    a = np.array(points, dtype=np.uint64)
    up = list(range(len(points)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(a[i] ^ a) <= bits).tolist():
            up[max(root(i), root(j))] = min(root(i), root(j))
    first = {}
    for d, f in pairs:
        if d is not None:
            r = root(points.index(f)) if len(points) < 200 else root(int(np.searchsorted(a, np.uint64(f))))
            first[r] = min(first.get(r, d), d)
    return {f: first.get(root(i)) for i, f in enumerate(points)}


def clustered(n, seed, flips=3):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(12)] + [0]
    out = set()
    while len(out) < n:
        x = rng.choice(centres)
        for _ in range(rng.randint(0, flips)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return np.array(sorted(out), dtype=np.uint64)


def test_fingerprints():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice(["A", "b", "É", "İ", " ", "\t", "\x85", " ", "the ", "Cat ", "\n"]) for _ in range(rng.randint(0, 30)))
        assert S.fingerprint(text) & (2**64 - 1) == brute_fingerprint(text)


def test_shards_and_leaves_lose_no_pair():
    for seed in range(3):
        points = clustered(1_500, seed)
        i, j = np.nonzero(np.bitwise_count(points[:, None] ^ points[None, :]) <= 2)
        want = {(a, b) for a, b in zip(i.tolist(), j.tolist()) if a < b}
        found = {(min(a, b), max(a, b)) for x, y in S.linked_pairs(points, 2) for a, b in zip(x.tolist(), y.tolist())}
        assert found == want
        dealt = S.deal(points, S.grow(points[::3], 2, 40), 2)
        assert sorted(set(np.concatenate([w for _, w in dealt]).tolist())) == list(range(len(points)))
        met = {(min(a, b), max(a, b)) for _, w in dealt for x, y in S.linked_pairs(points[w], 2) for a, b in zip(w[x].tolist(), w[y].tolist())}
        assert met == want


def test_components_of_clustered_points(spark, monkeypatch):
    monkeypatch.setattr(S, "SHARD", 40)
    points = clustered(900, 7)
    pairs = [(1_000 - i, int(p)) for i, p in enumerate(points)]
    df = spark.createDataFrame([(d, int(np.uint64(p).view(np.int64))) for d, p in pairs], "first long, fp long")
    groups = {r.node & (2**64 - 1): r.root & (2**64 - 1) for r in S.components(S.links(df, 2)).collect()}
    want = brute_components(pairs)
    by_root = {}
    for _, f in pairs:
        by_root.setdefault(groups.get(f, f), set()).add(want[f])
    assert all(len(x) == 1 for x in by_root.values()) and len(by_root) == len(set(want.values()))


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(i, 500) for i in range(501, 540)], "a long, b long")
    got = {r.node: r.root for r in S.components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 500 for i in range(500, 540)}
    assert S.components(edges.limit(0)).count() == 0


def test_operator_against_brute_force(spark):
    for df in (edge.documents(spark), spark.read.parquet(f"{SF_ORACLE}/documents.parquet")):
        rows = df.select("doc_id", "text").collect()
        want = brute_components([(r.doc_id, brute_fingerprint(r.text)) for r in rows])
        out = S.near_duplicates(df)
        got = sorted((str(r.doc_id), r.f, r.component_id) for r in out.select("doc_id", S.hex_digits(out.fp).alias("f"), "component_id").collect())
        assert got == sorted((str(r.doc_id), f"{brute_fingerprint(r.text):016x}", want[brute_fingerprint(r.text)]) for r in rows)
    assert S.near_duplicates(edge.documents(spark, [])).count() == 0


def test_representatives(spark):
    df = edge.documents(spark)
    out = S.representatives(df)
    assert out.columns == df.columns
    want = brute_components([(r[0], brute_fingerprint(r[1])) for r in edge.rows()])
    assert sorted(r.doc_id for r in out.collect()) == sorted(set(want.values()))


def test_representatives_with_null_and_repeated_ids(spark):
    texts = [" ".join(f"{w}{i}" for i in range(60)) for w in ("ab", "cd", "ef", "gh", "ij")]
    rows = [(None, texts[0], "a"), (None, texts[1], "b"), (None, texts[1], "c"), (None, texts[2], "d"), (7, texts[2], "e"), (7, texts[3], "f"), (8, texts[3], "g"),
            (9, texts[4], "h"), (9, texts[4], "h"), (9, texts[4], None)]
    kept = {tuple(sorted(map(str, S.representatives(spark.createDataFrame(x, "doc_id long, text string, mark string").repartition(n)).collect())))
            for x, n in ((rows, 1), (rows[::-1], 3), (rows, 7))}
    assert len(kept) == 1
    out = S.representatives(spark.createDataFrame(rows, "doc_id long, text string, mark string")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in out) == sorted([(0, texts[0]), (0, texts[1]), (7, texts[2]), (7, texts[3]), (9, texts[4])])
