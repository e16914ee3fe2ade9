import random
import re
from collections import Counter

import pytest

from tests.compare import compare, duck
from tests.llm import edge
from touchpath.llm import collocations as C
from touchpath.llm import sql


def brute(rows, min_count=10, top=2_000):
    """(lang, rank, phrase, a, l, r, n, score) from (text, lang) rows, phrase by phrase."""
    counts, total = {}, Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in (1, 2, 3):
                counts.setdefault(lang, Counter()).update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        kept = []
        for p, a in cand.items():
            longer = [b for q, b in cand.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= 50 * a for b in longer):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string").repartition(3)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def random_rows(seed, n=60):
    r = random.Random(seed)
    words = ["a", "B", "the", "é", "of", "x1", "Straße", "日本", " ", "zz"]
    return [("".join(r.choice(words) + r.choice([" ", " ", "  ", "\t", ". ", "\n", ","]) for _ in range(r.randint(0, 120))),
             r.choice(["en", "en", "de", None, "und"])) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_matches_brute_force(spark, seed):
    rows = random_rows(seed)
    assert found(C.collocations(docs(spark, rows))) == brute(rows)
    assert found(C.collocations(docs(spark, rows), top=5)) == brute(rows, top=5)


def test_spills_bursts_and_new_ids_change_nothing(spark, monkeypatch):
    rows = random_rows(7) + [(f"w{i % 400} v{i % 7} the", "en") for i in range(2_000)]
    whole = found(C.collocations(docs(spark, rows)))
    assert whole == brute(rows)
    assert found(C.collocations(docs(spark, rows), limit=50, max_ids=20)) == whole
    monkeypatch.setattr(C, "PARTITION", 100)  # many prefix partitions
    assert found(C.collocations(docs(spark, rows), limit=50, max_ids=20)) == whole


def counted(batches):
    out = Counter()
    for b in batches:
        for r in b.to_pylist():
            for phrase, n in zip(*(x.to_pylist() for x in C.unpack(r["run"]))):
                out[phrase] += n
    return out


def test_long_texts_are_cut_into_blocks_without_loss(monkeypatch):
    text = random_rows(3, 1)[0][0] * 40 + "end" * 30 + " a b"
    want = counted(_count([text.encode()] * 2 + [b"short one", text.encode()]))
    monkeypatch.setattr(C, "BLOCK", 64)
    monkeypatch.setattr(C, "BURST", 4)
    texts = [text.encode()] * 2 + [b"short one", text.encode()]
    assert counted(_count(texts)) == want
    assert counted(_count(texts, limit=30, max_ids=5)) == want


def _count(texts, limit=1_000_000, max_ids=100_000, partitions=3):
    c = C.Counter(limit, max_ids, partitions)
    yield from c.add("en", texts)
    yield from c.flush()


def test_a_phrase_always_goes_to_one_partition():
    texts = [t.encode() for t, _ in random_rows(5)]
    parts = {}
    for order in (texts, texts[::-1]):
        for b in _count(order, limit=40, max_ids=9, partitions=5):
            for r in b.to_pylist():
                for phrase in C.unpack(r["run"])[0].to_pylist():
                    assert parts.setdefault(phrase, r["part"]) == r["part"]
    assert len(set(parts.values())) == 5


def test_products_beyond_64_bits(spark):
    big = 9_000_000_000
    df = spark.createDataFrame([(big, big + 1, big * 2), (7, 7, 7)], "a long, l long, r long")
    got = [r[0] for r in df.select(C._floor_ratio(1_000_000, "a", "l", "r")).collect()]
    assert got == [1_000_000 * big * big // ((big + 1) * big * 2), 1_000_000]


def test_edge_rows(spark):
    want = brute([(r[1], r[2]) for r in edge.rows()])
    assert found(C.collocations(edge.documents(spark))) == want
    assert found(C.collocations(edge.documents(spark, []))) == []


def test_query_matches_its_sql(spark):
    from touchpath.llm import queries
    sf = "/root/testdata/sf0.001"
    problems, n = compare(queries.op12_collocations(spark, sf), duck(sf), sql.OP12)
    assert not problems and n > 0
