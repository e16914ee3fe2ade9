import hashlib
import random

import pytest

from tests.conftest import SF_ORACLE
from tests.llm import edge
from touchpath.llm import substring_dedup as S


def words_of(text):
    return (text or "").encode().split()


def brute(rows, window=20):
    """doc_id -> (n_words, n_removed, kept_sha256), rows judged in id order."""
    seen, out = set(), {}
    for d, text in sorted(rows):
        words = words_of(text)
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i:i + window])
            if key in seen:
                gone[i:i + window] = [True] * window
            seen.add(key)
        kept = [w for w, g in zip(words, gone) if not g]
        out[d] = (len(words), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def check(df, window=20):
    rows = df.select("doc_id", "text").collect()
    want, out = brute([(r.doc_id, r.text) for r in rows], window), S.remove_repeats(df, window=window).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id]
        assert sum(b - a for a, b in r.removed) == r.n_removed


def generated(seed, letters, n=120):
    rng = random.Random(seed)
    base = [" ".join(rng.choice("abcdefgh"[:letters]) for _ in range(rng.randint(0, 110))) for _ in range(6)]
    out = []
    for i in range(n):
        words = rng.choice(base).split()
        for _ in range(rng.randint(0, 3)):
            if words:
                words[rng.randrange(len(words))] = rng.choice("xyzab")
        cut = rng.randint(0, len(words))
        out.append((i, " ".join(words[cut:] + words[:cut])))
    return out + [(999, None), (998, ""), (997, "a " * 60), (996, "q"), (995, "r " * 19), (994, "r " * 20)]


@pytest.mark.parametrize("letters,hot", [(1, 512), (3, 512), (3, 2), (8, 512), (8, 2)])
def test_against_brute_force(spark, monkeypatch, letters, hot):
    monkeypatch.setattr(S, "HOT", hot)
    check(spark.createDataFrame(generated(letters, letters), "doc_id long, text string").repartition(5))


def test_other_windows(spark):
    check(spark.createDataFrame(generated(5, 4, 60), "doc_id long, text string"), window=7)


def test_common_passage_with_different_surroundings(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT", 16)
    passage = " ".join(f"p{i}" for i in range(30))
    check(spark.createDataFrame([(i, f"l{i} m{i} {passage} r{i} s{i}") for i in range(200)], "doc_id long, text string"))


def test_given_documents(spark):
    check(spark.read.parquet(f"{SF_ORACLE}/documents.parquet"))


def test_edges(spark):
    rows = [r for r in edge.rows() if r[0] is not None]
    distinct = list({r[0]: r for r in rows}.values())
    check(edge.documents(spark, distinct))
    out = S.remove_repeats(edge.documents(spark)).collect()  # repeated rows and null ids
    assert len(out) == len(edge.rows())
    assert {(r.doc_id, r.n_removed) for r in out if r.doc_id == 4} == {(4, 24)}  # the null id's equal text comes first
    assert {(r.doc_id, r.n_removed) for r in out if r.doc_id is None} == {(None, 0)}
    assert S.remove_repeats(edge.documents(spark, [])).count() == 0


def test_automaton_matching_statistics():
    rng = random.Random(9)
    for _ in range(50):
        texts = [[rng.choice("abc") for _ in range(rng.randint(0, 25))] for _ in range(3)]
        probe = [rng.choice("abcd") for _ in range(30)]
        automaton = S.SuffixAutomaton()
        for t in texts:
            automaton.add(t)
        held = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        want = [max((n for n in range(1, e + 2) if tuple(probe[e + 1 - n:e + 1]) in held), default=0) for e in range(len(probe))]
        assert automaton.matches(probe) == want
