from fractions import Fraction
from math import comb

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_ORACLE
from tests.llm import edge
from touchpath.llm import quality_rules as Q

SPACES = " \t\n\x0b\x0c\r"


def words_of(text):
    for c in SPACES:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(text):
    words = words_of(text)
    covered, windows = set(), {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i:i + 3]), []).append(i)
    for starts in windows.values():
        if len(starts) > 1:
            covered |= {s + j for s in starts for j in range(3)}
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if words_of(line):
            duplicates += line in seen
            seen.add(line)
    n = len(words)
    return [n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), duplicates, len(covered), n < 50 or 100 * len(covered) > 50 * n]


parts = st.sampled_from(["a", "b", "c", " ", "  ", "\n", "\t", " ", "\x1c", "\x85", "#", "$$", "|", "é😀", "a b c ", "x\ny\n"])


@settings(max_examples=300, deadline=None)
@given(st.lists(parts, max_size=30).map("".join))
def test_measures(text):
    assert Q.measure(text)[:6] == brute(text)


def test_operator_on_edge_rows(spark):
    cutoffs = Q.select_cutoffs(Q.with_measures(edge.documents(spark), keep=["doc_id", "lang"]), spark.createDataFrame([], "doc_id long, quality int"))
    assert cutoffs == {}
    out = Q.with_measures(edge.documents(spark), keep=["doc_id", "lang", "text"]).withColumn("kept", Q.kept(cutoffs)).collect()
    assert len(out) == len(edge.rows())
    for r in out:
        assert [r[c] for c in (*Q.COUNTS, "base_failed")] == brute(r.text or "") and r.kept == (not r.base_failed)
    assert Q.with_measures(edge.documents(spark, [])).count() == 0
    stays = Q.filter_documents(edge.documents(spark), {"en": {"repeated_words": -1.0}})
    assert stays.columns == edge.documents(spark).columns
    assert sorted(r.doc_id for r in stays.collect()) == [r.doc_id for r in sorted(out, key=lambda r: r.doc_id or 0) if r.kept and r.lang != "en"]


def test_binomial_tail_is_exact():
    for k, n, p in ((0, 10, 0.01), (3, 50, 0.05), (7, 400, 0.02), (40, 400, 0.02), (9, 10, 0.5), (10, 10, 0.5), (0, 2_000, 0.03)):
        q = Fraction(p).limit_denominator(1000)
        assert abs(Q.binomial_tail(k, n, float(q)) - float(sum(comb(n, i) * q**i * (1 - q) ** (n - i) for i in range(k + 1)))) < 1e-9


def test_cutoffs_keep_their_promise(spark):
    rng = np.random.default_rng(3)
    n, rows = 12_000, []
    for i in range(n):
        good = i % 5 != 0
        value = float(rng.beta(1, 40) if good else rng.beta(6, 6))
        rows.append((i, "en" if i % 3 else "fr", False, *[value if r == "symbols_per_word" else 0.0 for r in Q.RULES], int(good)))
    df = spark.createDataFrame(rows, "doc_id long, lang string, base_failed boolean, " + ", ".join(f"{r} double" for r in Q.RULES) + ", quality int")
    labels = df.select("doc_id", "quality").union(df.select("doc_id", "quality").limit(10)).union(spark.createDataFrame([(None, 1), (5, None)], "doc_id long, quality int"))
    cutoffs = Q.select_cutoffs(df, labels)
    assert set(cutoffs) == {"en", "fr"} and all(set(c) == {"symbols_per_word"} for c in cutoffs.values())
    judged = df.withColumn("kept", Q.kept(cutoffs)).groupBy("lang", "quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    for r in judged:
        assert r.kept >= 0.95 if r.quality else r.kept <= 0.2


def made(spark, goods, bads, lang="en", again=1):
    """Labelled measures: good documents at 0, bad ones at 0.6 symbols a word; each row ``again`` times."""
    rows = [(i, lang, False, *[0.6 if i >= goods and r == "symbols_per_word" else 0.0 for r in Q.RULES], int(i < goods)) for i in range(goods + bads)]
    df = spark.createDataFrame(rows * again, "doc_id long, lang string, base_failed boolean, " + ", ".join(f"{r} double" for r in Q.RULES) + ", quality int")
    return df, df.select("doc_id", "quality")


def test_repeated_rows_and_labels_are_one_trial(spark):
    few = made(spark, 40, 20)
    assert Q.select_cutoffs(*few) == {}  # 20 good holdout documents can't rule out a rate of 3 %
    assert Q.select_cutoffs(*made(spark, 40, 20, again=60)) == {}
    assert Q.labelled_measures(*made(spark, 40, 20, again=7)).count() == 60
    assert Q.select_cutoffs(*made(spark, 700, 60)) == {"en": {"symbols_per_word": 0.5}}


def test_holm_and_fixed_order_over_strata(spark):
    """Many good labels in one language, few in another, almost none in a third: each by its own bound."""
    parts = [made(spark, n, 40, lang) for lang, n in (("en", 2_000), ("es", 330), ("fr", 60))]
    shift = [(m.withColumn("doc_id", F.col("doc_id") + i * 10_000), q.withColumn("doc_id", F.col("doc_id") + i * 10_000)) for i, (m, q) in enumerate(parts)]
    measured, labels = shift[0]
    for m, q in shift[1:]:
        measured, labels = measured.union(m), labels.union(q)
    assert set(Q.select_cutoffs(measured, labels)) == {"en", "es"}


def test_false_rejections_stop_the_chain(spark):
    """A rule that looks harmless on the tuning half but rejects good holdout documents isn't certified."""
    df, labels = made(spark, 900, 80)
    holdout = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    bad = df.withColumn("shouts_per_word", F.when((F.col("quality") == 0) | (holdout & (F.col("doc_id") % 10 == 0)), F.lit(2.5)).otherwise(F.lit(0.0)))
    assert Q.rule_chains(Q.labelled_measures(bad, labels).where("not holdout"), 0.01, 0.98)["en"][0][0] in ("shouts_per_word", "symbols_per_word")
    cut = Q.select_cutoffs(bad, labels)
    assert "shouts_per_word" not in cut.get("en", {})


def test_given_labels_keep_good_documents(spark):
    measured = Q.with_measures(spark.read.parquet(f"{SF_ORACLE}/documents.parquet"), keep=["doc_id", "lang"])
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet")
    cutoffs = Q.select_cutoffs(measured, labels, risk=0.5)
    rows = measured.withColumn("kept", Q.kept(cutoffs)).where("not base_failed").join(labels, "doc_id").collect()
    assert sum(r.kept for r in rows if r.quality) >= 0.9 * sum(1 for r in rows if r.quality)
