import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_ORACLE
from tests.llm import edge
from touchpath.llm import queries, toxicity as X

CALM = "the river runs past old houses and green hills where people walk their dogs in quiet weather under grey clouds".split()


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def made(n=900, seed=1):
    """(doc_id, text, toxic): toxic texts use an invented insult a few times; some calm ones quote it once."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        toxic = int(i % 5 == 0)
        words = [r.choice(CALM) + r.choice(["", "a", "on"]) for _ in range(r.randint(30, 90))]
        for _ in range(r.randint(3, 6) if toxic else int(i % 11 == 1)):
            words.insert(r.randrange(len(words)), "grobnak" + r.choice(["", "ed", "ish"]))
        out.append((i, " ".join(words), toxic))
    return out


@pytest.fixture(scope="module")
def trained(spark):
    rows = made()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    return rows, docs, labels, X.train(docs, labels)


def test_learns_the_stem_and_tells_held_out_texts(trained):
    rows, docs, _, model = trained
    assert any("grobnak".startswith(s) or s.startswith("grobnak") for s in model.lexicon)
    score = {r.doc_id: r.score for r in X.score_texts(docs, model).collect()}
    out = [(y, score[i] >= 0.5) for i, _, y in rows if held(i)]
    assert len(out) > 100 and sum(y == p for y, p in out) / len(out) > 0.95
    assert all(0 <= s <= 1 for s in score.values())


def test_held_out_labels_change_nothing(spark, trained):
    rows, docs, _, model = trained
    flipped = spark.createDataFrame([(i, 1 - y if held(i) else y) for i, _, y in rows], "doc_id long, toxic int")
    again = X.train(docs, flipped)
    assert again.lexicon == model.lexicon and np.array_equal(again.chances, model.chances) and np.array_equal(again.log_odds, model.log_odds)


def test_repeated_rows_and_labels_train_once(spark, trained):
    _, docs, labels, model = trained
    again = X.train(docs.unionByName(docs).repartition(2), labels.unionByName(labels))
    assert again.lexicon == model.lexicon and np.array_equal(again.chances, model.chances)


def test_bounded_sample(spark, trained):
    _, docs, labels, _ = trained
    assert 0 < X.training_texts(docs, labels, "text", "toxic", 200).count() <= 200


def test_one_hot_id_stays_bounded(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert X.training_texts(docs, labels, "text", "toxic", 50).count() <= 50


def test_isotonic_is_the_least_squares_fit():
    r = np.random.default_rng(3)
    z = np.sort(r.normal(size=60))
    y = (r.random(60) < 1 / (1 + np.exp(-2 * z))).astype(float)
    points, chances = X.isotonic(z, y)
    assert (np.diff(points) > 0).all() and (np.diff(chances) >= 0).all()
    # brute force: the largest lower mean of every start, min-max formula
    want = [max(min(y[a:b].mean() for b in range(i + 1, 61)) for a in range(i + 1)) for i in range(60)]
    blocks = sorted({round(w, 9) for w in want})
    assert len(points) == len(blocks)


def test_trees_fit_a_rule_that_needs_two_features():
    r = np.random.default_rng(5)
    x = r.random((800, 3))
    y = ((x[:, 0] > 0.6) & (x[:, 1] < 0.5)).astype(float)
    start, trees = X.boost(x, y)
    z = X.Model(frozenset(), start, trees, np.zeros(1), np.zeros(1)).raw(x)
    assert ((z > 0) == (y > 0)).mean() > 0.97
    node = trees[0]
    assert z[0] == pytest.approx(start + sum(walk(t, x[0]) for t in trees)) and node[0][0] in (0, 1)


def walk(tree, row):
    at = 0
    while tree[0][at] >= 0:
        at = tree[2][at] if row[tree[0][at]] <= tree[1][at] else tree[3][at]
    return tree[1][at]


def features(text, stems=("grob",)):
    return dict(zip(X.FEATURES, X.measure(text, X.Stems(frozenset(stems)))))


def test_features():
    f = features("You IDIOT!! you are a st*pid 1diot and grobnaks grobnik")
    assert (f["abuse"], f["learned"], f["learned_kinds"], f["learned_most"], f["longest_run"]) == (2, 2, 1, 2, 2)
    assert f["disguised"] == 1 and f["near_you"] >= 2 and f["capital_words"] == pytest.approx(1 / 10)
    far = "you " + "calm " * 9 + "idiot"
    assert features(far)["near_you"] == 0 and features("idiot, you")["near_you"] == 1
    assert len(X.measure("", X.Stems(frozenset()))) == len(X.FEATURES) and not any(features("").values())


def test_no_labels_or_one_class(spark):
    docs = edge.documents(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in X.score_texts(docs, X.train(docs, none)).collect()} == {0.0}
    ones = spark.createDataFrame([(i, 1) for i in range(12)], "doc_id long, toxic int")
    assert {r.score for r in X.score_texts(docs, X.train(docs, ones)).collect()} == {1.0}


def test_edge_rows(spark, trained):
    model = trained[3]
    docs = edge.documents(spark)
    out = X.score_texts(docs, model, keep=["doc_id", "text"]).select("doc_id", "text", "score", X.held_out(F.col("doc_id")).alias("held_out")).collect()
    assert len(out) == len(edge.rows())
    by_text = {}
    for r in out:
        assert by_text.setdefault(r.text or "", r.score) == r.score
        assert r.held_out == (r.doc_id is None or held(r.doc_id))
    assert X.score_texts(edge.documents(spark, []), model).count() == 0


def test_query_on_held_out_documents(spark):
    toxic = {r.doc_id: r.toxic for r in queries.table(spark, SF_ORACLE, "labels").collect()}
    rows = queries.op11_toxicity(spark, SF_ORACLE).collect()
    assert rows[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"}
    out = [(toxic[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in toxic]
    assert all(r.held_out == held(r.doc_id) and r.predicted == (r.score >= 0.5) for r in rows)
    assert sum(y == p for y, p in out) / len(out) > 0.9
