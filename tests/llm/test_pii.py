import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.llm import edge
from touchpath.llm import pii

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def valid(kind, value):
    d = re.sub("[^0-9]", "", value)
    if kind == 1:
        return all(int(p) <= 255 for p in value.split("."))
    if kind == 2:
        worth = [int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d))]
        return 12 <= len(d) <= 19 and sum(worth) % 10 == 0
    return kind == 0 or 9 <= len(d) <= 15


def brute(text):
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if valid(k, m.group()))


def show(spans):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(pii.labelled_table(spark))


def check(rows):
    for r in rows:
        base = brute(r.text or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(show(base).encode()).hexdigest()
        shown = [x for x in r.spans.split(",") if x]
        assert set(show(base).split(",")) - {""} <= set(shown) and len(shown) == len(base) + r.n_added
        starts = [(int(x.split(":")[1]), pii.KINDS.index(x.split(":")[0])) for x in shown]
        assert starts == sorted(starts)


parts = st.sampled_from(["a", "b.c", "@", "é😀", " ", ".", "-", "_", "+", "+1", "(", ")", "4111 1111 1111 1111", "4111-1111", "79927398713", "555", "12", "255", "256", "007",
                         "1.2.3.4", "10.0.0.", "a@b.co", "x" * 40, "9" * 25, "+49 30 1234567", "\n"])


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(parts, max_size=8).map("".join), min_size=40, max_size=40))
def test_base_against_brute_force(spark, model, texts):
    check(pii.find_pii(edge.plain(spark, texts), model, keep=["doc_id", "text"]).collect())


def test_edges_and_long_runs(spark, model):
    texts = ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "9" * 20_000, "1 " * 20_000, "a" * 50_000, "a." * 20_000 + "@x.y", "+1" + " (-." * 9_000, "1.2.3.4 " * 6_000, "0.0.0." + "0" * 99 + "255",
             "+1 5" + "(" * 3_000 + "@" * 3_000]
    check(pii.find_pii(edge.plain(spark, texts), model, keep=["doc_id", "text"]).collect())
    out = pii.find_pii(edge.documents(spark), model, keep=["doc_id", "text"]).collect()
    assert len(out) == len(edge.rows())
    check(out)
    assert pii.find_pii(edge.documents(spark, []), model).count() == 0


def test_trees_add_personal_data_and_leave_plain_numbers(spark, model):
    texts = ["call 555-123-4567 today", "write to jane.doe (at) host (dot) org please", "server 2001:0db8:85a3:0000:0000:8a2e:0370:7334 is up",
             "order 2023-10-11 then", "version 2.0.1 then", "stay at home. Now go", "the table has 100 200 300 then", "page 12-34 then"]
    out = {r.doc_id: r for r in pii.find_pii(edge.plain(spark, texts), model).collect()}
    assert [out[i].spans for i in range(3)] == ["phone:5:17", "email:9:37", "ip:7:46"]
    assert [out[i].n_added for i in range(3, 8)] == [0] * 5


def test_native_plan(spark, model):
    plan = pii.find_pii(edge.documents(spark), model)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_boosting_learns_and_matches_its_column(spark):
    import numpy as np
    from pyspark.sql import functions as F
    rng = np.random.default_rng(5)
    x = rng.random((300, 4))
    y = ((x[:, 0] > 0.5) & (x[:, 2] < 0.7)).astype(float)
    model = pii.boost(x[:200], y[:200])
    scores = np.array([model[0] + sum(pii._walk(t, r) for t in model[1]) for r in x])
    assert ((scores[200:] > 0) == y[200:]).mean() > 0.95
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x[:20])], "i int, f array<double>")
    got = dict(df.select("i", pii.as_column(model, F.col("f"))).collect())
    assert all(abs(got[i] - scores[i]) < 1e-9 for i in range(20))
