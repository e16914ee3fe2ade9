import corpus_pipeline
from tests.conftest import SF_ORACLE
from tests.llm import edge
from tests.llm.test_mixing import brute_targets
from tests.llm.test_quality_rules import brute as brute_measures
from tests.llm.test_secret_scan import brute as brute_secrets
from tests.llm.test_simhash_dedup import brute_components, brute_fingerprint
from touchpath.llm import queries, quality_rules
from touchpath.llm import secret_scan as S


def test_stages_and_registry():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "source_mixing"]
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{i}" for i in range(1, 14)]


def test_run_against_brute_force(spark):
    docs = queries.table(spark, SF_ORACLE, "documents")
    measured = quality_rules.with_measures(docs, keep=["doc_id", "lang"])
    cutoffs = quality_rules.select_cutoffs(measured, queries.table(spark, SF_ORACLE, "labels"))
    items = [r.text for r in queries.table(spark, SF_ORACLE, "benchmark").collect()]
    kept = []
    for r in docs.collect():
        rules = cutoffs.get(r.lang if r.lang in quality_rules.STRATA else "other", {})
        values = dict(zip(quality_rules.RULES, quality_rules.measure(r.text)[6:]))
        if not brute_measures(r.text)[5] and not any(values[k] > c for k, c in rules.items()):
            kept.append(r)
    groups = brute_components([(r.doc_id, brute_fingerprint(r.text)) for r in kept])
    kept = [r for r in kept if groups[brute_fingerprint(r.text)] == r.doc_id]
    kept = [r for r in kept if not any(t in r.text for t in items)]
    size, source = {}, {}
    for r in kept:
        text = S.redact(r.text, sorted(brute_secrets(r.text)))
        size[r.doc_id] = len(text.encode().split())
        source[r.source] = source.get(r.source, 0) + size[r.doc_id]
    want = brute_targets(source)
    out = corpus_pipeline.run(spark, SF_ORACLE).collect()
    assert {r.doc_id: r.size for r in out} == size and len(out) == len(size)
    by = {r.doc_id: r.source for r in kept}
    taken = {}
    for r in out:
        s = by[r.doc_id]
        assert r.source_size == source[s] and abs(r.target - want[s]) < 1e-6 * want[s] and r.taken <= 2 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 1.5 for s in taken)


def test_stages_on_edge_rows(spark):
    for data in (None, []):
        docs = edge.documents(spark, data)
        for name, function in corpus_pipeline.STAGES:
            out = function(spark, docs, SF_ORACLE)
            out.collect()
            if name != "source_mixing":
                assert out.columns == docs.columns
                docs = out
