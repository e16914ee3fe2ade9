from tests.conftest import SF_ORACLE
from tests.llm import edge
from touchpath.llm import decontamination as D

ITEM = "A train leaves Paris at 60 km per hour and meets Alice after 5 hours near the old bridge of London, while 5 birds rest."


def leaks(text, items=((7, ITEM),)):
    return [i for i, _ in D.Benchmark(list(items)).leaks(text)]


def test_verbatim_and_reparameterised():
    assert leaks(f"Before it. {ITEM} And after.") == [7]
    assert leaks("x " + ITEM.replace("60", "85").replace("5", "9").replace("Paris", "Rome").replace("Alice", "Bob").replace("London", "Bern")) == [7]
    assert leaks(ITEM.upper().lower()) == [7]  # names in lower case still leave enough windows


def test_replaced_names_at_sentence_and_line_starts():
    item = "Alice has 5 apples. Tom gives her 3 more apples. Alice buys 7. How many does Alice have"
    for alice, tom in (("Clara", "Ben"), ("Élodie", "Ömer"), ("CLARA", "BEN"), ("Ñusta", "Ťomáš")):
        copy = item.replace("Alice", alice).replace("Tom", tom)
        for a, b in ((item, copy), (copy, item)):
            assert leaks(b.replace("5", "8").replace("3", "4"), [(1, a)]) == [1]
            assert leaks("Exercise:\n" + b.replace(". ", ".\n"), [(1, a)]) == [1]
    assert leaks("Clara has 5 apples. Ben gives her 3 more apples. Dora buys 7. How many does Eric have. ", [(1, item * 2)]) == []
    assert leaks("A dog. Runs. Over. It. A cat. Sleeps. Under. It.", [(1, "A man. Walks. Beside. It. A boy. Stands. Behind. It.")]) == []


def test_values_of_other_lengths_and_words_put_in():
    item = ("a truck drives from Boston at 40 km per hour and brings 1,000 boxes to the harbour of Boston where workers unload "
            "every box by hand before it returns empty to Boston in 5 hours by the same road")
    for copy in (item.replace("Boston", "New York"), item.replace("40 km", "40km").replace("1,000", "1 000").replace("Boston", "Rio"),
                 item.replace("harbour", "big harbour"), item.replace("drives", "now drives").replace("where", "where the"),
                 item.replace("boxes ", "").replace("returns", "soon returns")):
        assert leaks(copy, [(1, item)]) == [1] and leaks(item, [(1, copy)]) == [1]
    few = " ".join(f"alpha{i}" for i in range(20))
    assert leaks(few.replace("alpha10", "very alpha10"), [(1, few)]) == [1]
    names = item.replace("Boston", "New York").replace("40 km", "70 km").replace("5 hours", "9h")
    assert leaks(names, [(1, item)]) == [1]


def test_a_long_equal_run_counts_whatever_its_share():
    words = [f"beta{i}" for i in range(59)]
    for n, want in ((20, [1]), (13, [1]), (12, [])):
        assert leaks("x y " + " ".join(words[30:30 + n]) + " z", [(1, " ".join(words))]) == want
    numbers = " ".join(map(str, range(40)))
    assert leaks(" ".join(numbers.split()[:15]), [(1, f"{numbers} and {' '.join(words)}")]) == []


def test_inconsistent_slots_are_no_leak():
    item = "Take 3 apples then add 4 pears then add 3 plums then add 4 nuts then add 3 figs then add 4 dates"
    assert leaks(item.replace("3", "8").replace("4", "6"), [(1, item)]) == [1]
    mixed = "Take 1 apples then add 2 pears then add 5 plums then add 6 nuts then add 7 figs then add 8 dates"
    assert leaks(mixed, [(1, item)]) == []


def test_clean_and_partial_texts():
    assert leaks("a train leaves the station and meets nobody at all near some other bridge of this town") == []
    assert leaks(" ".join(ITEM.split()[:11])) == []
    assert leaks("") == [] and leaks("x", [(1, ""), (2, "  ")]) == []


def test_short_equal_and_null_items(spark):
    items = [(1, "what is love"), (2, "what is love"), (3, None), (None, "null id words here"), (4, "1 2 3 4 5 6 7 8 9")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, share string")
    docs = edge.plain(spark, ["tell me what is love now", "nothing", None, "has null id words here", "1 2 3 4 5 6 7 8 9", "tell me what is love now"])
    for chunk in (1_000_000, 4):
        got = {r.doc_id: r.item_ids for r in D.with_leaks(docs, bench, chunk_windows=chunk).collect()}
        assert {k: v for k, v in got.items() if v} == {0: [1, 2], 3: [None], 4: [4], 5: [1, 2]}


def test_given_tables(spark):
    docs, bench = (spark.read.parquet(f"{SF_ORACLE}/{t}.parquet") for t in ("documents", "benchmark"))
    rows, items = docs.select("doc_id", "text").collect(), [r.text for r in bench.collect()]
    want = {r.doc_id for r in rows if any(t in r.text for t in items)}
    got = {r.doc_id for r in D.with_leaks(docs, bench).where("size(item_ids) > 0").collect()}
    assert want and got == want


def test_edges(spark):
    bench = spark.createDataFrame([(1, edge.SENTENCE)], "item_id long, text string")
    df = edge.documents(spark)
    out = D.without_leaks(df, bench)
    assert out.columns == df.columns
    assert out.count() == sum(edge.SENTENCE not in (r[1] or "") for r in edge.rows())
    assert D.with_leaks(edge.documents(spark, []), bench).count() == 0
    assert D.without_leaks(df, bench.limit(0)).count() == len(edge.rows())
