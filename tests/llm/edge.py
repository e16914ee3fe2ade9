"""Rows that every operator must survive: nulls, empties, long texts, ties, repeats, clashing extra columns."""

from __future__ import annotations

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept string, size string, fp string, spans string, item_ids string, "
          "n_words string, h string, rows string, component_id string, target string, count string, block string, share string, doc string, sub string")
EXTRA = ("x",) * 15

SENTENCE = "The quick brown fox of Oslo jumps over 12 lazy dogs while +1 (743) 555-3824 rings at 10.0.0.1 and a@b.co waits near the door"
LONG = " ".join(f"w{i % 977} v{i % 31}" for i in range(60_000))


def rows() -> list[tuple]:
    texts = [None, "", " \n\t ", "one", SENTENCE, SENTENCE, f"{SENTENCE}\n{SENTENCE}", LONG, "é😀 " * 40, "a " * 300, "token = abcdefgh12345678", "\n\n\n"]
    out = [(i, t, lang, source, len(t or "")) for i, (t, lang, source) in enumerate(zip(texts, ["en", None, "xx", "de"] * 3, ["s1", None, "s2", "s1"] * 3))]
    out += [out[4], out[4], (None, SENTENCE, "en", "s1", 3), (None, None, None, None, None)]
    return [(*r, *EXTRA) for r in out]


def documents(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)


def plain(spark, texts: list):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
