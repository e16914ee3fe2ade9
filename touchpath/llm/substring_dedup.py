"""Removal of repeated passages with suffix automata of reference shards.

A window of ``window`` consecutive words is removed if its words also start
earlier in the corpus (smaller doc_id, or earlier in the document). An automaton
over a whole corpus fits no executor, and sending every shard's automaton past
every document costs the square of the corpus, so text and references meet by
content instead:

1. Each window is represented by its smallest hashed ``ANCHOR``-word gram.
   Equal windows have equal anchors, and one anchor stands for a run of up to
   ``window - ANCHOR + 1`` windows: its context. About one word in nine is an
   anchor, and only hashes of anchors that occur twice go on.
2. Of the occurrences with one and the same context, all but the first are
   repeats as a whole; their words are not looked at again.
3. What remains are anchors with several different contexts: the edges of
   passages and the surroundings of edits. The contexts of an anchor, in corpus
   order, are a reference shard. A suffix automaton of the earlier contexts
   streams each next one for its matching statistics; where the match reaches
   the window length, the window is a repeat. Then the context joins the automaton.
4. An anchor with more than ``HOT`` different contexts is no shard for one task:
   its windows are grouped by their own hashes, with partial aggregation.

The texts cross the network twice, compressed: once for step 3 and once to meet
the removed ranges.

Defined results: null and empty texts have no words and nothing to remove;
documents shorter than a window keep all words; null ids come before all others;
rows that share an id and text are one document, each returned with its result;
rows that share an id with different texts are documents ordered by text hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchpath.llm.common import stage
from touchpath.llm.word_arrays import BASE, Powers, mix, range_hashes, utf8, word_hashes

ANCHOR = 5  # words of an anchor
HOT = 512  # different contexts of one anchor that an automaton takes
def _grams(code: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all ``n``-word grams."""
    out = code[:len(code) - n + 1].copy()
    for i in range(1, n):
        out = out * BASE + code[i:len(code) - n + 1 + i]
    return mix(out)


def anchors(code: np.ndarray, window: int, powers: Powers | None) -> tuple[np.ndarray, ...]:
    """Per anchor its hash; with ``powers`` also context hash, first window start, offset in it, number of further windows."""
    grams = _grams(code, ANCHOR)
    width = window - ANCHOR + 1
    least = np.lib.stride_tricks.sliding_window_view(grams, width).argmin(axis=1) + np.arange(len(grams) - width + 1)
    low = np.concatenate([[0], np.flatnonzero(np.diff(least)) + 1])
    at = least[low]
    if powers is None:
        return (grams[at],)
    more = np.diff(np.append(low, len(least))) - 1
    context = range_hashes(code, low, low + more + window, powers)
    context = mix(context + mix((at - low).astype(np.uint64) << np.uint64(16) | more.astype(np.uint64)))
    return grams[at], context, low, at - low, more


def _packed(keyed: DataFrame) -> DataFrame:
    """``keyed`` with its texts compressed, as they cross the network twice."""
    schema = T.StructType([*keyed.drop("text").schema.fields, T.StructField("packed", T.BinaryType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            packed = [pack(utf8(x)) if x else None for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(packed, pa.binary())], names=[*batch.schema.names[:-1], "packed"])

    return keyed.select(*keyed.drop("text").columns, "text").mapInArrow(run, schema)


def _unpack(packed: bytes | None) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed) if packed else b""


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64, copy=False).view(np.int64))


def anchor_hashes(keyed: DataFrame, window: int) -> DataFrame:
    """(h): the anchors of every text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            codes = (word_hashes(utf8(text), powers) for text in batch.column(0).to_pylist())
            parts = [anchors(code, window, None)[0] for code in codes if len(code) >= window]
            if parts:
                yield pa.RecordBatch.from_arrays([_signed(np.concatenate(parts))], names=["h"])

    return keyed.select("text").mapInArrow(run, "h long")


def anchor_rows(keyed: DataFrame, window: int) -> DataFrame:
    """(h, c, doc, sub, at): every anchor of every text; ``at`` packs first start, offset and further windows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            parts, counts = [], []
            for text in batch.column(2).to_pylist():
                code = word_hashes(utf8(text), powers)
                if len(code) < window:
                    counts.append(0)
                    continue
                h, c, low, offset, more = anchors(code, window, powers)
                parts.append((h, c, low << 16 | offset << 8 | more))
                counts.append(len(h))
            if not parts:
                continue
            rows = np.repeat(np.arange(len(counts)), counts)
            h, c, at = (np.concatenate(x) for x in zip(*parts))
            yield pa.RecordBatch.from_arrays([_signed(h), _signed(c), batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)),
                                              pa.array(at.astype(np.int64))], names=["h", "c", "doc", "sub", "at"])

    return keyed.select("doc", "sub", "text").mapInArrow(run, "h long, c long, doc long, sub long, at long")


class SuffixAutomaton:
    """Suffix automaton over words; separated texts are added one after another."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.last, self.texts = [-1], [0], 0, 0

    def _extend(self, word) -> None:
        nxt, link, length = self.next, self.link, self.length
        new = len(nxt)
        nxt.append({})
        length.append(length[self.last] + 1)
        link.append(0)
        p = self.last
        while p != -1 and word not in nxt[p]:
            nxt[p][word] = new
            p = link[p]
        if p != -1:
            q = nxt[p][word]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nxt[p].get(word) == q:
                    nxt[p][word] = clone
                    p = link[p]
                link[q] = link[new] = clone
        self.last = new

    def add(self, words: list) -> None:
        for word in words:
            self._extend(word)
        self.texts += 1
        self._extend(self.texts)  # a number is no word: nothing matches across it

    def matches(self, words: list) -> list[int]:
        """Matching statistics: for each word, the length of the longest match that ends there."""
        nxt, link, length, out = self.next, self.link, self.length, []
        state = size = 0
        for word in words:
            while state and word not in nxt[state]:
                state = link[state]
                size = length[state]
            if word in nxt[state]:
                state = nxt[state][word]
                size += 1
            out.append(size)
        return out


def _ranges(starts: list[int]) -> list[tuple[int, int]]:
    """Runs of consecutive window starts, as (first, last)."""
    out: list[list[int]] = []
    for s in starts:
        if out and out[-1][1] == s - 1:
            out[-1][1] = s
        else:
            out.append([s, s])
    return [tuple(r) for r in out]


def matched_ranges(shards: DataFrame, window: int) -> DataFrame:
    """(doc, sub, lo, hi): window starts that an earlier context of their anchor holds; ``shards`` has (h, doc, sub, at, words)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        anchor, automaton = None, None
        for batch in batches:
            out: list[tuple] = []
            for h, doc, sub, at, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
                words, low = text.split(" "), at >> 16
                if h != anchor:
                    anchor, automaton = h, SuffixAutomaton()
                    automaton.add(words)
                    continue
                sizes = automaton.matches(words)
                again = [i - window + 1 for i, size in enumerate(sizes) if size >= window]
                if len(again) < len(words) - window + 1:
                    automaton.add(words)
                out += [(doc, sub, low + a, low + b) for a, b in _ranges(again)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(4)], names=["doc", "sub", "lo", "hi"])

    parts = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return shards.repartition(parts, "h").sortWithinPartitions("h", "doc", "sub", "at").mapInArrow(run, "doc long, sub long, lo long, hi long")


def _contexts(texts: DataFrame, window: int) -> DataFrame:
    """(h, doc, sub, at, words, v, w): asked contexts cut from their texts.

    An automaton's context has its words and null window hashes; a hot anchor's has one row per window, without words.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            out: list[tuple] = []
            for doc, sub, packed, asked in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if not asked:
                    continue
                data = _unpack(packed)
                words, code = data.split(), None
                for a in asked:
                    low, more = a["at"] >> 16, a["at"] & 255
                    if not a["hot"]:
                        out.append((a["h"], doc, sub, a["at"], b" ".join(words[low:low + more + window]).decode("utf-8", "surrogatepass"), None, None))
                        continue
                    if code is None:
                        code = word_hashes(data, powers)
                    part = code[low:low + more + window]
                    one, two = _grams(part, window).view(np.int64).tolist(), _grams(mix(part), window).view(np.int64).tolist()
                    out += [(a["h"], doc, sub, low + i, None, v, w) for i, (v, w) in enumerate(zip(one, two))]
            kinds = [pa.int64()] * 4 + [pa.string()] + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                                             names=["h", "doc", "sub", "at", "words", "v", "w"])

    return texts.mapInArrow(run, "h long, doc long, sub long, at long, words string, v long, w long")


def _finish(texts: DataFrame, window: int, id_type: T.DataType) -> DataFrame:
    schema = T.StructType([T.StructField("doc_id", id_type), *[T.StructField(n, T.LongType()) for n in ("n_words", "n_removed")],
                           T.StructField("kept_sha256", T.StringType()), T.StructField("removed", T.ArrayType(T.ArrayType(T.LongType())))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            counts, removed, shas, spans = [], [], [], []
            for packed, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = _unpack(packed).split()
                kept, at, gone = [], 0, []
                for r in sorted((r["lo"], r["hi"] + window) for r in ranges or ()):
                    if gone and r[0] <= gone[-1][1]:
                        gone[-1][1] = max(gone[-1][1], r[1])
                    else:
                        gone.append(list(r))
                for a, b in gone:
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                counts.append(len(words))
                removed.append(len(words) - len(kept))
                shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                spans.append(gone)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(shas, pa.string()),
                                              pa.array(spans, pa.list_(pa.list_(pa.int64())))],
                                             names=["doc_id", "n_words", "n_removed", "kept_sha256", "removed"])

    return texts.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, text_col: str = "text", window: int = 20) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and ``removed`` (word ranges [start, end)) for every row."""
    if not ANCHOR <= window <= 255:
        raise ValueError("window must be from 5 to 255 words")
    spark = docs.sparkSession
    base = docs.select("doc_id", F.col(f"`{text_col}`").alias("text"))
    ids = base.groupBy("doc_id").count().where((F.col("count") > 1) | F.col("doc_id").isNull())
    shared = ids.limit(1).count() > 0
    sub = F.coalesce(F.xxhash64("text"), F.lit(0)) if shared else F.lit(0)
    keyed = base.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"), sub.cast("long").alias("sub"), "text")

    # 1. anchors that occur twice
    twice = stage(anchor_hashes(keyed, window).groupBy("h").count().where("count > 1").select("h"), "anchors")
    found = stage(anchor_rows(keyed, window).join(twice, "h"), "occurrences")
    # 2. whole contexts
    first = stage(found.groupBy("h", "c").agg(F.min(F.struct("doc", "sub", "at")).alias("f")).select("h", "c", "f.*"), "contexts")
    is_first = found.join(first.select("h", "c", *[F.col(x).alias(f"f_{x}") for x in ("doc", "sub", "at")]), ["h", "c"])
    whole = (is_first.where("doc != f_doc or sub != f_sub or at != f_at")
             .select("doc", "sub", F.shiftright("at", 16).alias("lo"), (F.shiftright("at", 16) + F.col("at").bitwiseAND(255)).alias("hi")))
    # 3., 4. contexts to compare
    many = first.groupBy("h").count().where("count > 1")
    asked = (first.join(many, "h").groupBy("doc", "sub")
             .agg(F.collect_list(F.struct("h", "at", (F.col("count") > HOT).alias("hot"))).alias("asked")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = _packed(keyed).repartition(parts, "doc", "sub")
    cut = _contexts(texts.join(asked, ["doc", "sub"]).select("doc", "sub", "packed", "asked"), window)
    cut = stage(cut, "cut")
    edges = matched_ranges(cut.where("words is not null").select("h", "doc", "sub", "at", "words"), window)
    hot = cut.where("words is null").select("v", "w", "doc", "sub", "at")
    hot_first = hot.groupBy("v", "w").agg(F.min(F.struct("doc", "sub", "at")).alias("f")).select("v", "w", *[F.col(f"f.{x}").alias(f"f_{x}") for x in ("doc", "sub", "at")])
    windows = (hot.join(hot_first, ["v", "w"]).where("doc != f_doc or sub != f_sub or at != f_at")
               .select("doc", "sub", F.col("at").alias("lo"), F.col("at").alias("hi")))
    ranges = (whole.union(edges).union(windows).distinct().groupBy("doc", "sub").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")))
    out = texts.join(ranges, ["doc", "sub"], "left").select("doc_id", "packed", "ranges")
    return _finish(out, window, docs.schema["doc_id"].dataType)
