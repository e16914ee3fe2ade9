"""Phrase collocations: exact n-gram counts from burst tries, then the weakest cut of each frequent phrase.

Each task counts the phrases of its texts in a HAT-trie of word ids: one level
of first words, under each a hash container of (second, third) word counts that
bursts into one container per second word once it is full. When the trie holds
``limit`` entries, its largest subtrees leave as sorted, compressed runs; after
the last text all do. A run is cut by prefix partition (language, first two
words, and a salt of the third, so a hot prefix spreads); there are as many
partitions as the texts have ``PARTITION`` bytes, so each is merged in bounded
memory at every size. What reaches the minimum count is all that later steps
read: a phrase that frequent has only parts that are as frequent.

Defined results: null and empty texts hold no words; a null language is
``und``; a piece of one word gives no phrase; repeated rows count as often as
they stand; texts of any length are read in blocks, phrases across a block's
edge included; an empty table gives no rows; other columns are not read. Ties in
score and count go to the smaller phrase by UTF-8 bytes.
"""

from __future__ import annotations

import gc
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchpath.llm.common import stage

#: What cuts a text into pieces.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BREAK = b"\xff"  # in no UTF-8 text
_TO_BLOCK = bytes(0xFF if b in PIECE_ENDS else b + 32 if 65 <= b <= 90 else b for b in range(256))
BLOCK = 2 << 20  # bytes of text taken at once
BURST = 32_768
WORD_BITS = 21  # of a word id in a packed key: ids of one trie stay below 2^21
_LOW = (1 << WORD_BITS) - 1
PARTITION = 8 << 20  # bytes of text whose phrases are merged together
SALTS = 64
MERGE = 4_000_000  # entries of runs read before they are merged with what is there
RUN_SCHEMA = "lang string, part long, run binary"


class WordIds(dict):
    """Ids of words in order of arrival; 0 is the break between pieces."""

    def __init__(self):
        super().__init__({BREAK: 0})
        self.hashes = [0]

    def __missing__(self, word: bytes) -> int:
        self[word] = new = len(self)
        self.hashes.append(zlib.crc32(word))
        return new


class HatTrie:
    """Phrase counts of one language: first word -> container of packed (second, third), or a node of second -> container of third.

    A missing second or third word is 0, so phrases of one to three words share the trie.
    """

    def __init__(self):
        self.roots: dict[int, dict] = {}
        self.burst: dict[int, dict[int, dict[int, int]]] = {}
        self.held: dict[int, int] = {}  # entries under a first word
        self.size = 0

    def add(self, first: np.ndarray, rest: np.ndarray, counts: np.ndarray) -> None:
        """Adds distinct phrases, sorted by first word; ``rest`` is ``second << WORD_BITS | third``."""
        cuts = np.flatnonzero(np.diff(first, prepend=-1)).tolist()
        rest, counts, words = rest.tolist(), counts.tolist(), first[cuts].tolist()
        for word, a, b in zip(words, cuts, [*cuts[1:], len(rest)]):
            if word in self.burst:
                self._add_below(word, rest[a:b], counts[a:b])
                continue
            container = self.roots.get(word)
            if container is None:
                container = self.roots[word] = dict(zip(rest[a:b], counts[a:b]))
            else:
                known = container.get
                for key, n in zip(rest[a:b], counts[a:b]):
                    container[key] = known(key, 0) + n
            self._resize(word, len(container))
            if len(container) > BURST:
                del self.roots[word]
                self.burst[word] = {}
                self.size -= self.held.pop(word)
                self._add_below(word, container.keys(), container.values())

    def _add_below(self, word: int, keys: Iterable[int], counts: Iterable[int]) -> None:
        node, new = self.burst[word], 0
        for key, n in zip(keys, counts):
            container = node.get(key >> WORD_BITS)
            if container is None:
                container = node[key >> WORD_BITS] = {}
            third = key & _LOW
            before = container.get(third)
            if before is None:
                new += 1
                container[third] = n
            else:
                container[third] = before + n
        self._resize(word, self.held.get(word, 0) + new)

    def _resize(self, word: int, size: int) -> None:
        self.size += size - self.held.get(word, 0)
        self.held[word] = size

    def take(self, at_least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Removes the largest subtrees until ``at_least`` entries have left: their (first, rest, count)."""
        words, containers, seconds, left = [], [], [], 0
        for word in sorted(self.held, key=self.held.__getitem__, reverse=True):
            if left >= at_least:
                break
            left += self.held.pop(word)
            node = self.burst.pop(word, None)
            if node is None:
                words.append(word)
                seconds.append(0)
                containers.append(self.roots.pop(word))
            else:
                words += [word] * len(node)
                seconds += node.keys()
                containers += node.values()
        self.size -= left
        sizes = np.fromiter(map(len, containers), np.int64, len(containers))
        flat = lambda of: np.fromiter(chain.from_iterable(map(of, containers)), np.int64, left)
        return (np.repeat(np.array(words, np.int64), sizes), flat(dict.keys) | np.repeat(np.array(seconds, np.int64) << WORD_BITS, sizes), flat(dict.values))


def blocks(texts: Iterable[bytes]) -> Iterator[tuple[list[bytes], bool]]:
    """(words, whether a text is cut after them): words of many short texts, or of a part of a long one."""
    held, size = [], 0
    for text in texts:
        at = 0
        while len(text) - at > BLOCK:
            end = at + BLOCK
            while end < len(text) and text[end] not in b" \t" + PIECE_ENDS:
                end += 1
            held.append(text[at:end])
            yield _words(held), end < len(text)
            held, size, at = [], 0, end
        if at and at < len(text):
            yield _words([text[at:]]), False
        elif not at:
            held.append(text)
            size += len(text)
            if size > BLOCK:
                yield _words(held), False
                held, size = [], 0
    if held:
        yield _words(held), False


def _words(texts: list[bytes]) -> list[bytes]:
    return BREAK.join(texts).translate(_TO_BLOCK).replace(BREAK, b" \xff ").split()


def pack(phrases: pa.Array, counts: np.ndarray) -> bytes:
    """A run as bytes: its length, counts, phrase ends and phrases, compressed together."""
    ends, data = np.frombuffer(phrases.buffers()[1], np.int32)[phrases.offset:phrases.offset + len(phrases) + 1], phrases.buffers()[2]
    body = data.slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes() if data else b""
    return zstandard.compress(struct.pack("<q", len(phrases)) + counts.tobytes() + np.diff(ends).astype(np.int32).tobytes() + body, 1)


def unpack(run: bytes) -> tuple[pa.Array, pa.Array]:
    """The phrases and counts of a run."""
    data = zstandard.decompress(run)
    n, = struct.unpack_from("<q", data)
    ends = np.concatenate([[0], np.cumsum(np.frombuffer(data, np.int32, n, 8 + 8 * n), dtype=np.int64)])
    phrases = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data[8 + 12 * n:])])
    return phrases, pa.array(np.frombuffer(data, np.int64, n, 8))


class Counter:
    """The tries of one task, by language, and the runs that leave them."""

    def __init__(self, limit: int, max_ids: int, partitions: int):
        self.limit, self.max_ids, self.partitions = limit, max_ids, partitions
        self.tries: dict[str, HatTrie] = {}
        self.totals: dict[str, int] = {}
        self.ids = WordIds()

    def add(self, lang: str, texts: Iterable[bytes]) -> Iterator[pa.RecordBatch]:
        before: list[int] = [0, 0]
        for words, goes_on in blocks(texts):
            trie = self.tries.setdefault(lang, HatTrie())
            ids = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
            self._count(trie, np.concatenate([np.array(before, np.int64), ids]))
            self.totals[lang] = self.totals.get(lang, 0) + int((ids > 0).sum())
            before = np.concatenate([[0, 0], ids])[-2:].tolist() if goes_on else [0, 0]
            if len(self.ids) > self.max_ids:
                if goes_on:
                    kept = list(self.ids)
                    tail = [kept[i] for i in before]
                yield from self.flush()
                before = [self.ids[w] for w in tail] if goes_on else before
            else:
                yield from self._spill()

    @staticmethod
    def _count(trie: HatTrie, a: np.ndarray) -> None:
        """Counts the phrases that end after the first two of ``a``."""
        one, two, three = a[2:], a[1:-1], a[:-2]
        single = one > 0
        double = single & (two > 0)
        triple = double & (three > 0)
        shift = np.int64(2 * WORD_BITS)
        keys = np.concatenate([one[single] << shift, two[double] << shift | one[double] << WORD_BITS,
                               three[triple] << shift | two[triple] << WORD_BITS | one[triple]])
        if len(keys):
            keys, counts = np.unique(keys, return_counts=True)
            trie.add(keys >> shift, keys & ((1 << 2 * WORD_BITS) - 1), counts)

    def _spill(self) -> Iterator[pa.RecordBatch]:
        total = sum(t.size for t in self.tries.values())
        if total > self.limit:
            lang, trie = max(self.tries.items(), key=lambda x: x[1].size)
            yield from self._run(lang, trie.take(max(total - self.limit // 2, 1)))

    def flush(self) -> Iterator[pa.RecordBatch]:
        for lang, trie in self.tries.items():
            yield from self._run(lang, trie.take(trie.size))
        for lang, n in self.totals.items():  # a language's words are the count of the empty phrase
            yield _rows(lang, [0], [pack(pa.array([b""]), np.array([n], np.int64))])
        self.tries, self.totals, self.ids = {}, {}, WordIds()

    def _run(self, lang: str, entries: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
        """The entries sorted and cut by prefix partition."""
        first, rest, counts = entries
        if not len(first):
            return
        second, third = rest >> WORD_BITS, rest & _LOW
        hashes = np.array(self.ids.hashes, np.uint64)
        mixed = (hashes[first] * _ODD[0] + hashes[second] * _ODD[1] + (hashes[third] % np.uint64(SALTS)) * _ODD[2])
        part = ((mixed ^ mixed >> np.uint64(29)) * _ODD[0] >> np.uint64(20)).astype(np.int64) % self.partitions
        order = np.lexsort((first << 2 * WORD_BITS | rest, part))
        words = pa.array([b"", *islice(self.ids, 1, None)], pa.binary())
        cuts = np.append(np.flatnonzero(np.diff(part[order], prepend=-1)), len(order))
        parts, runs, size = [], [], 0
        for at, to in zip(cuts[:-1], cuts[1:]):
            a, b, c = (words.take(pa.array(x[order[at:to]])) for x in (first, second, third))
            double = pc.binary_join_element_wise(a, b, b" ")
            phrases = pc.if_else(pa.array(third[order[at:to]] > 0), pc.binary_join_element_wise(double, c, b" "),
                                 pc.if_else(pa.array(second[order[at:to]] > 0), double, a))
            parts.append(int(part[order[at]]))
            runs.append(pack(phrases, counts[order[at:to]]))
            size += len(runs[-1])
            if size > BLOCK:
                yield _rows(lang, parts, runs)
                parts, runs, size = [], [], 0
        yield _rows(lang, parts, runs)


_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _rows(lang: str, parts: list[int], runs: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(parts), pa.string()), pa.array(parts, pa.int64()), pa.array(runs, pa.binary())],
                                      names=["lang", "part", "run"])


def phrase_runs(docs: DataFrame, text_col: str, lang: Column, limit: int, max_ids: int) -> DataFrame:
    """(lang, part, run): counted phrases of one to three words; a phrase may stand in several runs of its partition."""
    size = docs.agg(F.sum(F.octet_length(f"`{text_col}`"))).first()[0] or 0
    partitions = int(size // PARTITION) + 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        gc.disable()  # the tries are many small acyclic dicts, which a full collection would walk again and again
        counter = Counter(limit, max_ids, partitions)
        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                if text:
                    by_lang.setdefault(name, []).append(text)
            for name, texts in by_lang.items():
                yield from counter.add(name, texts)
        yield from counter.flush()
        gc.enable()

    runs = docs.select(lang.alias("lang"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, RUN_SCHEMA)
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), partitions // 8 + 1)  # tasks grow with the texts, too
    return runs.repartition(tasks, "lang", "part")


def phrase_counts(docs: DataFrame, min_count: int, text_col: str = "text", lang: Column | None = None, limit: int = 600_000,
                  max_ids: int = 250_000) -> DataFrame:
    """(lang, phrase, n) of every phrase of one to three words with ``n >= min_count``, and each language's words as phrase ''.

    ``limit`` is the entries a task's tries hold before subtrees leave, ``max_ids`` the words before all of them leave.
    """
    if not 0 < max_ids <= 500_000:
        raise ValueError("max_ids must leave room for the words of one more block")
    runs = phrase_runs(docs, text_col, lang if lang is not None else F.coalesce(F.col("lang"), F.lit("und")), limit, max_ids)

    def merge(table: pa.Table) -> pa.Table:
        merged, held, size = None, [], 0
        for at, run in enumerate(table.column("run"), 1):
            held.append(pa.table(unpack(run.as_py()), ["phrase", "n"]))
            size += held[-1].num_rows
            if size > MERGE or at == table.num_rows:
                merged = pa.concat_tables(held).group_by("phrase").aggregate([("n", "sum")]).rename_columns(["phrase", "n"])
                held, size = [merged], 0
        wanted = merged.filter(pc.or_(pc.greater_equal(merged["n"], min_count), pc.equal(merged["phrase"], pa.scalar(b"", pa.large_binary()))))
        return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * wanted.num_rows, pa.string()),
                         "phrase": wanted["phrase"].cast(pa.binary()).cast(pa.string()), "n": wanted["n"]})

    return runs.groupBy("lang", "part").applyInArrow(merge, "lang string, phrase string, n long")


def collocations(docs: DataFrame, min_count: int = 10, cover_percent: int = 50, scale: int = 1_000_000, top: int = 2_000, **counting) -> DataFrame:
    """Each language's ``top`` phrases of two or three words by the score of their weakest cut.

    Returns lang, rank, phrase, a (its count), l and r (the counts of the cut's
    two parts), n (words of the language) and score, ``floor(scale * a * a / (l * r))``.
    A phrase goes if a longer one that holds it is ``cover_percent`` of its count or more.
    """
    counts = stage(phrase_counts(docs, min_count, **counting), "phrases")
    words = F.split("phrase", " ")
    phrases = counts.where(F.contains("phrase", F.lit(" "))).select("lang", "phrase", F.col("n").alias("a"), words.alias("w"))
    covered = (phrases.where(F.size("w") == 3).select("lang", "a", F.explode(F.array(F.slice("w", 1, 2), F.slice("w", 2, 2))).alias("w"))
               .groupBy("lang", F.array_join("w", " ").alias("phrase")).agg(F.max("a").alias("longer")))
    cuts = phrases.select("lang", "phrase", "a", F.posexplode(F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda k: F.struct(
        F.array_join(F.slice("w", F.lit(1), k), " ").alias("left"), F.array_join(F.slice("w", k + 1, F.size("w") - k), " ").alias("right")))).alias("k", "c"))
    part = lambda side, name: counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name))
    scored = (cuts.select("lang", "phrase", "a", "k", "c.left", "c.right").join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
              .withColumn("score", _floor_ratio(scale, "a", "l", "r")))
    weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = (weakest.join(covered, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(cover_percent) * F.col("a"))))
    order = [F.desc("cut.score"), F.desc("a"), F.col("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.hash("phrase"), F.lit(SALTS))).orderBy(*order)  # a common language's tops come from several tasks
    tops = best.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    ranked = (tops.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
              .where(F.col("rank") <= top))
    total = counts.where(F.col("phrase") == "").select("lang", F.col("n"))
    return (ranked.join(total, "lang").select("lang", "rank", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
                                              F.col("cut.score").alias("score")))


def _floor_ratio(scale: int, a: str, left: str, right: str) -> Column:
    """``floor(scale * a * a / (left * right))`` in whole numbers of up to 38 digits."""
    return F.expr(f"(cast({a} as decimal(19,0)) * cast({a} as decimal(19,0)) * {scale}BD) div (cast({left} as decimal(19,0)) * cast({right} as decimal(19,0)))")
