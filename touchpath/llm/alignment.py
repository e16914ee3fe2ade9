"""Cross-tokenizer alignment: where the tokens of two tokenizers end together.

The token ends of a block of documents, laid end to end, are two ascending
lists. They are merged by merge path: every ``PIECE`` steps of the merge, a
binary search along a diagonal finds how far each list has come, so pieces of
equal work need nothing of each other, however long a document is. A piece
emits its links (an A and a B token that end at one offset); the links of all
pieces in order cut the tokens into groups, and a group that lies across pieces
is stitched from them.

A linked pair covers the same last bytes, so the bytes of one token end those of
the other. The id pairs are thus a part of what the two vocabularies allow
(``most_pairs``, some hundred thousand), whatever the corpus: their counts are
one table that is checked against that bound and sent to all tasks.

Defined results: null and empty texts, and texts whose tokens don't join to
space + text again, have no tokens: zeros and ''; special strings in texts are
plain text; repeated rows are aligned and counted each; texts of any length
are aligned whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchpath.llm.common import LONG, STRING, field, map_text, stage
from touchpath.llm.token_counts import Splitter

PIECE = 1 << 16  # ends merged in one piece
BLOCK = 1 << 20  # characters of text encoded at once
KNOWN = 300_000  # distinct pre-tokens whose ids a worker keeps
SPACE = "▁"


def byte_level() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}


class ByteBpe:
    """A: a byte-level ``tokenizers`` file; encodes space + text."""

    def __init__(self, data: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(data.decode("utf-8"))
        self.tokenizer.encode_special_tokens = True
        chars = byte_level()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.cut, self.known = Splitter().pieces, {}
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        added = {t["content"] for t in json.loads(data)["added_tokens"]}
        for token, i in vocabulary.items():
            self.bytes[i] = token.encode() if token in added else bytes(chars[c] for c in token)

    def _new(self, pieces: list[str]) -> dict[str, tuple[int, ...]]:
        """What the library makes of pre-tokens; (-1,) where that doesn't join to the pre-token again."""
        encoded = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return {p: tuple(e.ids) if b"".join(map(self.bytes.__getitem__, e.ids)) == p.encode("utf-8") else (-1,) for p, e in zip(pieces, encoded)}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of space + text; the library encodes each distinct pre-token, which stands for itself in every text."""
        cut = [self.cut(" " + t) for t in texts]
        known = self.known
        more = self._new(list({p for pieces in cut for p in pieces if p not in known}))
        if len(known) + len(more) <= KNOWN:
            known.update(more)
            more = known
        else:  # what doesn't fit is kept for this block alone
            more = {**more, **{p: known[p] for pieces in cut for p in pieces if p in known}}
        return [np.fromiter(chain.from_iterable(map(more.__getitem__, pieces)), np.int64) for pieces in cut]


class Pieces:
    """B: a ``sentencepiece`` model, which sets a space before the text itself."""

    def __init__(self, data: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        pieces = range(self.model.get_piece_size())
        self.bytes = [bytes([int(self.model.id_to_piece(i)[3:-1], 16)]) if self.model.is_byte(i)
                      else self.model.id_to_piece(i).replace(SPACE, " ").encode("utf-8") for i in pieces]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]


def most_pairs(a: list[bytes], b: list[bytes]) -> int:
    """Upper bound of the linked id pairs: of two tokens that end together one ends in the other."""
    def ids(tokens: list[bytes]) -> dict[bytes, int]:
        held: dict[bytes, int] = {}
        for t in tokens:
            if t:
                held[t] = held.get(t, 0) + 1
        return held

    in_a, in_b = ids(a), ids(b)
    shorter_b = sum(n * in_b.get(t[i:], 0) for t, n in in_a.items() for i in range(len(t)))
    return shorter_b + sum(n * in_a.get(t[i:], 0) for t, n in in_b.items() for i in range(1, len(t)))


def diagonals(a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each merge step count of ``at``, how many of ``a`` come among the first steps (equal ends: ``a`` first)."""
    low, high = np.maximum(at - len(b), 0), np.minimum(at, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        # the merge has passed a[middle] if b's step before it on the diagonal is not smaller
        passed = np.zeros(len(at), bool)
        passed[open_] = a[middle[open_]] <= b[at[open_] - middle[open_] - 1]
        low, high = np.where(open_ & passed, middle + 1, low), np.where(open_ & ~passed, middle, high)
    return low


def piece_links(a: np.ndarray, b: np.ndarray, from_a: int, to_a: int, from_b: int, to_b: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the links whose later step lies in one piece of the merge."""
    if from_a and from_b < to_b and a[from_a - 1] == b[from_b]:
        from_a -= 1  # the piece before holds the A end of this link
    part_a, part_b = a[from_a:to_a], b[from_b:to_b]
    if not len(part_a) or not len(part_b):
        return (np.zeros(0, np.int64),) * 2
    found = np.searchsorted(part_b, part_a)
    same = part_b[np.minimum(found, len(part_b) - 1)] == part_a
    return from_a + np.flatnonzero(same), from_b + found[same]


def links(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """(indices in a, indices in b) of the ends that both ascending lists hold, in order."""
    steps = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    cut = diagonals(a, b, steps)
    parts = [piece_links(a, b, i, k, s - i, t - k) for i, k, s, t in zip(cut[:-1], cut[1:], steps[:-1], steps[1:])]
    return tuple(np.concatenate([p[side] for p in parts] or [np.zeros(0, np.int64)]) for side in (0, 1))


class Aligner:
    """Encodes and aligns blocks of texts in one worker."""

    def __init__(self, a: bytes, b: bytes):
        self.a, self.b = ByteBpe(a), Pieces(b)
        self.sizes = [np.array([len(t) for t in x.bytes], np.int64) for x in (self.a, self.b)]
        n_a, n_b = len(self.a.bytes), len(self.b.bytes)
        self.n_b = n_b
        # a token's text by its side and by whether it ends its group
        self.shown = [f"{i}{end}" for n, end in ((n_a, ","), (n_a, "|"), (n_b, ","), (n_b, ";")) for i in range(n)]

    def _joins(self, a: np.ndarray, b: np.ndarray, text: str) -> bool:
        """Whether the tokens of both join to space + text; A's do where each pre-token's do."""
        if (a < 0).any():
            return False
        data = b" " + text.encode("utf-8")
        return int(self.sizes[1][b].sum()) == len(data) and b"".join(map(self.b.bytes.__getitem__, b.tolist())) == data

    def block(self, texts: list[str]) -> list[list]:
        """Per text: n_a, n_b, n_groups, groups text, sorted id pairs ``a * n_b + b`` and how often each is linked."""
        out = [[0, 0, 0, "", [], []] for _ in texts]
        held = [i for i, t in enumerate(texts) if t]
        sent = [texts[i] for i in held]
        both = [(i, x, y) for i, t, x, y in zip(held, sent, self.a.encode(sent), self.b.encode(sent))
                if self._joins(x, y, t)]
        if not both:
            return out
        ids = [np.concatenate([r[side] for r in both]) for side in (1, 2)]
        ends = [np.cumsum(sizes[x]) for sizes, x in zip(self.sizes, ids)]
        at_a, at_b = links(*ends)
        last_a = np.cumsum([len(r[1]) for r in both]) - 1
        stop = np.searchsorted(at_a, last_a) + 1  # links up to the end of each text: its last tokens end together
        pairs = ids[0][at_a] * self.n_b + ids[1][at_b]
        shown = self._groups(ids, at_a, at_b)
        token_stop = (at_a[stop - 1] + at_b[stop - 1] + 2).tolist()
        from_link = from_token = 0
        for (i, x, y), to_link, to_token in zip(both, stop.tolist(), token_stop):
            text = "".join(map(self.shown.__getitem__, shown[from_token:to_token]))[:-1]
            known, times = np.unique(pairs[from_link:to_link], return_counts=True)
            out[i] = [len(x), len(y), to_link - from_link, text, known, times]
            from_link, from_token = to_link, to_token
        return out

    def _groups(self, ids: list[np.ndarray], at_a: np.ndarray, at_b: np.ndarray) -> list[int]:
        """Entries of ``shown`` in the order of the groups: a group's A tokens, then its B tokens."""
        n_a = len(self.a.bytes)
        codes = np.empty(len(ids[0]) + len(ids[1]), np.int64)
        b_before = np.repeat(np.concatenate([[0], at_b[:-1] + 1]), np.diff(at_a, prepend=-1))
        a_through = np.repeat(at_a + 1, np.diff(at_b, prepend=-1))
        kind_a, kind_b = np.zeros(len(ids[0]), np.int64), np.full(len(ids[1]), 2 * n_a, np.int64)
        kind_a[at_a] += n_a
        kind_b[at_b] += self.n_b
        codes[np.arange(len(ids[0])) + b_before] = ids[0] + kind_a
        codes[np.arange(len(ids[1])) + a_through] = ids[1] + kind_b
        return codes.tolist()

    def texts(self, texts: list[str]) -> Iterator[list]:
        held, size = [], 0
        for t in texts:
            held.append(t)
            size += len(t)
            if size >= BLOCK:
                yield from self.block(held)
                held, size = [], 0
        yield from self.block(held)


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def align(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", keep: list[str] | None = None, with_groups: bool = False) -> DataFrame:
    """``keep`` columns, n_a, n_b, n_groups, groups_sha256, the linked id pairs of each text (``a * size of B + b``) and how often each is linked.

    ``with_groups`` adds the groups themselves as text. The two vocabulary files
    are read on the driver and sent to the tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast({"files": (_read(a_path), _read(b_path))})

    def make() -> Callable[[list[str]], list[list]]:
        worker = shared.value  # lives as long as the Python worker, and so does the aligner
        aligner = worker.get("aligner") or worker.setdefault("aligner", Aligner(*worker["files"]))

        def compute(texts: list[str]) -> list[list]:
            rows = list(aligner.texts(texts))
            digest = [hashlib.sha256(r[3].encode()).hexdigest() if r[3] else "" for r in rows]
            return [[r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], digest, [r[4] for r in rows], [r[5] for r in rows],
                    *([[r[3] for r in rows]] if with_groups else [])]

        return compute

    longs = T.ArrayType(LONG)
    fields = [field("n_a", LONG), field("n_b", LONG), field("n_groups", LONG), field("groups_sha256", STRING), field("pairs", longs),
              field("times", longs), *([field("groups", STRING)] if with_groups else [])]
    return map_text(docs, text_col, keep if keep is not None else ["doc_id"], fields, make)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n): how many links of the corpus hold each id pair."""
    one = F.explode(F.arrays_zip("pairs", "times")).alias("p")
    return aligned.select(one).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("n"))


def with_link_counts(aligned: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Adds n_links, n_best (links whose pair is its B id's most frequent, ties included) and count_sum; ``aligned`` is read twice, give it staged."""
    a, b = ByteBpe(_read(a_path)).bytes, Pieces(_read(b_path)).bytes
    most = most_pairs(a, b)
    held = pair_counts(aligned).limit(most + 1).toArrow()
    if held.num_rows > most:
        raise ValueError("more linked pairs than the vocabularies allow")
    pairs, counts = held.column("pair").to_numpy(), held.column("n").to_numpy()
    order = np.argsort(pairs)
    pairs, counts = pairs[order], counts[order]
    highest = np.zeros(len(b), np.int64)
    np.maximum.at(highest, pairs % len(b), counts)
    shared = aligned.sparkSession.sparkContext.broadcast((pairs, counts, counts == highest[pairs % len(b)]))
    schema = T.StructType([f for f in aligned.schema if f.name not in ("pairs", "times")] + [field(c, LONG) for c in ("n_links", "n_best", "count_sum")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        known, counts, best = shared.value
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times").flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            at = np.searchsorted(known, lists.flatten().to_numpy())
            sums = []
            for worth in (times, times * best[at], times * counts[at]) if len(at) else ():
                total = np.zeros(batch.num_rows, np.int64)
                np.add.at(total, row, worth)
                sums.append(total)
            kept = [c for c in batch.schema.names if c not in ("pairs", "times")]
            sums = sums or [np.zeros(batch.num_rows, np.int64)] * 3
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *[pa.array(s) for s in sums]], names=[*kept, "n_links", "n_best", "count_sum"])

    return aligned.mapInArrow(run, schema)


def align_tokens(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, n_a, n_b, n_groups, groups_sha256, n_links, n_best and count_sum of every row."""
    return with_link_counts(stage(align(docs, a_path, b_path, text_col, keep), "aligned"), a_path, b_path)
