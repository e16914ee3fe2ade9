"""Toxicity score: boosted trees over a few dense features, calibrated by isotonic regression.

Training reads at most ``max_rows`` labelled documents (chosen by id hash). A
lexicon comes from them: a short fixed list of abusive words, and the word
stems (first 4 to 7 letters) whose use, once or more than once in a text, marks
toxic training documents. A text then is
described by lexicon densities, how near lexicon words stand to the second
person, shares of capitals, punctuation and disguised spellings. Trees are
boosted on the larger part of the sample, and the rest maps their log-odds to
probabilities by isotonic regression, read between its steps by straight lines.
Lexicon, trees and steps have sizes fixed by parameters and go to the tasks,
which score every whole text in one pass.

Defined results: null and empty texts have all features 0 and are scored like
others; a label counts by id, toxic if any label of the id is; a null id is
held out, as it can't be dealt; rows that repeat an id and text train once;
without training rows, or with one class alone, every score is the share of
toxic labels (0 without any); repeated rows get repeated scores; texts of any
length are read whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchpath.llm.common import DOUBLE, field, map_text, stage

FOLDS = 5
#: Abusive words that count whatever the labels say.
ABUSE = frozenset("""idiot idiots moron morons stupid dumb loser losers scum trash garbage clown pathetic worthless disgusting filthy ugly hate
idiota imbecil estupido basura asqueroso patetico payaso inutil idiote imbecile debile ordure degoutant pathetique minable clown nul
dummkopf trottel abschaum widerlich wertlos erbarmlich dumm muell""".split())
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous vos votre ti usted tus vosotros".split())
SHORTEST, LONGEST = 4, 7  # letters of a learned stem
NEAR = 5  # words between a lexicon word and the second person
_WORD = re.compile(r"[^\W_]+(?:[^\w\s]{1,3}[^\W_]+)*").findall  # letters and digits, with marks inside (id!ot, f.o.o)
_LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "i", "*": None, ".": None, "-": None,
                       "é": "e", "è": "e", "ê": "e", "á": "a", "ó": "o", "í": "i", "ú": "u", "ä": "a", "ö": "o", "ü": "u"})
FEATURES = ("abuse", "abuse_per_word", "abuse_kinds", "learned", "learned_per_word", "learned_kinds", "learned_most", "near_you", "near_you_per_word", "you_per_word",
            "disguised", "disguised_per_word", "mixed_per_word", "capitals", "capital_words", "exclaims", "questions", "marks", "longest_run", "words")


def words_of(text: str) -> list[str]:
    """Lower-cased words, marks inside a word kept."""
    return _WORD(text.lower())


class Stems:
    """Finds the learned stem that starts a word."""

    def __init__(self, stems: frozenset[str]):
        self.by_start: dict[str, tuple[str, ...]] = {}
        for s in sorted(stems):
            self.by_start[s[:SHORTEST]] = (*self.by_start.get(s[:SHORTEST], ()), s)

    def of(self, word: str) -> str | None:
        known = self.by_start.get(word[:SHORTEST])
        return next((s for s in known if word.startswith(s)), None) if known else None


def measure(text: str, learned: Stems) -> list[float]:
    """FEATURES of one text."""
    words = words_of(text)
    n = len(words)
    per = 1 / max(n, 1)
    abuse = kinds = disguised = mixed = you = most = 0
    hits, stems = set(), Counter()
    for w, c in Counter(words).items():
        if w in SECOND_PERSON:
            you += c
        stem = learned.of(w)
        insult = w in ABUSE
        if not (insult or stem or w.isalpha()):
            bare = w.translate(_LEET)
            insult, stem = bare in ABUSE, learned.of(bare)
            mixed += c
            disguised += c * (insult or stem is not None)
        elif not insult and not w.isascii():
            insult = w.translate(_LEET) in ABUSE
        if insult:
            abuse, kinds = abuse + c, kinds + 1
            hits.add(w)
        if stem:
            stems[stem] += c
            hits.add(w)
    learned_hits, most = sum(stems.values()), max(stems.values(), default=0)
    near = 0
    if hits and you:
        at = np.flatnonzero(np.fromiter(map(hits.__contains__, words), bool, n))
        person = np.flatnonzero(np.fromiter(map(SECOND_PERSON.__contains__, words), bool, n))
        after = np.searchsorted(person, at - NEAR)
        near = int((np.append(person, n + 2 * NEAR)[after] <= at + NEAR).sum())
    letters = upper = 0
    for c, k in Counter(text).items():
        if c.isalpha():
            letters += k
            upper += k * c.isupper()
    raw = text.split()
    shouted = sum(len(w) > 2 and w.isupper() for w in raw)
    marks = len(text) - letters - sum(map(text.count, " \n\t0123456789"))
    longest = max((len(m) for m in re.findall(r"[!?]+", text)), default=0) if "!" in text or "?" in text else 0
    return [min(abuse, 50), abuse * per, kinds, min(learned_hits, 50), learned_hits * per, len(stems), min(most, 50), min(near, 50), near * per, you * per,
            min(disguised, 50), disguised * per, mixed * per, upper / max(letters, 1), shouted / max(len(raw), 1), text.count("!") * per,
            text.count("?") * per, marks / max(len(text), 1), min(longest, 20), np.log1p(n)]


# --- the model ------------------------------------------------------------

@dataclass(frozen=True)
class Model:
    """Lexicon, trees as flat arrays (feature, cut, low, high; leaves have feature -1 and their worth in cut) and the steps of the calibration."""

    lexicon: frozenset[str]
    start: float
    trees: tuple[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], ...]
    log_odds: np.ndarray
    chances: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of feature rows."""
        z = np.full(len(x), self.start)
        for feature, cut, low, high in self.trees:
            at = np.zeros(len(x), np.int64)
            while (inner := feature[at] >= 0).any():
                rows = np.flatnonzero(inner)
                node = at[rows]
                at[rows] = np.where(x[rows, feature[node]] <= cut[node], low[node], high[node])
            z += cut[at]
        return z

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.log_odds, self.chances)


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 48, ridge: float = 2.0) -> tuple[float, tuple]:
    """Gradient-boosted trees for the log-odds, split by Newton gains over binned features."""
    start = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    cuts = [np.unique(np.quantile(np.unique(x[:, f]), np.linspace(0, 1, bins)[:-1], method="lower")) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)], axis=1)  # in bin i: above cut i - 1
    z, trees = np.full(len(y), start), []
    offsets = np.arange(x.shape[1]) * (bins + 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z))
        g, h = y - p, p * (1 - p)
        tree: list[list] = []

        def grow(rows: np.ndarray, level: int) -> int:
            me, all_g, all_h = len(tree), g[rows].sum(), h[rows].sum()
            tree.append([-1, rate * all_g / (all_h + ridge), 0, 0])
            if level == 0 or len(rows) < 20:
                return me
            slots = (binned[rows] + offsets).ravel()
            size = x.shape[1] * (bins + 1)
            low_g = np.bincount(slots, np.repeat(g[rows], x.shape[1]), size).reshape(x.shape[1], -1).cumsum(axis=1)
            low_h = np.bincount(slots, np.repeat(h[rows], x.shape[1]), size).reshape(x.shape[1], -1).cumsum(axis=1)
            gain = low_g**2 / (low_h + ridge) + (all_g - low_g)**2 / (all_h - low_h + ridge) - all_g**2 / (all_h + ridge)
            for f, c in enumerate(cuts):
                gain[f, len(c):] = 0
            f, b = np.unravel_index(np.argmax(gain), gain.shape)
            if gain[f, b] <= 1e-6:
                return me
            left = binned[rows, f] <= b
            tree[me][:2] = int(f), float(cuts[f][b])
            tree[me][2] = grow(rows[left], level - 1)
            tree[me][3] = grow(rows[~left], level - 1)
            return me

        grow(np.arange(len(y)), depth)
        flat = tuple(np.array([n[i] for n in tree], np.float64 if i == 1 else np.int64) for i in range(4))
        trees.append(flat)
        z = z + Model(frozenset(), 0.0, (flat,), z, z).raw(x)
    return start, tuple(trees)


def isotonic(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Calibration points: the middle log-odds and the share of labels 1 of each pooled block, both ascending.

    Each block's share counts one more row, as the whole sample is: no score is exactly 0 or 1.
    """
    order = np.argsort(z, kind="stable")
    blocks: list[list[float]] = []  # ones, rows, sum of log-odds
    values, first, sizes = np.unique(z[order], return_index=True, return_counts=True)
    ones = np.add.reduceat(y[order], first)
    for v, k, n in zip(values.tolist(), ones.tolist(), sizes.tolist()):
        blocks.append([k, n, v * n])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    prior = y.mean()
    chances = np.array([(k + prior) / (n + 1) for k, n, _ in blocks])
    return np.array([s / n for _, n, s in blocks]), np.maximum.accumulate(chances)


# --- training -------------------------------------------------------------

def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(True))


def _bounded(df: DataFrame, keys: list[str], max_rows: int) -> DataFrame:
    """All rows, or those of an even share of the key hashes that holds fewer than ``max_rows``."""
    n = df.count()
    if n <= max_rows:
        return df
    return df.where(F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) < int((1 << 30) * 0.9 * max_rows / n)).limit(max_rows)


def training_texts(docs: DataFrame, labels: DataFrame, text_col: str, label_col: str, max_rows: int) -> DataFrame:
    """(doc_id, toxic, text) of at most ``max_rows`` labelled documents outside the held-out fold, staged."""
    judged = (labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max(F.when(F.col(label_col) > 0, 1).otherwise(0)).alias("toxic")))
    chosen = stage(_bounded(judged, ["doc_id"], max_rows), "labelled-ids")
    texts = docs.select("doc_id", F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")  # at most max_rows ids
    hashed = texts.withColumn("h", F.xxhash64("text"))
    once = stage(_bounded(hashed.select("doc_id", "toxic", "h").distinct(), ["doc_id", "h"], max_rows), "labelled-hashes")
    return stage(hashed.join(F.broadcast(once.select("doc_id", "h")), ["doc_id", "h"]).dropDuplicates(["doc_id", "h"])
                 .select("doc_id", "toxic", "text"), "labelled-texts")


def stem_documents(texts: DataFrame) -> DataFrame:
    """(stem, often, toxic, clean): training texts that use a stem (``often`` 1) or use it again (``often`` 2), counted in each task first."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held: dict[tuple[str, int], list[int]] = {}

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in held], pa.string()), pa.array([k[1] for k in held], pa.int32()),
                                               pa.array([v[1] for v in held.values()], pa.int64()), pa.array([v[0] for v in held.values()], pa.int64())],
                                              names=["stem", "often", "toxic", "clean"])

        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                used = Counter()
                for w, c in Counter(words_of(text)).items():
                    for k in range(SHORTEST, min(LONGEST, len(w)) + 1):
                        used[w[:k]] += c
                for stem, c in used.items():
                    held.setdefault((stem, 1), [0, 0])[toxic] += 1
                    if c > 1:
                        held.setdefault((stem, 2), [0, 0])[toxic] += 1
                if len(held) > 500_000:
                    yield rows()
                    held.clear()
        yield rows()

    found = texts.select("toxic", "text").mapInArrow(run, "stem string, often int, toxic long, clean long")
    return found.groupBy("stem", "often").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn_lexicon(texts: DataFrame, min_documents: int, lift: float, size: int) -> frozenset[str]:
    """At most ``size`` stems that mark toxic training texts: used in ``min_documents`` of them, ``lift`` times as commonly as in others.

    Of nested stems only the most telling stays (of equal ones the longest).
    """
    toxic, n = texts.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    if not toxic or toxic == n:
        return frozenset()
    ratio = (F.col("toxic") / F.lit(float(toxic))) / ((F.col("clean") + 0.5) / F.lit(float(n - toxic)))
    ranked = (stem_documents(texts).where(F.col("toxic") >= min_documents).withColumn("ratio", ratio).where(F.col("ratio") >= lift)
              .groupBy("stem").agg(F.max(F.col("toxic") * F.log("ratio")).alias("worth"))
              .orderBy(F.desc("worth"), F.desc(F.length("stem")), "stem").limit(16 * size).collect())
    chosen: set[str] = set()
    starts: set[str] = set()  # of chosen stems
    for r in ranked:
        own = {r.stem[:k] for k in range(SHORTEST, len(r.stem) + 1)}
        if len(chosen) < size and r.stem not in starts and not own & chosen:
            chosen.add(r.stem)
            starts |= own
    return frozenset(chosen)


def train(docs: DataFrame, labels: DataFrame, text_col: str = "text", label_col: str = "toxic", max_rows: int = 20_000, min_documents: int = 8,
          lift: float = 8.0, lexicon_size: int = 200) -> Model:
    """The model of at most ``max_rows`` labelled documents; a fifth of them calibrate and neither boost nor name words."""
    texts = training_texts(docs, labels, text_col, label_col, max_rows)
    calibrates = F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(5)) == 0
    lexicon = learn_lexicon(texts.where(~calibrates), min_documents, lift, lexicon_size)
    rows = with_features(texts.withColumn("calibrates", calibrates), lexicon, "text", ["doc_id", "toxic", "calibrates"]).orderBy("doc_id", "features").toArrow()
    y, apart = rows.column("toxic").to_numpy().astype(float), np.array(rows.column("calibrates").to_pylist(), bool)
    share = float(y.mean()) if len(y) else 0.0
    if not 0 < share < 1 or not 0 < y[~apart].sum() < (~apart).sum() or not 0 < y[apart].sum() < apart.sum():
        return Model(lexicon, 0.0, (), np.zeros(1), np.array([share]))
    x = np.array(rows.column("features").to_pylist())
    start, trees = boost(x[~apart], y[~apart])
    model = Model(lexicon, start, trees, np.zeros(1), np.zeros(1))
    return Model(lexicon, start, trees, *isotonic(model.raw(x[apart]), y[apart]))


def with_features(df: DataFrame, lexicon: frozenset[str], text_col: str, keep: list[str]) -> DataFrame:
    def make() -> Callable[[list[str]], list[list]]:
        stems = Stems(lexicon)
        return lambda texts: [[measure(t, stems) for t in texts]]

    return map_text(df, text_col, keep, [field("features", T.ArrayType(DOUBLE))], make)


def score_texts(df: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns and the ``score`` of every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[list[str]], list[list]]:
        held = shared.value
        stems = Stems(held.lexicon)

        def compute(texts: list[str]) -> list[list]:
            return [held.score(np.array([measure(t, stems) for t in texts])).tolist() if texts else []]

        return compute

    return map_text(df, text_col, keep if keep is not None else ["doc_id"], [field("score", DOUBLE)], make)
