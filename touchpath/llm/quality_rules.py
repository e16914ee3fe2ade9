"""Quality rules whose cutoffs are certified on labelled documents.

Every document gets a few rule values (high is suspect). Labelled documents are
split by a hash of their id. The tuning half chooses, per stratum, a cutoff for
each rule and an order of the rules, from the one that rejects the fewest good
documents on. That gives one chain of growing rule sets, and the holdout half
tests the sets in order: a set passes if the exact binomial bound of its false
rejections among good documents rules out a rate above ``risk``, and the first
that fails ends the chain. Testing in a fixed order needs no correction within a
stratum; over the strata Holm's step-down correction is applied: the stratum
with the smallest bound is tested at ``level`` divided by the number of strata,
the next at ``level`` divided by one less. So with chance ``1 - level`` no
stratum loses more than ``risk`` of its good documents to its rules.

Only counts by stratum, rule and cutoff, and by stratum and rule set, reach the
driver; their number is fixed by the parameters. All labelled documents count,
each id once: its rule values are the largest of its rows, so repeated rows are
one trial.

Defined results: null and empty texts have no words and fail the base; a
stratum other than those named is pooled as "other"; without enough labels no
cutoff passes and only the base rejects; an id labelled twice counts once, as
bad if any label says so; null ids have no label; repeated documents are judged
alike.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpath.llm.common import BOOL, DOUBLE, LONG, field, map_text, stage

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RULES = ("symbols_per_word", "shouts_per_word", "capital_words", "duplicate_lines", "repeated_words")
#: Cutoffs from strict to lenient; a document is rejected by a rule if its value is above the cutoff.
CUTOFFS = (0.01, 0.02, 0.03, 0.05, 0.08, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0, 1.5, 2.0, 3.0, 5.0)
STRATA = ("en", "de", "fr", "es")
Cutoffs = dict[str, dict[str, float]]


def repeated_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that the text holds at least twice."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=len(words))
    pair = np.unique(a[:-1] * len(ids) + a[1:], return_inverse=True)[1]  # exact for any vocabulary
    window = pair[:-1] * len(ids) + a[2:]
    inverse, counts = np.unique(window, return_inverse=True, return_counts=True)[1:]
    again = counts[inverse] > 1
    if not again.any():
        return 0
    covered = np.zeros(len(words), dtype=bool)
    for i in range(3):
        covered[i:len(words) - 2 + i] |= again
    return int(covered.sum())


def measure(text: str) -> list:
    """COUNTS, base_failed and RULES of one text."""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    chars = len(text) - sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    duplicates = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    base_failed = n < 50 or 100 * repeats > 50 * n
    per = 1 / max(n, 1)
    capitals = sum(w.isupper() and len(w) > 1 for w in words)
    return [n, chars, symbols, duplicates, repeats, base_failed, symbols * per, text.count("!") * per, capitals * per,
            duplicates / max(len(lines), 1), repeats * per]


def with_measures(df: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, the counts, ``base_failed`` and the rule values of each whole text."""

    def make() -> Callable[[list[str]], list[list]]:
        width = len(COUNTS) + 1 + len(RULES)
        return lambda texts: [list(c) for c in zip(*map(measure, texts))] or [[] for _ in range(width)]

    fields = [*[field(c, LONG) for c in COUNTS], field("base_failed", BOOL), *[field(r, DOUBLE) for r in RULES]]
    return map_text(df, text_col, keep if keep is not None else ["doc_id"], fields, make)


def stratum(lang: Column) -> Column:
    return F.when(lang.isin(*STRATA), lang).otherwise(F.lit("other"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """Exact P(X <= k) of n trials with chance p, as a regularised incomplete beta function (Lentz's continued fraction)."""
    if k >= n:
        return 1.0
    a, b, x = n - k, k + 1, 1 - p  # P(X <= k) = I_x(a, b)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta(b, a, p)
    return _beta(a, b, x)


def _beta(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    c, d = 1.0, 1 / max(1 - (a + b) * x / (a + 1), tiny)
    h = d
    for m in range(1, 100_000):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + num * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + num / c
            c = c if abs(c) > tiny else tiny
            h *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    return min(1.0, math.exp(front) * h / a)


def labelled_measures(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """(stratum, good, holdout, rule values) of every labelled id once, of its rows that pass the base."""
    judged = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return (measured.where(~F.col("base_failed")).select("doc_id", stratum(F.col("lang")).alias("stratum"), *RULES).join(judged, "doc_id")
            .groupBy("doc_id").agg(F.min("stratum").alias("stratum"), (F.first("quality") > 0).alias("good"), *[F.max(r).alias(r) for r in RULES])
            .withColumn("holdout", F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0).drop("doc_id"))


def rule_chains(tuning: DataFrame, spare: float, nearly: float) -> dict[str, list[tuple[str, float]]]:
    """Per stratum, (rule, cutoff) in the order in which they join the rule set.

    A rule's cutoff is, among those that reject at most ``spare`` of the good
    tuning documents, the most lenient that still catches nearly all bad ones
    that the strictest of them catches; a rule that catches fewer bad than it
    loses good ones isn't used. Rules that lose less come first.
    """
    grid = F.array(*[F.lit(c) for c in CUTOFFS])
    values = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("value")) for r in RULES])).alias("v")
    counted = (tuning.select("stratum", "good", values)
               .groupBy("stratum", "good", F.col("v.rule").alias("rule"), F.size(F.filter(grid, lambda c: c < F.col("v.value"))).alias("above"))
               .count().collect())
    over: dict[tuple, np.ndarray] = {}
    for r in counted:  # documents above the first r.above cutoffs; the last entry is all of them
        row = over.setdefault((r.stratum, r.rule, r.good), np.zeros(len(CUTOFFS) + 1, dtype=np.int64))
        row[len(CUTOFFS)] += r["count"]
        row[:r.above] += r["count"]
    none, out = np.zeros(len(CUTOFFS) + 1, dtype=np.int64), {}
    for s in (*STRATA, "other"):
        found = []
        for rule in RULES:
            good, bad = over.get((s, rule, True), none), over.get((s, rule, False), none)
            fair = [i for i in range(len(CUTOFFS)) if good[i] <= spare * good[-1]]
            if not fair or not bad[fair[0]]:
                continue
            chosen = max(i for i in fair if bad[i] >= nearly * bad[fair[0]])
            if bad[chosen] > good[chosen]:
                found.append((good[chosen] / max(good[-1], 1), -int(bad[chosen]), rule, CUTOFFS[chosen]))
        if found:
            out[s] = [(rule, cutoff) for _, _, rule, cutoff in sorted(found)]
    return out


def select_cutoffs(measured: DataFrame, labels: DataFrame, risk: float = 0.03, level: float = 0.05, nearly: float = 0.98) -> Cutoffs:
    """stratum -> rule -> cutoff, for the rule sets that passed.

    ``measured`` has doc_id, lang and the rule values; ``labels`` doc_id and quality (0 is bad).
    """
    judged = stage(labelled_measures(measured, labels), "labelled-measures")
    chains = rule_chains(judged.where(~F.col("holdout")), risk / 4, nearly)
    if not chains:
        return {}
    joins = F.lit(None).cast("int")  # the first rule set of its stratum that rejects a document
    for s, chain in chains.items():
        place = F.coalesce(*[F.when(F.col(rule) > F.lit(cutoff), F.lit(i)) for i, (rule, cutoff) in enumerate(chain)], F.lit(len(chain)))
        joins = F.when(F.col("stratum") == s, place).otherwise(joins)
    tested = judged.where(F.col("holdout") & F.col("good")).groupBy("stratum", joins.alias("set")).count().collect()
    bounds: dict[str, list[float]] = {}
    for s, chain in chains.items():
        counts = [sum(r["count"] for r in tested if r.stratum == s and r.set == i) for i in range(len(chain) + 1)]
        bounds[s] = [binomial_tail(int(lost), sum(counts), risk) if sum(counts) else 1.0 for lost in np.cumsum(counts[:-1])]
    out, left = {}, len(STRATA) + 1
    for s in sorted(bounds, key=lambda s: (bounds[s][0], s)):
        passed = next((i for i, b in enumerate(bounds[s]) if b > level / left), len(bounds[s]))
        if not passed:
            break  # Holm: no stratum with a larger bound passes
        out[s] = dict(chains[s][:passed])
        left -= 1
    return out


def kept(cutoffs: Cutoffs) -> Column:
    """Whether a measured document with a ``lang`` stays: false if the base or a rule of its stratum rejects it."""
    rejected = F.col("base_failed")
    for s, rules in cutoffs.items():
        fires = F.lit(False)
        for rule, cutoff in rules.items():
            fires = fires | (F.col(rule) > F.lit(cutoff))
        rejected = rejected | ((stratum(F.col("lang")) == F.lit(s)) & fires)
    return ~rejected


def filter_documents(docs: DataFrame, cutoffs: Cutoffs, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col("lang"), F.col(f"`{text_col}`"))
    return with_measures(inner, text_col, ["__row", "lang"]).where(kept(cutoffs)).select("__row.*")
