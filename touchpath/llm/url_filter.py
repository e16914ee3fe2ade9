"""URL filter: allow/block rules first, else logistic regression on hashed character n-grams.

Host and path are cut from the url with column expressions. A rule fits its host
and every subdomain if the path starts with the rule's path; the longest fitting
rule (host and path together, then the longer host) decides. For the other urls
a logistic regression over hashed 3- to 5-grams of ``host`` and ``path`` decides;
it is trained from a small labelled url table, of which ``max_train_rows`` rows
(smallest url hashes) are read, so the driver holds a bounded sample.

Defined results: a null url, or one without ``://``, has an empty host and path,
fits no rule, scores 0 and is allowed; repeated rows give repeated results;
urls of any length are scored whole; without training rows every url that no
rule fits is allowed.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpath.llm.common import DOUBLE, STRING, field, map_text

Rule = tuple[str, str, str]  # host, path, "allow" or "block"
SLOTS = 1 << 14  # weights of the model: its size does not depend on the data
THRESHOLD = 0.7  # block from this probability on: a wrong block costs more than a missed one
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Labelled names, the seed of the training table: host label or path word -> block (1) or allow (0).
BLOCKED_NAMES = """casino poker slots jackpot roulette bets bet-now betting sportsbook gambling lottery casino-bonus free-spins pills
pills-online viagra pharmacy-deal cheap-meds cheap-tabs adult adult-cams xxx porn sex-chat escort-dates spam spam-links link-farm
ads ads-click ad-server tracker-pixel track-ads popunder malware-download crack-keygen warez-free phish-login payday-loans
quick-cash replica-watches cheap-rolex free-followers miracle-diet hot-singles win-prize free-money win-now""".split()
ALLOWED_NAMES = """news weather science history library museum university school recipes garden travel music sports health
journal research encyclopedia forum support docs developer community council parliament theatre books cinema camera
bicycle mountain river forest energy climate railway airport hospital kitchen market football chess astronomy biology
chemistry physics mathematics grammar language translate archive gallery orchestra bakery bridge the-times daily-post
window trade exact context textile express additional address pillar expert betty tibet alphabet winter winner""".split()


#: How a labelled word stands in names, the same for both labels.
NAME_FORMS = ("%s", "%ss", "best-%s", "%s-online", "%s24", "my%s", "%shub", "the-%s", "%s-club", "top%s")


def labelled_names(spark: SparkSession) -> DataFrame:
    """(stem, name, blocked): every labelled word in every form."""
    stems = F.explode(F.array(*[F.struct(F.lit(n).alias("stem"), F.lit(b).alias("blocked"))
                                for part, b in ((BLOCKED_NAMES, 1), (ALLOWED_NAMES, 0)) for n in part])).alias("s")
    forms = F.explode(F.array(*[F.lit(f) for f in NAME_FORMS])).alias("form")
    return spark.range(1).select(stems).select("s.*", forms).select("stem", F.replace("form", F.lit("%s"), F.col("stem")).alias("name"), "blocked")


def seed_table(spark: SparkSession) -> DataFrame:
    """Labelled url table (url, blocked, name, stem) of some 4,500 rows: each name in half of the url shapes."""
    shapes = [F.array(F.lit("https://www.%s.example.com/en/12"), F.lit("http://blog.%s.org/es/890"), F.lit("https://site.example.net/%s/index.html")),
              F.array(F.lit("http://%s.example.org/de/345.html"), F.lit("https://m.%s.example.net/fr/67/"), F.lit("https://www.%s.com/"))]
    some = F.when(F.pmod(F.xxhash64("name"), F.lit(2)) == 0, shapes[0]).otherwise(shapes[1])
    return (labelled_names(spark).withColumn("shape", F.explode(some))
            .select(F.replace("shape", F.lit("%s"), F.col("name")).alias("url"), "blocked", "name", "stem"))


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    cut = r"(?s)\A.*?://([^/?#]*+)([^?#]*+)"
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, cut, 1), UPPER, LOWER), F.regexp_extract(text, cut, 2)


def grams(host: str, path: str) -> np.ndarray:
    """Slots of the hashed n-grams of the host's labels and the path's words, each slot once."""
    labels = [f"h:{x}" for x in host.split(".")]
    words = [f"p:{x}" for x in path.split("/") if x]
    out = set()
    for text in labels + words:
        mark, text = text[:2], f"^{text[2:].lower()}$"
        for n in (3, 4, 5):
            out.update(zlib.crc32((mark + text[i:i + n]).encode("utf-8", "surrogatepass")) % SLOTS for i in range(len(text) - n + 1))
    return np.fromiter(sorted(out), dtype=np.int64, count=len(out))


def train(labelled: DataFrame, max_train_rows: int = 5_000, rounds: int = 600, rate: float = 30.0, decay: float = 2e-5) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch gradient descent; deterministic for a given table."""
    host, path = host_path(F.col("url"))
    rows = (labelled.where(F.col("blocked").isNotNull()).select(host.alias("h"), path.alias("p"), "blocked", F.xxhash64("url").alias("k"))
            .orderBy("k", "h", "p").limit(max_train_rows).collect())
    weights, bias = np.zeros(SLOTS), 0.0
    if not rows:
        return weights, -20.0
    found = [grams(r.h, r.p) for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(f) for f in found])
    slot = np.concatenate(found)
    scale = 1 / np.sqrt(np.maximum([len(f) for f in found], 1))  # long urls don't weigh more
    y = np.array([r.blocked for r in rows], dtype=float)
    for _ in range(rounds):
        z = np.bincount(row, weights[slot], len(rows)) * scale + bias
        error = (1 / (1 + np.exp(-z)) - y) / len(rows)
        weights -= rate * (np.bincount(slot, (error * scale)[row], SLOTS) + decay * weights)
        bias -= rate * error.sum()
    return weights, float(bias)


def fitting_rule(host: str, path: str, rules: dict[str, list[tuple[str, str, str]]]) -> tuple[str, str] | None:
    """(rule, verdict) of the longest fitting rule."""
    best, at = None, 0
    while True:
        name = host[at:]
        for start, text, verdict in rules.get(name, ()):
            if path.startswith(start) and (best is None or (len(text), len(name)) > best[0]):
                best = (len(text), len(name)), (text, verdict)
        dot = host.find(".", at)
        if dot < 0:
            return best[1] if best else None
        at = dot + 1


def judge_urls(df: DataFrame, rules: list[Rule], model: tuple[np.ndarray, float], url_col: str = "url",
               keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, ``host``, ``path``, ``rule`` (null if none), ``verdict`` and ``block_score``."""
    keep = keep if keep is not None else ["page_id"]
    host, path = host_path(F.col(url_col))
    table: dict[str, list[tuple[str, str, str]]] = {}
    for h, p, verdict in rules:
        table.setdefault(h.translate(str.maketrans(UPPER, LOWER)), []).append((p, h + p, verdict))
    weights, bias = model

    def make() -> Callable[[list[str]], list[list]]:
        def compute(pairs: list[str]) -> list[list]:
            hosts, paths, names, verdicts, scores = [], [], [], [], []
            for pair in pairs:
                at = pair.find("/")  # a host holds none, a path starts with one
                h, p = (pair[:at], pair[at:]) if at >= 0 else (pair, "")
                slots = grams(h, p)
                z = weights[slots].sum() / max(len(slots), 1) ** 0.5 + bias
                score = float(1 / (1 + np.exp(-np.clip(z, -500, 500)))) if h else 0.0
                name, verdict = fitting_rule(h, p, table) or (None, "block" if score >= THRESHOLD else "allow")
                for out, value in zip((hosts, paths, names, verdicts, scores), (h, p, name, verdict, score)):
                    out.append(value)
            return [hosts, paths, names, verdicts, scores]

        return compute

    cut = df.select(*keep, F.concat(host, path).alias("__pair"))
    fields = [field("host", STRING), field("path", STRING), field("rule", STRING), field("verdict", STRING), field("block_score", DOUBLE)]
    return map_text(cut, "__pair", keep, fields, make)
