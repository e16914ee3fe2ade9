"""SimHash near-duplicates with vantage-point trees.

Fingerprints of equal texts collapse first, so a group of copies is one point.
A vantage-point tree over a bounded sample deals the distinct fingerprints into
shards: at each node a point goes to the near side if its Hamming distance to
the vantage is at most the radius, else to the far side. By the triangle
inequality, of two points within ``bits`` of each other that a node parts, the
near one lies within ``bits`` of the radius; such boundary points are dealt to
the far side as well, so every linked pair meets in the far point's home shard.
Inside a shard the same tree goes on until a handful of points is left, whose
distances are all taken. A shard reports a spanning forest of its links, never
all pairs, and components grow from the forests by star contraction.

Defined results: null and empty texts have fingerprint zero and link like any
other; texts of fewer words than a shingle are one shingle; repeated rows share
a fingerprint; rows that share an id are one document with several fingerprints
and each row keeps its own; a component's id is its smallest non-null doc_id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpath.llm.common import LONG, field, map_text, stage

SEED = 42  # of XXH64, part of the fingerprint's definition
SAMPLE = 65_536  # fingerprints that shape the tree above the shards
SHARD = 96  # sampled fingerprints in a shard
LEAF = 256  # points of a shard whose distances are all taken

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)  # value, bit


def fingerprint(text: str, words_in_shingle: int = 3) -> int:
    """Signed 64-bit SimHash: a bit is 1 if set in over half the shingle hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, k = b" ".join(words), min(words_in_shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:len(words) - k].tolist()]
    stops = (ends[k - 1:] - 1).tolist()
    hashed = xxhash.xxh64_intdigest
    h = np.fromiter([hashed(joined[a:b], SEED) for a, b in zip(starts, stops)], dtype=np.uint64, count=len(stops))
    lanes = h.view(np.uint8).reshape(-1, 8)  # little-endian bytes
    ones = np.concatenate([np.bincount(lanes[:, b], minlength=256) @ _BITS for b in range(8)])
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.int64)[0])


def fingerprints(df: DataFrame, text_col: str = "text", keep: list[str] | None = None, words_in_shingle: int = 3) -> DataFrame:
    """``keep`` columns and ``fp``, the signed fingerprint of the whole text."""

    def make() -> Callable[[list[str]], list[list]]:
        return lambda texts: [[fingerprint(t, words_in_shingle) for t in texts]]

    return map_text(df, text_col, keep if keep is not None else ["doc_id"], [field("fp", LONG)], make)


def _cut(points: np.ndarray, bits: int) -> tuple[np.uint64, int] | None:
    """Vantage and radius that leave the fewest distances to take on both sides; None if that saves little.

    A few vantages are tried: points of the set, and a far corner.
    """
    best, n = None, len(points)
    picks = points[np.linspace(0, n - 1, 6).astype(int)]
    for vantage in [*picks, ~picks[0]]:
        near = np.cumsum(np.bincount(np.bitwise_count(points ^ vantage), minlength=65)).astype(float)
        far = n - np.concatenate([np.zeros(bits), near[:-bits]]) if bits else n - near  # with the boundary points
        work = near**2 + far**2
        radius = int(work.argmin())
        if near[radius] < n and (best is None or work[radius] < best[0]):
            best = work[radius], vantage, radius
    return best[1:] if best and best[0] < 0.9 * n * n else None


def grow(points: np.ndarray, bits: int, leaf: int) -> list[tuple[int, int, int, int]]:
    """Nodes (vantage, radius, near, far); a child below 0 is shard ``-child - 1``."""
    nodes: list[list[int]] = []
    shards = 0

    def child(part: np.ndarray) -> int:
        nonlocal shards
        cut = _cut(part, bits) if len(part) > leaf else None
        if cut is None:
            shards += 1
            return -shards
        at = len(nodes)
        nodes.append([int(cut[0]), cut[1], 0, 0])
        distance = np.bitwise_count(part ^ cut[0])
        nodes[at][2:] = child(part[distance <= cut[1]]), child(part[distance > cut[1]])
        return at

    child(points)
    return [tuple(n) for n in nodes]


def deal(points: np.ndarray, nodes: list[tuple[int, int, int, int]], bits: int) -> list[tuple[int, np.ndarray]]:
    """(shard, positions of its points): home shards and, for boundary points, the far sides they reach."""
    if not nodes:
        return [(0, np.arange(len(points)))]
    out, work = [], [(0, np.arange(len(points)))]
    while work:
        at, which = work.pop()
        if not len(which):
            continue
        if at < 0:
            out.append((-at - 1, which))
            continue
        vantage, radius, near, far = nodes[at]
        distance = np.bitwise_count(points[which] ^ np.uint64(vantage)).astype(np.int64)
        work.append((near, which[distance <= radius]))
        work.append((far, which[distance > radius - bits]))
    return out


def linked_pairs(points: np.ndarray, bits: int) -> Iterable[tuple[np.ndarray, np.ndarray]]:
    """All pairs of distinct ``points`` within ``bits``, as positions, in pieces; a pair may come twice."""
    work = [np.arange(len(points))]
    while work:
        which = work.pop()
        part = points[which]
        cut = _cut(part, bits) if len(part) > LEAF else None
        if cut is not None:
            distance = np.bitwise_count(part ^ cut[0]).astype(np.int64)
            work += [which[distance <= cut[1]], which[distance > cut[1] - bits]]
            continue
        block = max(1, (1 << 21) // max(len(part), 1))
        for a in range(0, len(part), block):
            i, j = np.nonzero(np.bitwise_count(part[a:a + block, None] ^ part[None, :]) <= bits)
            upper = i + a < j
            yield which[i[upper] + a], which[j[upper]]


def forest(points: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """(root, point) positions: each point that links to others, with the first point of its group."""
    up = list(range(len(points)))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for i, j in linked_pairs(points, bits):
        for a, b in zip(i.tolist(), j.tolist()):
            a, b = root(a), root(b)
            if a != b:
                up[max(a, b)] = min(a, b)
    return [(r, x) for x in range(len(points)) if (r := root(x)) != x]


def links(points: DataFrame, bits: int) -> DataFrame:
    """(a, b): fingerprints of one component, enough links to connect each; ``points`` has distinct ``fp``."""
    spark = points.sparkSession
    share = min(1.0, 0.9 * SAMPLE / max(points.count(), 1))  # by hash before the limit, so no task sends more than its part
    drawn = points.select("fp").where(F.pmod(F.xxhash64("fp"), F.lit(1 << 40)) < int(share * (1 << 40))).limit(SAMPLE)
    sample = drawn.toPandas()["fp"].to_numpy(dtype=np.int64).view(np.uint64)
    nodes = grow(np.sort(sample), bits, SHARD)
    tree = spark.sparkContext.broadcast(nodes)  # at most SAMPLE nodes

    def to_shards(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            dealt = deal(fp.view(np.uint64), tree.value, bits)
            shard = np.repeat([s for s, _ in dealt], [len(w) for _, w in dealt])
            which = np.concatenate([w for _, w in dealt]) if dealt else np.zeros(0, dtype=int)
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), pa.array(fp[which], pa.int64())], names=["shard", "fp"])

    def in_shard(part: pd.DataFrame) -> pd.DataFrame:
        fp = np.sort(part["fp"].to_numpy(dtype=np.int64))
        found = np.array(forest(fp.view(np.uint64), bits), dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": fp[found[:, 0]], "b": fp[found[:, 1]]})

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # named, as a shard's work isn't seen in its bytes
    sharded = points.select("fp").mapInArrow(to_shards, "shard long, fp long").repartition(parts, "shard")
    return sharded.groupBy("shard").applyInPandas(in_shard, "a long, b long").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), root the smallest node of its component.

    Alternating star contraction: large stars hang each larger neighbour on the
    smallest one, small stars each smaller neighbour; both keep connectivity and
    stop when every node hangs on its root. Each round is written, so lineage
    stays short.
    """
    e = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), name)
    before = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, name)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        e = stage(small.where("u != v").distinct(), name)
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v"), F.col("v")).distinct())


def near_duplicates(df: DataFrame, text_col: str = "text", words_in_shingle: int = 3, bits: int = 2) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable by links) for every row."""
    docs = stage(fingerprints(df, text_col, ["doc_id"], words_in_shingle), "fingerprints")
    points = stage(docs.groupBy("fp").agg(F.min("doc_id").alias("first")), "points")
    groups = components(stage(links(points, bits), "links"))
    ids = (points.join(groups.withColumnRenamed("node", "fp"), "fp").groupBy("root").agg(F.min("first").alias("component_id"))
           .join(groups, "root").select(F.col("node").alias("fp"), "component_id"))
    ids = points.join(ids, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id"))
    return docs.join(ids, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def representatives(docs: DataFrame, text_col: str = "text", words_in_shingle: int = 3, bits: int = 2) -> DataFrame:
    """``docs`` with one row of each component: the first by doc_id (nulls last), fingerprint, hash of the text and of the row.

    Rows meet their component by fingerprint, so neither null nor repeated ids bring components together.
    """
    known = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    row_hash = F.xxhash64(*known, *[c.isNull() for c in known])  # a null alone leaves the hash as it is
    text = F.col(f"`{text_col}`")
    marked = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), row_hash.alias("row_hash"), text.alias("__text"))
    found = stage(fingerprints(marked, "__text", ["doc_id", "text_hash", "row_hash"], words_in_shingle), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "text_hash", "row_hash")
    equal = found.groupBy("doc_id", "fp", "text_hash", "row_hash").count()
    points = stage(equal.groupBy("fp").agg(F.min(F.struct(order.alias("row"), "count")).alias("first")), "points")
    groups = components(stage(links(points, bits), "links"))
    chosen = (points.join(groups.withColumnRenamed("node", "fp"), "fp", "left")
              .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first")))
    chosen = stage(chosen.select(F.col("first.row.doc_id").alias("__id"), F.col("first.row.row_hash").alias("__row"),
                                 (F.col("first.count") > 1).alias("__again")), "representatives")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (row_hash == F.col("__row"))
    once = docs.join(chosen.where("not __again"), same, "left_semi")
    if not chosen.where("__again").limit(1).count():
        return once
    again = docs.join(chosen.where("__again"), same).dropDuplicates(["__id", "__row"])  # rows equal in all columns
    return once.union(again.select(*[F.col(f"`{c}`") for c in docs.columns]))
