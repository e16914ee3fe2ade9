"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source with target T and size S is due T/S copies: the whole
part at once, the fraction by rounding. Fractions of a source are rounded in
pairs: mass (fraction times words) moves from one to the other, up or down with
the chances that keep each expectation, until one of the two is 0 or 1; the
other goes on. Documents meet in blocks of about ``fan`` and each block leaves
one residual, which meets the residuals of ``fan`` blocks at the next level, so
a source of any size is a tree of small groups and no task sees a whole source.
A pair's mass is kept, so the words taken of a source stay at its target. The
one unit of a source that is still a fraction at the root is taken in part: that
share of its words.

Only column expressions are used. Chances come from hashes of the documents, so
reruns agree.

Defined results: a null or empty text has size 0 and is taken 0 times its
words; null sources are one source, last in order; rows that repeat a source, id and
size are one unit: its whole copies are dealt over its rows at once and only one
of them can be left as a fraction, so a unit of any number of rows moves the mix
by less than one document; an empty table gives an empty result; null ids are
rows like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchpath.llm.common import WORD, stage
from touchpath.session import broadcast_if_small

MAX_BROADCAST_SOURCES = 50_000
REPEATS = 65_536  # rows of one repeated unit that one task writes
RESULT = ["doc_id", "size", "source_size", "target", "taken"]


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(units: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """source, source_size, target: ``share`` of all words dealt by weight, none above ``most`` times its source.

    ``units`` has source, size and rows. Works on one row per source (the rank of a source needs all
    of them in order). Sources are capped in the order of cap to
    weight; the level that the rest reaches is the largest over that order.
    """
    totals = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count(F.lit(1)).alias("n_units"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (totals.withColumn("weight", F.element_at(cycle, (F.pmod(F.row_number().over(named) - 1, F.lit(len(weights))) + 1).cast("int")))
              .withColumn("cap", F.col("source_size") * F.lit(float(most))))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after, every = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    left = F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = ranked.withColumn("level", left / F.sum("weight").over(after)).withColumn("level", F.max("level").over(every))
    return level.select("source", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"), "n_units")


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), then)[0]


def _meet(i: Column, x: Column, seed: int) -> Column:
    """The two after one transfer: struct(i, x), at least one of them 0 or 1."""
    room_i, mass_i = i["a"] * (1 - i["p"]), i["a"] * i["p"]
    room_x, mass_x = x["a"] * (1 - x["p"]), x["a"] * x["p"]
    up, down = F.least(room_i, mass_x), F.least(mass_i, room_x)
    chance = F.pmod(F.xxhash64(F.lit(seed), i["k"], x["k"]), F.lit(1 << 53)) / F.lit(float(1 << 53))

    def moved(t: Column) -> Column:
        to = lambda y, p: F.struct(*[p.alias("p") if f == "p" else y[f].alias(f) for f in ITEM])
        pi = (F.when(t["rise"], F.when(room_i <= mass_x, F.lit(1.0)).otherwise(i["p"] + t["up"] / i["a"]))
              .otherwise(F.when(mass_i <= room_x, F.lit(0.0)).otherwise(i["p"] - t["down"] / i["a"])))
        px = (F.when(t["rise"], F.when(mass_x <= room_i, F.lit(0.0)).otherwise(x["p"] - t["up"] / x["a"]))
              .otherwise(F.when(room_x <= mass_i, F.lit(1.0)).otherwise(x["p"] + t["down"] / x["a"])))
        return F.struct(to(i, pi).alias("i"), to(x, px).alias("x"))

    return _let(F.struct(up.alias("up"), down.alias("down"), (chance * (up + down) < down).alias("rise")), moved)


#: An undecided row: order key, id, words, mass at fraction 1, fraction.
ITEM = ("k", "doc_id", "size", "a", "p")


def _round_block(items: Column, seed: int) -> Column:
    """struct(last, done): the units of a block after pairing them one after another."""
    decided = lambda y: F.array(y)
    open_ = lambda y: (y["p"] > 0) & (y["p"] < 1)

    def step(acc: Column, x: Column) -> Column:
        def after(t: Column) -> Column:
            i_done = ~open_(t["i"])
            return F.struct(F.when(i_done, t["x"]).otherwise(t["i"]).alias("last"),
                            F.concat(acc["done"], decided(F.when(i_done, t["i"]).otherwise(t["x"]))).alias("done"))

        met = _let(_meet(acc["last"], x, seed), after)
        passed = F.struct(x.alias("last"), F.concat(acc["done"], decided(acc["last"])).alias("done"))
        return F.when(open_(acc["last"]), met).otherwise(passed)

    start = F.struct(items[0].alias("last"), F.slice(items, 1, 0).alias("done"))
    return F.aggregate(F.slice(items, F.lit(2), F.greatest(F.size(items) - 1, F.lit(0))), start, step)


def mix(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 20_240, fan: int = 64) -> DataFrame:
    """doc_id, size, source_size, target and taken for every row of ``sizes`` (doc_id, source, size)."""
    units = stage(sizes.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("rows")), "units")
    targets = stage(source_targets(units, weights, share, most), "targets")
    small = broadcast_if_small(targets, MAX_BROADCAST_SOURCES)
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    units = (units.join(small.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
             .withColumn("due", due).withColumn("whole", F.floor("due"))
             # copies due beyond the whole ones to all rows of the unit: full ones for some rows, a fraction for one more
             .withColumn("more", F.when(F.col("size") == 0, F.lit(0.0)).otherwise((F.col("due") - F.col("whole")) * F.col("rows")))
             .withColumn("full", F.least(F.floor("more"), F.col("rows"))).withColumn("p", F.col("more") - F.col("full"))
             .withColumn("a", F.col("size").cast("double")).withColumn("k", F.xxhash64(F.lit(seed), "doc_id", "size")))
    fixed = (F.col("p") <= 0) | (F.col("full") == F.col("rows"))
    group = ["source", "source_size", "target", "whole"]
    dealt = F.explode(F.array(F.struct(F.col("full").alias("rows"), (F.col("whole") + 1).alias("copies")),
                              F.struct((F.col("rows") - F.col("full") - F.when(fixed, 0).otherwise(1)).alias("rows"), F.col("whole").alias("copies"))))
    plain = (units.select("doc_id", "size", "source_size", "target", dealt.alias("d")).where("d.rows > 0")
             .select("doc_id", "size", F.col("d.rows").alias("rows"), "source_size", "target", (F.col("d.copies") * F.col("size")).alias("taken")))

    blocks = F.ceil(F.col("n_units") / F.lit(float(fan)))
    level = units.where(~fixed).select(*group, blocks.cast("long").alias("blocks"), F.pmod(F.col("k"), blocks).cast("long").alias("block"),
                                       F.struct(*ITEM).alias("item"))
    most_blocks = targets.agg(F.max(blocks)).first()[0] or 0
    parts, depth = [plain], 0
    while most_blocks > 0:
        depth += 1
        met = level.groupBy(*group, "blocks", "block").agg(F.sort_array(F.collect_list("item")).alias("items"))
        met = stage(met.select(*group, "blocks", "block", _round_block(F.col("items"), seed + depth).alias("r")), f"mix-{depth}")
        parts.append(_taken(met.select(*group, F.explode("r.done").alias("u")), F.col("u.p")))
        last = met.select(*group, "blocks", "block", F.col("r.last").alias("item"))
        if most_blocks == 1:  # one unit of each source is left: its fraction is taken of its words
            parts.append(_taken(last.withColumnRenamed("item", "u"), F.col("u.p")))
        most_blocks = 0 if most_blocks == 1 else -(-most_blocks // fan)
        level = last.withColumn("block", F.floor(F.col("block") / F.lit(fan))).withColumn("blocks", F.ceil(F.col("blocks") / F.lit(float(fan))).cast("long"))
    taken = parts[0]
    for part in parts[1:]:
        taken = taken.unionByName(part)
    return _rows(taken)


def _rows(counted: DataFrame) -> DataFrame:
    """Every row of its ``rows``; a unit of very many rows is written by several tasks."""
    def times(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(1), n.cast("int")))

    few = counted.where(F.col("rows") <= REPEATS).withColumn("row", times(F.col("rows")))
    part = F.explode(F.sequence(F.lit(0), F.floor((F.col("rows") - 1) / F.lit(REPEATS)).cast("int")))
    many = (counted.where(F.col("rows") > REPEATS).withColumn("part", part).repartition("doc_id", "size", "taken", "part")
            .withColumn("row", times(F.least(F.lit(REPEATS), F.col("rows") - F.col("part").cast("long") * REPEATS))))
    return few.select(*RESULT).union(many.select(*RESULT))


def _taken(decided: DataFrame, copy: Column) -> DataFrame:
    words = F.round((F.col("whole") + copy) * F.col("u.size")).cast("long")
    return decided.select(F.col("u.doc_id").alias("doc_id"), F.col("u.size").alias("size"), F.lit(1).cast("long").alias("rows"), "source_size", "target",
                          words.alias("taken"))


def mix_documents(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mix of all documents: doc_id, size, source_size, target, taken."""
    sizes = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))
    return mix(sizes, weights, share, most)
