"""Exact medians without gathering a group into one task, as one lazy plan.

``median`` keeps every value of a group in one aggregation buffer. Here two
approximate quantiles around the middle cut a group's values into three zones,
the zones' counts tell which of them hold the middle ranks (the narrow one in
between, unless the quantiles missed), and only their values are counted and
put in order. The quantiles steer the work and never the result: ranks are
counted exactly, in the value's own type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MARGIN = 0.0005  # of the ranks, on each side of the middle


def exact_medians(values: DataFrame, margin: float = MARGIN) -> DataFrame:
    """(tag, median) of ``values`` (tag, v): the middle value, or the mean of the two middle ones.

    NULL values don't count; a tag without values has no row. ``tag`` names a
    few groups: one row per tag is broadcast.
    """
    known = values.where(F.col("v").isNotNull())
    around = F.percentile_approx("v", [0.5 - margin, 0.5 + margin], int(4 / margin))
    limits = known.groupBy("tag").agg(around.alias("q")).select("tag", F.col("q")[0].alias("from"), F.col("q")[1].alias("to"))
    zoned = known.join(F.broadcast(limits), "tag").withColumn("zone", F.when(F.col("v") < F.col("from"), 0).when(F.col("v") > F.col("to"), 2).otherwise(1))
    held = [F.count(F.when(F.col("zone") == z, 1)).alias(f"n{z}") for z in (0, 1, 2)]
    low, high = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)
    start = {0: F.lit(0), 1: F.col("n0"), 2: F.col("n0") + F.col("n1")}
    zone_of = lambda rank: F.when(rank < start[1], 0).when(rank < start[2], 1).otherwise(2)
    middle = (zoned.groupBy("tag").agg(*held).withColumn("n", F.col("n0") + F.col("n1") + F.col("n2"))
              .withColumns({"low": low, "high": high, "first": zone_of(low), "last": zone_of(high)})
              .select("tag", "low", "high", "first", "last", F.when(F.col("first") == 0, start[0]).when(F.col("first") == 1, start[1]).otherwise(start[2])
                      .alias("before")))
    counted = (zoned.join(F.broadcast(middle), "tag").where((F.col("zone") >= F.col("first")) & (F.col("zone") <= F.col("last")))
               .groupBy("tag", "v", "low", "high", "before").agg(F.count(F.lit(1)).alias("c")))
    upto = F.col("before") + F.sum("c").over(Window.partitionBy("tag").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counted.withColumn("upto", upto)

    def at(rank: str):
        return F.max(F.when((F.col("upto") - F.col("c") <= F.col(rank)) & (F.col("upto") > F.col(rank)), F.col("v"))).cast("double")

    return ranked.groupBy("tag").agg(((at("low") + at("high")) / 2).alias("median"))
