"""Weekly media recap by rolling year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchpath.config import MediaChannel, MediaConfig

# Split suffix -> metric name, and the out-of-scope label.
SPLIT_METRICS = {"grp": "grps", "lea": "leads", "imp": "impressions", "cli": "clicks",
                 "app": "appointments", "num": "number", "inv": "cost"}
OUT_OF_SCOPE = "oos"
TOTAL_LABEL = "TOT"


def rolling_year_expr(date_col: Column, years) -> Column:
    """P20: label of the first inclusive (start, end) range containing the date, else 'oos'."""
    expr = None
    for label, start, end in years:
        cond = date_col.between(F.lit(start), F.lit(end))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(OUT_OF_SCOPE) if expr is None else expr.otherwise(F.lit(OUT_OF_SCOPE))


def year_number(label: Column) -> Column:
    """First digit run of the label as INT; NULL for 'oos' (D16)."""
    return F.regexp_extract(label, r"\d+", 0).try_cast("int")


def with_rolling_year(weekly: DataFrame, cfg: MediaConfig) -> DataFrame:
    """F9 + P20 + P21 + F10: perimeter filter, year label and number, 'oos' dropped."""
    d = F.col(cfg.date_col)
    labelled = (weekly.where(d.between(F.lit(cfg.perimeter[0]), F.lit(cfg.perimeter[1])))
                .withColumn("year_rolling", rolling_year_expr(d, cfg.years)))
    return (labelled.where(F.col("year_rolling") != OUT_OF_SCOPE)
            .withColumn("year_nr", year_number(F.col("year_rolling"))))


def _metric(column: str) -> str:
    """Metric name from a ``<prefix>_<subchannel>_<split>`` column (last suffix wins)."""
    suffix = column.rpartition("_")[2]
    if suffix not in SPLIT_METRICS:
        raise ValueError(f"no known split suffix in column '{column}'")
    return SPLIT_METRICS[suffix]


# How labels and cost columns are named.
def split_label(subchannel: str) -> str:
    """``'con_tv'`` -> ``'CON TV'``."""
    return " ".join(subchannel.upper().split("_"))


def channel_totals(weekly: DataFrame, channel: MediaChannel) -> DataFrame:
    """O4 + A13: stack subchannels to long form and sum per (year_rolling, split)."""
    first = channel.subchannels[0]
    metrics = [_metric(f"{channel.prefix}_{first}_{s}") for s in channel.splits]
    if "cost" not in metrics:
        raise ValueError(f"channel '{channel.name}' has no 'inv' split, cost per unit is undefined (D27)")
    missing = [f"{channel.prefix}_{sub}_{s}" for sub in channel.subchannels for s in channel.splits
               if f"{channel.prefix}_{sub}_{s}" not in weekly.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    # One array of per-subchannel structs, exploded: a single pass over the weeks.
    parts = F.array(*[
        F.struct(F.lit(split_label(sub)).alias("split"),
                 *[F.col(f"{channel.prefix}_{sub}_{s}").cast("double").alias(_metric(f"{channel.prefix}_{sub}_{s}"))
                   for s in channel.splits])
        for sub in channel.subchannels])
    long = weekly.select("year_rolling", "year_nr", F.inline(parts))
    return long.groupBy("year_rolling", "year_nr", "split").agg(*[F.sum(m).alias(m) for m in metrics])


def is_total_split(split: Column) -> Column:
    """F12 (D15 fixed): the total row is 'TOT' or starts with 'TOT '."""
    return (split == TOTAL_LABEL) | split.startswith(TOTAL_LABEL + " ")


def cost_per_unit_name(metric: str) -> str:
    return "cost_per_" + metric.removesuffix("s")


def channel_recap(weekly: DataFrame, channel: MediaChannel) -> DataFrame:
    """P24-P26 + J8 + J9: totals, share of the total row, cost per unit and its y/y change.

    The recap has one row per (year, split), so the two windows (previous year
    per split, total row per year) run on a few dozen rows. The previous year
    is looked up by year number (RANGE 1 PRECEDING), so a missing year gives
    NULL rather than the row before it.
    """
    totals = channel_totals(weekly, channel)
    metrics = sorted(c for c in totals.columns if c in SPLIT_METRICS.values())
    prev = Window.partitionBy("split").orderBy("year_nr").rangeBetween(-1, -1)
    year = Window.partitionBy("year_rolling")
    cols = [F.col("year_rolling"), F.col("split")]
    for m in metrics:
        total_row = F.max(F.when(is_total_split(F.col("split")), F.col(m))).over(year)
        cols += [F.col(m), F.try_divide(F.col(m), total_row).alias(f"{m}_perc")]
    cpu = {}
    for m in metrics:
        if m != "cost":
            cpu[cost_per_unit_name(m)] = F.try_divide(F.col("cost"), F.col(m))
    cols += [c.alias(n) for n, c in cpu.items()]
    for n, c in cpu.items():
        cols.append((F.try_divide(c, F.first(c).over(prev)) - 1).alias(f"{n}_yoy"))
    return totals.select(*cols)


def media_recap(weekly: DataFrame, cfg: MediaConfig) -> dict[str, DataFrame]:
    """Entry 4: one recap per configured channel (sheet name -> DataFrame), sorted.

    The sort is over a few dozen recap rows, for the report only.
    """
    prepared = with_rolling_year(weekly, cfg)
    return {ch.name: channel_recap(prepared, ch).orderBy("year_rolling", "split") for ch in cfg.channels}
