"""Source-category dimension (T2) and its derived forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpath.functions.channels import CATEGORIES
from touchpath.schemas import SOURCE_CATEGORIES


def read_source_categories(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header ``category,sources`` (one source per row)."""
    return spark.read.csv(path, header=True, schema=SOURCE_CATEGORIES, escape='"')


def source_category_lists(categories: DataFrame) -> DataFrame:
    """A1: one row per category with its sorted source list."""
    return (categories.groupBy("category")
            .agg(F.array_sort(F.collect_list("sources")).alias("sources_list")))


def source_flags(categories: DataFrame) -> DataFrame:
    """One row per source with four membership flags.

    Replaces the eight correlated ``source IN UNNEST(list)`` subqueries by a
    single equi-join key; a source listed under several categories gets
    several true flags and still one row.
    """
    aggs = [F.max(F.col("category") == F.lit(cat)).alias(flag) for flag, cat in CATEGORIES.items()]
    return (categories.where(F.col("sources").isNotNull())
            .groupBy(F.col("sources").alias("source")).agg(*aggs))
