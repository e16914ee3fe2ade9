"""J3 + C1-C19: category membership join and channel classification."""

from __future__ import annotations

from pyspark.sql import DataFrame

from touchpath.functions.channels import CATEGORIES, channel_group
from touchpath.session import broadcast_if_small
from touchpath.sources.categories import source_flags

FLAG_COLUMNS = list(CATEGORIES)


def with_category_flags(origins: DataFrame, categories: DataFrame, broadcast_max_rows: int = 100_000) -> DataFrame:
    """Left join the per-source category flags.

    The flag table has one row per listed source, so its size is bounded by
    the category table's row count; that count is checked against
    ``broadcast_max_rows`` before broadcasting, otherwise the join is shuffled
    like any other.
    """
    flags = broadcast_if_small(source_flags(categories), broadcast_max_rows, bound_by=categories)
    return origins.join(flags, "source", "left")


def classify_channels(origins: DataFrame, categories: DataFrame, broadcast_max_rows: int = 100_000) -> DataFrame:
    """Origins + ``channel_group`` (sessions_channels_base)."""
    flagged = with_category_flags(origins, categories, broadcast_max_rows)
    return flagged.withColumn("channel_group", channel_group()).drop(*FLAG_COLUMNS)
