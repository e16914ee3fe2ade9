"""S3, S6, S7, S9 (+ P12): writers. All writes are distributed Spark writes, seen by readers in one step (``versioned``)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpath.sinks.versioned import commit, read_current


def create_or_replace(df: DataFrame, path: str, sort_within: list[str] | None = None) -> None:
    """S3 (+ O1): full refresh of a table; optional per-file sort, no global sort."""
    commit(df.sortWithinPartitions(*sort_within) if sort_within else df, path)


def write_chains(chains: DataFrame, path: str) -> None:
    """Preprocessed chains as Parquet; the chain stays a native array column."""
    commit(chains, path)


def write_results(df: DataFrame, path: str, run_date: dt.date, mode: str = "append", run_id: str | None = None) -> None:
    """S7 + P12: stamp ``_run_date`` and add the run to the table.

    ``append`` adds a run (a ``run_id`` that is there already is replaced, so a
    retry changes nothing), ``replace_day`` replaces all runs of ``run_date``,
    ``truncate`` replaces the whole table.
    """
    keep = {"append": lambda e: e.run_id != run_id, "replace_day": lambda e: e.run_date != run_date, "truncate": lambda e: False}
    if mode not in keep:
        raise ValueError("mode must be 'append', 'replace_day' or 'truncate'")
    run_id = run_id or uuid.uuid4().hex
    commit(df.withColumn("_run_date", F.lit(run_date)), path, run_date, run_id, keep[mode])


def table_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """(rows, columns) of a written table, for the run's log."""
    table = read_current(spark, path)
    return table.count(), len(table.columns)


def write_report(sheets: dict[str, DataFrame], directory: str, fmt: str = "parquet") -> dict[str, str]:
    """One dataset directory per sheet (sheet contents only; no workbook formatting)."""
    paths = {}
    for name, df in sheets.items():
        p = f"{directory.rstrip('/')}/{'_'.join(name.split())}"
        w = df.write.mode("overwrite")
        if fmt == "csv":
            w = w.option("header", True)
        w.format(fmt).save(p)
        paths[name] = p
    return paths
