"""Table reads with normalised names, read-through cache, weekly CSV."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchpath.operators.checks import raise_violations
from touchpath.sinks.versioned import commit, entries, read_current


def normalise_name(name: str) -> str:
    """``'Session ID'`` -> ``'session_id'`` (lower case, whitespace runs -> '_')."""
    return "_".join(name.lower().split())


def normalise_columns(df: DataFrame) -> DataFrame:
    """Rename every column with ``normalise_name`` (a metadata-only projection)."""
    return df.toDF(*[normalise_name(c) for c in df.columns])


def read_table(spark: SparkSession, source: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table name or a path, with normalised column names."""
    if "/" in source or source.endswith(f".{fmt}"):
        df = spark.read.format(fmt).load(source)
    else:
        df = spark.table(source)
    return normalise_columns(df)


def fingerprint(*parts: object) -> str:
    """A digest of what a stage is made from: configurations by their repr, DataFrames by schema and input files.

    Files that Spark writes have names of their own, so a rewritten input has others.
    """
    said = [f"{p.schema.json()} {sorted(p.inputFiles())}" if isinstance(p, DataFrame) else repr(p) for p in parts]
    return hashlib.sha256("\n".join(said).encode()).hexdigest()


def materialise(spark: SparkSession, build: Callable[[], DataFrame], path: str, force: bool = False, key: str = "",
                gates: dict[str, Column] | None = None) -> DataFrame:
    """Write ``build()`` once (or when forced, or made from something else), then read it back.

    ``key`` says what the table is made from (``fingerprint``); a table of
    another key, or one whose write was interrupted, is built anew. ``gates``
    counts violations while the rows are written: if any isn't zero, the write
    fails and the table stays as it was. The written copy cuts lineage: later
    stages re-read shared storage instead of recomputing upstream stages after
    an executor loss.
    """
    held = entries(spark, path)
    if force or not held or held[0].run_id != key:
        df, check = build(), lambda: None
        if gates:
            seen = Observation(f"gates-{uuid.uuid4().hex}")
            df, check = df.observe(seen, *[c.alias(name) for name, c in gates.items()]), lambda: raise_violations(seen.get)
        commit(df, path, run_id=key, before=check)
    return read_current(spark, path)


def read_weekly_csv(spark: SparkSession, path: str, columns: list[str], date_col: str = "week_end_date",
                    date_format: str = "dd/MM/yyyy") -> DataFrame:
    """Weekly media CSV; the date column is parsed with ``date_format``, numbers as DOUBLE.

    ``columns`` are the file's columns in order (``MediaConfig.csv_columns`` gives a recap's); a
    header that differs is an error when the file is read.
    """
    schema = T.StructType([T.StructField(c, T.StringType() if c == date_col else T.DoubleType()) for c in columns])
    df = spark.read.csv(path, header=True, schema=schema, enforceSchema=False)
    return df.withColumn(date_col, F.to_date(F.col(date_col), date_format))
