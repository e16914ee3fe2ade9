"""Tables that change in one step.

A table is a folder with data folders and a manifest. A write goes to a data
folder of its own; then one manifest file, numbered one above the last, names
the data folders that are the table from now on. Until that file is there,
readers see the table as it was, so a write that dies half-way changes nothing,
and a run that is written twice is held once. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession

MANIFEST = "_manifest"
_ENTRY = "seq long, folder string, run_date date, run_id string"


def entries(spark: SparkSession, path: str) -> list[Row]:
    """The data folders that are the table now (seq, folder, run_date, run_id); none if it was never written."""
    try:
        held = spark.read.schema(_ENTRY).parquet(f"{path.rstrip('/')}/{MANIFEST}").collect()  # one row per run and write
    except AnalysisException:
        return []
    last = max((r.seq for r in held), default=0)
    return sorted((r for r in held if r.seq == last), key=lambda r: r.folder)


def commit(df: DataFrame, path: str, run_date=None, run_id: str | None = None, keep: Callable[[Row], bool] = lambda entry: False,
           before: Callable[[], None] = lambda: None) -> None:
    """Write ``df`` and make it, with the present data folders that ``keep`` accepts, the table.

    ``before`` runs between the write and the change; if it raises, the table stays as it was.
    """
    spark, base, folder = df.sparkSession, path.rstrip("/"), f"data-{uuid.uuid4().hex}"
    present = entries(spark, base)
    df.write.parquet(f"{base}/{folder}")
    before()
    seq = max((e.seq for e in present), default=0) + 1
    rows = [(seq, e.folder, e.run_date, e.run_id) for e in present if keep(e)] + [(seq, folder, run_date, run_id)]
    spark.createDataFrame(rows, _ENTRY).coalesce(1).write.mode("append").parquet(f"{base}/{MANIFEST}")


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The table as its newest manifest says."""
    base, held = path.rstrip("/"), entries(spark, path)
    if not held:
        raise FileNotFoundError(f"no committed table at {base}")
    return spark.read.parquet(*[f"{base}/{e.folder}" for e in held])


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Delete the data folders that the newest manifest doesn't name (left by replaced and broken writes); their names."""
    held = {e.folder for e in entries(spark, path)}
    root = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    gone = sorted(n for n in names if n.startswith("data-") and n not in held) if held else []
    for name in gone:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(root, name), True)
    return gone
