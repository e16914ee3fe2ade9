"""Session helpers: builder for local runs, checkpoint folder, checked broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "touchpath") -> SparkSession:
    """Session for tests and the benchmark; clusters bring their own session."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        # Let the JIT compile generated methods above 8000 bytes (wide fused stages).
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.executor.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for materialised stages and ``checkpoint()``.

    Uses the folder the cluster names in ``spark.checkpoint.dir``. Only a local
    session without one (tests, benchmarks) gets a fresh temporary folder; on a
    cluster a missing setting is an error, never a machine-local path.
    """
    sc = spark.sparkContext
    configured = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")
        configured = tempfile.mkdtemp(prefix="touchpath-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a stage that several branches read, as Parquet in the shared folder, and read it back.

    The copy keeps column pruning and statistics, cuts lineage, and survives a
    lost executor. A run id in its path keeps concurrent runs apart.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int, bound_by: DataFrame | None = None) -> DataFrame:
    """Broadcast hint only after proving the side has at most ``max_rows`` rows.

    ``bound_by`` is a cheaper relation with at least as many rows as ``df``
    (for example the input of a grouping), counted instead of ``df`` itself.
    Above the bound the plain DataFrame is returned and Spark falls back to a
    shuffled join.
    """
    n = (bound_by if bound_by is not None else df).limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
