"""Helpers shared by the operators: staged tables, whole-text mapping, word rules."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchpath.session import checkpoint_dir

#: Java spelling of the word rule ``[^\x20\x09-\x0D]+``; in Python, ``bytes.split()`` is the same rule.
WORD = r"[^\x20\x09-\x0D]+"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back.

    The table is readable from every executor, cuts lineage and keeps column
    pruning; a run id in the path keeps concurrent runs apart.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_text(df: DataFrame, text_col: str, keep: list[str], fields: list[T.StructField],
             make: Callable[[], Callable[[list[str]], list[list]]]) -> DataFrame:
    """Append columns computed from whole texts; ``keep`` columns pass through untouched.

    ``make()`` runs once per task and returns a function from a list of texts
    (null reads as empty) to one list of values per field. Rows stream through
    in Arrow batches, nothing is shuffled.
    """
    schema = T.StructType([df.schema[c] for c in keep] + fields)
    source = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("__text"))
    n = len(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        compute, types = make(), None
        for batch in batches:
            texts = [x if x is not None else "" for x in batch.column(n).to_pylist()]
            types = types or [_arrow(f.dataType) for f in fields]
            new = [pa.array(values, type=t) for values, t in zip(compute(texts), types)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *new], names=[*batch.schema.names[:n], *[f.name for f in fields]])

    return source.mapInArrow(run, schema)


def _arrow(t: T.DataType) -> pa.DataType:
    if isinstance(t, T.ArrayType):
        return pa.list_(_arrow(t.elementType))
    if isinstance(t, T.StructType):
        return pa.struct([pa.field(f.name, _arrow(f.dataType)) for f in t.fields])
    return {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(), T.BooleanType: pa.bool_(),
            T.StringType: pa.string(), T.BinaryType: pa.binary()}[type(t)]


def field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, True)


LONG, STRING, DOUBLE, BOOL, BINARY, INT = T.LongType(), T.StringType(), T.DoubleType(), T.BooleanType(), T.BinaryType(), T.IntegerType()
