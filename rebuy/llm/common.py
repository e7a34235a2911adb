"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: A word: a run of bytes that are no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: cuts
    the lineage and survives lost executors."""
    path = shared(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.path = path
    return out


def drop(df: DataFrame) -> None:
    """Delete a table made by ``written`` that no later plan reads."""
    spark = df.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(df.path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def text_key(*cols: str):
    """64-bit content hash that, with the row's id, names a document."""
    return F.xxhash64(*[F.col(c) for c in cols])


def pieces(batch, size_col: str, limit: int = 1 << 21):
    """Slices of an Arrow batch whose ``size_col`` values (bytes) stay near
    ``limit`` together; a longer single row comes alone."""
    col = batch.column(batch.schema.get_field_index(size_col))
    start, total = 0, 0
    for i, value in enumerate(col):
        size = len(value.as_buffer()) if value.is_valid else 0
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if batch.num_rows > start:
        yield batch.slice(start)
