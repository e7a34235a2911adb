"""Token counts by source, language and tokenizer version, kept by deltas.

A batch holds signed changes: an insert adds a document and its tokens, a
delete takes them away, a revised count is a delete of the old and an insert
of the new one. A batch is summed to one row a group (map-side first, so a hot
source costs little) and committed by renaming its folder to ``batch=<id>``.
A batch id that is committed already is left alone, so a retry changes
nothing, and a writer that dies leaves only an unnamed folder behind. Totals
are the sum over the committed batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces
from .token_store import kept_encoder

GROUP = ("source", "lang", "tokenizer")
DELTA = "source string, lang string, tokenizer string, docs long, tokens long"


class Rollup:
    """Totals in a folder of committed batches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._Path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, batch_id: str):
        return self._Path(f"{self.path}/batch={batch_id}")

    def committed(self, batch_id: str) -> bool:
        """Whether a batch took effect."""
        return self._fs.exists(self._at(batch_id))

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Apply signed changes (``GROUP``, ``sign`` 1 or -1, ``tokens``)
        once; false if the batch was committed before. Null counts are 0;
        null group columns are a group of their own."""
        if self.committed(batch_id):
            return False
        tokens = F.col("sign") * F.coalesce("tokens", F.lit(0))
        delta = changes.groupBy(*GROUP).agg(F.sum("sign").cast("long").alias("docs"), F.sum(tokens).cast("long").alias("tokens"))
        staged = f"{self.path}/_staged-{uuid.uuid4().hex}"
        delta.write.parquet(staged)
        if not self.committed(batch_id) and self._fs.rename(self._Path(staged), self._at(batch_id)):
            return True
        self._fs.delete(self._Path(staged), True)
        return False

    def totals(self) -> DataFrame:
        """``docs`` and ``tokens`` of each group with any left."""
        if not self._fs.exists(self._Path(self.path)) or not any("batch=" in f.getPath().getName() for f in self._fs.listStatus(self._Path(self.path))):
            return self.spark.createDataFrame([], DELTA)
        rows = self.spark.read.schema(DELTA).parquet(f"{self.path}/batch=*")
        return rows.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 or tokens <> 0")


def rolled_up(totals: DataFrame) -> DataFrame:
    """Totals by every prefix of the group columns; ``level`` is how many of
    them a row keeps, the others are null."""
    return totals.rollup(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"),
                                     F.grouping_id().alias("g")).withColumn("level", (3 - F.bit_count("g")).cast("int")).drop("g")


def signed(rows: DataFrame, sign: int, tokens: str, tokenizer: str) -> DataFrame:
    """Changes of one sign from rows with ``source``, ``lang`` and a count."""
    return rows.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(sign).alias("sign"), F.col(tokens).alias("tokens"))


def count_tokens(docs: DataFrame, tokenizer_path: str, text_cols: tuple[str, ...] = ("text",)) -> DataFrame:
    """Struct ``row`` (columns of ``docs`` but the texts) and ``n_<column>``:
    tokens of each whole text column (null: 0)."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    others = [c for c in docs.columns if c not in text_cols]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), *[F.col(f"`{c}`").cast("string").alias(c) for c in text_cols])
    schema = T.StructType([rows.schema["row"], *[T.StructField(f"n_{c}", T.LongType()) for c in text_cols]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = kept_encoder(spec)
        for batch in batches:
            for part in pieces(batch, text_cols[0]):
                counts = [coder.encode_flat(part.column(1 + i).cast(pa.binary()).to_pylist())[1]
                          for i in range(len(text_cols))]
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, counts)], schema.names)

    return rows.mapInArrow(run, schema)
