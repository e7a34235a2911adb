"""Sharding by extendible hashing.

A row's place is a 60-bit hash. The directory is indexed by a prefix of its
bits; a bucket is a prefix, and only a bucket over the byte limit splits on
another bit. Buckets are found from a histogram of bytes by prefix, so the
directory costs one aggregation of (hash, bytes) pairs; prefixes that are
still too large at the histogram's depth are counted again, deeper, alone.
A bucket of several rows that is too large at all 60 bits (rows that repeat one
id) splits on 60 further bits, from a hash of the text and the row's number
among its copies. Only DataFrame functions are used.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

BITS = 60


def place(key: Column) -> Column:
    """The 60 leading bits of the MD5 of a key (null: of an empty string)."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, BITS // 4), 16, 10).cast("long")


def _leaves(hist: DataFrame, top: int, deep: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Buckets of depth ``top`` to ``deep`` that need no further split, and
    the prefixes of depth ``deep`` that do. ``hist``: ``group``, ``prefix`` of
    ``deep`` bits, ``rows``, ``bytes``."""
    at = hist.select("group", F.explode(F.sequence(F.lit(top), F.lit(deep))).alias("depth"), "prefix", "rows", "bytes")
    # Only shifts by a column need SQL: the function takes a number.
    sums = at.groupBy("group", "depth", F.expr(f"shiftright(prefix, {deep} - depth)").alias("prefix")).agg(
        F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))
    parent = sums.where(F.col("bytes") > limit).select(F.col("group").alias("_g"), (F.col("depth") + 1).alias("_d"), F.col("prefix").alias("_p"))
    fits = sums.where(F.col("bytes") <= limit)
    # A bucket that fits is a leaf if its parent does not fit, or it has none.
    split = fits.join(parent, (F.col("group") == F.col("_g")) & (F.col("depth") == F.col("_d")) & (F.shiftright("prefix", 1) == F.col("_p")), "left_semi")
    leaves = split.unionByName(fits.where(F.col("depth") == top)) if top == 0 else split
    return leaves, sums.where((F.col("depth") == deep) & (F.col("bytes") > limit)).select("group", "prefix", "rows", "bytes")


def directory(rows: DataFrame, limit: int, step: int = 8) -> DataFrame:
    """Buckets of each ``group`` of ``rows`` (``group``, ``hash``, ``bytes``):
    ``group``, ``depth``, ``prefix``, ``shard_rows`` and ``shard_bytes``, each
    at most ``limit`` bytes. A bucket whose rows all share one hash cannot
    split and stays as it is, at depth 60 (a row over the limit; rows that
    repeat one key)."""
    total = rows.agg(F.sum("bytes").alias("n")).first()["n"] or 0
    top, deep = 0, min(BITS, max(1, math.ceil(math.log2(max(total, 1) / limit + 1)) + 4))
    found = []
    while True:
        shifted = rows.select("group", F.shiftright("hash", BITS - deep).alias("prefix"), "bytes")
        hist = written(shifted.groupBy("group", "prefix").agg(F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes")), "histogram")
        leaves, over = _leaves(hist, top, deep, limit)
        found.append(leaves)
        over = written(over, "oversized")
        if deep == BITS:
            found.append(over.select("group", F.lit(BITS).alias("depth"), "prefix", "rows", "bytes"))
        if deep == BITS or over.isEmpty():
            break
        rows = rows.join(over.select(F.col("group").alias("_g"), F.col("prefix").alias("_p")),
                         (F.col("group") == F.col("_g")) & (F.shiftright("hash", BITS - deep) == F.col("_p")), "left_semi")
        top, deep = deep, min(BITS, deep + step)
    out = reduce(DataFrame.unionByName, found)
    return out.select("group", "depth", "prefix", F.col("rows").alias("shard_rows"), F.col("bytes").alias("shard_bytes"))


def _find(rows: DataFrame, book: DataFrame) -> DataFrame:
    """``rows`` (``group``, ``hash``, ...) with the bucket of ``book`` that they
    fall in; rows of no bucket are left out. A row meets only the buckets that
    share the bits of its group's shallowest one, and is not copied."""
    least = book.groupBy(F.col("group").alias("_lg")).agg(F.min("depth").alias("_least"))
    book = book.join(least, F.col("group") == F.col("_lg")).select(
        F.col("group").alias("_g"), "depth", "prefix", "shard_rows", "shard_bytes", F.expr("shiftright(prefix, depth - _least)").alias("_k"))
    rows = rows.join(least, F.col("group") == F.col("_lg")).withColumn("_r", F.expr(f"shiftright(hash, {BITS} - _least)"))
    found = rows.join(book, (F.col("group") == F.col("_g")) & (F.col("_r") == F.col("_k")) & F.expr(f"shiftright(hash, {BITS} - depth) = prefix"))
    return found.drop("_lg", "_least", "_r", "_g", "_k")


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (``group``, ``text_hash``, ...) with ``hash``: 60 bits of the
    text's hash and the row's number among its copies. Copies are numbered
    within the task that wrote them, after those of the tasks before."""
    rows = written(rows.withColumn("_part", F.spark_partition_id()).withColumn("_n", F.monotonically_increasing_id()), "repeated")
    key = ["group", "text_hash", "_part"]
    before = Window.partitionBy("group", "text_hash").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).select(*key, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    copy = F.col("_before") + F.row_number().over(Window.partitionBy(*key).orderBy("_n"))
    rows = rows.join(sizes, key).withColumn("hash", place(F.concat_ws(" ", F.col("text_hash"), copy)))
    return written(rows.drop("_part", "_n", "_before", "text_hash"), "numbered")


def shard(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """Struct ``row`` (columns of ``docs``, the text only if ``keep_text``),
    ``bytes`` (UTF-8 of the text, null 0) and the row's bucket: ``depth``,
    ``shard`` (its bits), ``shard_rows``, ``shard_bytes``.

    Rows are placed by the hash of their id, so copies of a text spread. Rows
    that repeat an id (null ids count as one) share a bucket unless they are
    over the limit together; then they spread by text and copy, at depths over
    60. Only a single row can stay over the limit. An empty table gives an
    empty result. ``docs`` is read several times.
    """
    kept = [c for c in docs.columns if keep_text or c != text_col]
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), place(F.col(f"`{id_col}`")).alias("hash"),
                       F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("bytes"), F.xxhash64(text).alias("text_hash"))
    placed = written(rows.select(F.lit(0).cast("long").alias("group"), "hash", "bytes"), "placed")
    book = written(directory(placed, limit), "directory")
    many = (F.col("depth") == BITS) & (F.col("shard_rows") > 1) & (F.col("shard_bytes") > limit)
    found = _find(rows.drop("text_hash").withColumn("group", F.lit(0).cast("long")), book.where(~many))
    bits = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.lpad(F.bin("prefix"), F.col("depth"), F.lit("0")))
    names = ["row", "bytes", "depth", "shard", "shard_rows", "shard_bytes"]
    found = found.withColumn("shard", bits).select(*names)
    hot = book.where(many).select(F.col("prefix").alias("_h"))
    if hot.isEmpty():
        return found
    again = _numbered(rows.join(hot, F.col("hash") == F.col("_h"), "left_semi").withColumnRenamed("hash", "group"))
    below = _find(again, written(directory(again.select("group", "hash", "bytes"), limit), "directory"))
    below = below.withColumn("shard", F.concat(F.lpad(F.bin("group"), BITS, "0"), bits)).withColumn("depth", F.col("depth") + BITS)
    return found.unionByName(below.select(*names))


def write_shards(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write each bucket as a folder ``shard=b<bits>`` of Parquet files (another
    name if ``docs`` has a column ``shard``). An empty table writes no folder."""
    found = shard(docs, limit, id_col, text_col, keep_text=True)
    folder = folder_column(docs)
    rows = found.select("row.*", F.concat(F.lit("b"), "shard").alias(folder))
    rows.repartition(folder).write.partitionBy(folder).parquet(path)


def folder_column(docs: DataFrame) -> str:
    """Name of the folders: ``shard``, with underscores before it as long as
    ``docs`` has a column of that name in any case."""
    taken, name = {c.lower() for c in docs.columns}, "shard"
    while name in taken:
        name = "_" + name
    return name


def read_shards(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Struct ``row`` (columns of ``docs`` but the text), ``bytes``, ``depth``,
    ``shard``, ``shard_rows`` and ``shard_bytes`` of every row as written by
    ``write_shards``; ``docs`` gives the schema alone."""
    folder = folder_column(docs)
    schema = T.StructType([*docs.schema.fields, T.StructField(folder, T.StringType())])
    stored = docs.sparkSession.read.schema(schema).parquet(path)
    rows = stored.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"),
                         F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("long").alias("bytes"),
                         F.expr(f"substring({folder}, 2)").alias("shard"))
    sizes = rows.groupBy(F.col("shard").alias("_s")).agg(F.count(F.lit(1)).alias("shard_rows"), F.sum("bytes").alias("shard_bytes"))
    return rows.join(sizes, F.col("shard") == F.col("_s")).select("row", "bytes", F.length("shard").alias("depth"), "shard", "shard_rows", "shard_bytes")
