"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# A1
def load_tables(spark: SparkSession, paths: dict[str, str], schemas: dict[str, T.StructType] | None = None,
                fmt: str = "csv", multiline: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """Read raw tables with explicit schemas. CSV: header row, UTF-8 (a BOM
    in the header is dropped). Quoted fields may hold newlines in the tables
    named by ``multiline`` (None: in all); only their files can't be split
    between tasks, so name the few that need it when files are large."""
    out = {}
    for name, path in paths.items():
        r = spark.read
        if schemas and name in schemas:
            r = r.schema(schemas[name])
        if fmt == "csv":
            r = (r.option("header", True).option("multiLine", multiline is None or name in multiline).option("escape", '"')
                  .option("encoding", "UTF-8").option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
                  .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss"))
            out[name] = r.csv(path)
        else:
            out[name] = r.format(fmt).load(path)
    return out


#: Rows of a compressed file at most: it can't be split between tasks.
ROWS_PER_FILE = 1_000_000


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Write a raw table as ``load_tables`` reads it. Compressed files are
    read by their ending and hold a bounded number of rows each."""
    w = df.write.option("compression", compression).option("maxRecordsPerFile", ROWS_PER_FILE) if compression else df.write
    (w.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
       .option("ignoreTrailingWhiteSpace", False).option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
       .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))


# A2
def write_splits(df: DataFrame, path: str, split: str = "split", fmt: str = "parquet") -> None:
    """Write the split frame partitioned by split (one folder per split)."""
    df.write.mode("overwrite").partitionBy(split).format(fmt).save(path)


# A3
def read_splits(spark: SparkSession, path: str, which: str | None = None, split: str = "split",
                fmt: str = "parquet") -> DataFrame:
    """Read the splits back; filtering on one split prunes the others' folders."""
    df = spark.read.format(fmt).load(path)
    return df.filter(F.col(split) == which) if which else df


# A4
def report_sink(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Write a small report table (summary row, metric table)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


# A5
def report_source(spark: SparkSession, path: str, fmt: str = "csv", nested: bool = False,
                  key_name: str = "variant") -> DataFrame:
    """Read a report back. ``nested=True`` reads a JSON object of objects
    ({variant: {metric: value}}) and returns one row per (variant, metric)."""
    if fmt == "csv":
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    if not nested:
        return spark.read.json(path)
    raw = spark.read.text(path, wholetext=True)
    m = F.from_json("value", T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType())))
    return (raw.select(F.explode(m).alias(key_name, "_m"))
               .select(key_name, F.explode("_m").alias("metric", "value")))


# A6
def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
