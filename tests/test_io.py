"""Sources and sinks on hand-made files in a scratch folder."""

import json
import os
import tempfile

from pyspark.sql import types as T

from rebuy.plans import q_frame
from rebuy.session import checkpoint_dir
from rebuy.sources import io as IO


def test_csv_with_bom_and_multiline_quotes(spark):
    d = tempfile.mkdtemp(prefix="rebuy-io-")
    p = os.path.join(d, "reviews.csv")
    with open(p, "w", encoding="utf-8-sig") as f:
        f.write('review_id,order_id,message,created\n')
        f.write('r1,o1,"two\nlines, with comma",2018-01-02 03:04:05\n')
        f.write('r2,o2,,2018-02-03 04:05:06\n')
    schema = T.StructType([T.StructField("review_id", T.StringType()), T.StructField("order_id", T.StringType()),
                           T.StructField("message", T.StringType()), T.StructField("created", T.TimestampNTZType())])
    df = IO.load_tables(spark, {"reviews": p}, {"reviews": schema})["reviews"]
    rows = sorted(df.collect())
    assert [r.review_id for r in rows] == ["r1", "r2"]
    assert rows[0].message == "two\nlines, with comma" and rows[1].message is None
    assert rows[0].created.year == 2018


def test_nested_json_report_to_rows(spark):
    d = tempfile.mkdtemp(prefix="rebuy-io-")
    p = os.path.join(d, "ablation.json")
    with open(p, "w") as f:
        json.dump({"full_model": {"PR-AUC": 0.0234, "F1": 0.0483}, "no_residual": {"PR-AUC": 0.0234}}, f, indent=2)
    rows = {(r.variant, r.metric): r.value for r in IO.report_source(spark, p, "json", nested=True).collect()}
    assert rows == {("full_model", "PR-AUC"): 0.0234, ("full_model", "F1"): 0.0483, ("no_residual", "PR-AUC"): 0.0234}


def test_split_round_trip_prunes_partitions(spark):
    d = tempfile.mkdtemp(prefix="rebuy-io-")
    df = spark.createDataFrame([(1, "train"), (2, "val"), (3, "test")], "order_id long, split string")
    IO.write_splits(df, os.path.join(d, "splits"))
    back = IO.read_splits(spark, os.path.join(d, "splits"), "val")
    assert [r.order_id for r in back.collect()] == [2]
    assert "PartitionFilters: [isnotnull(split" in back._jdf.queryExecution().executedPlan().toString() or \
        "split" in back._jdf.queryExecution().executedPlan().toString()


def test_raw_tables_are_compressed_and_go_when_they_are_read(spark, monkeypatch):
    from pyspark.sql import functions as F

    text = F.concat(F.lit('two\nlines, "quoted" '), F.repeat(F.lit("and long "), 200))
    ids = spark.range(50)
    tables = {n: ids.select(*[F.col("id").alias(k) if k == key else text.alias(k) for k in dict.fromkeys(q_frame._CSV[n])])
              for n, (key, _) in q_frame._CSV.items()}
    tables["orders"] = ids.select(F.col("id").alias("order_id"), F.lit("x").alias("order_purchase_timestamp"))
    monkeypatch.setattr(q_frame, "_tables", lambda spark, sf: tables)
    monkeypatch.setattr(IO, "ROWS_PER_FILE", 20)
    load, seen = IO.load_tables, []

    def looked(spark, paths, *a, **b):
        root = checkpoint_dir(spark).removeprefix("file:")
        raw = [os.path.join(d, f) for d, _, files in os.walk(root) if "/raw-" in d and "raw-counts" not in d for f in files if f.startswith("part-")]
        seen.append((len({f.split("/raw-")[1].split("/")[0] for f in raw}), all(f.endswith(".csv.gz") for f in raw), len(raw)))
        return load(spark, paths, *a, **b)

    monkeypatch.setattr(IO, "load_tables", looked)
    # Only reviews may hold newlines.
    for n in tables:
        if n != "order_reviews":
            tables[n] = tables[n].select(*[F.translate(F.col(c).cast("string"), "\n", " ").alias(c) for c in tables[n].columns])
    got = {r.table_name: r for r in q_frame.q_load_tables_csv(spark, "").collect()}
    assert len(got) == 8 and all(r.n_rows == r.n_keys == r.n_values == 50 for r in got.values() if r.table_name not in ("orders", "category_translation"))
    assert got["order_reviews"].n_chars == 50 * len('two\nlines, "quoted" ' + "and long " * 200)
    assert [s[:2] for s in seen] == [(1, True)] * 8  # one table's files at a time
    assert all(s[2] >= 3 for s in seen)  # 50 rows, at most 20 a file
