"""Plan-shape checks: pushdown, pruning, no single-partition data windows."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from rebuy.operators import assemble as A
from rebuy.operators import ordering as D
from rebuy.sources.retail import retail_tables


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reviews_carry_whole_texts_of_all_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    text = F.regexp_replace("review_comment_message", r" ok\?!$", "")
    reviews = retail_tables(spark, SF_SMALL)["order_reviews"].select(text.alias("t")).where("t <> ''")
    assert reviews.join(docs, F.col("t") == F.col("text"), "left_anti").count() == 0
    # Every text is in a review: these tables have more orders with a text than documents.
    assert docs.where("text <> ''").join(reviews, F.col("t") == F.col("text"), "left_anti").count() == 0
    assert reviews.agg(F.max(F.length("t"))).first()[0] > 400


def test_item_aggregate_reads_only_needed_columns(spark):
    t = retail_tables(spark, SF_SMALL)
    products = A.category_translate(t["products"], t["category_translation"])
    p = _plan(A.item_agg(A.item_enrich(t["order_items"], products, t["sellers"])))
    scan = [line for line in p.splitlines() if "lineitem.parquet" in line][0]
    assert "l_quantity" not in scan and "l_shipdate" not in scan and "l_extendedprice" in scan


def test_global_rank_shuffles_rows_by_bucket(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 7).alias("g"))
    p = _plan(D.global_rank(df, ["g", "id"], n_buckets=8))
    # the rows are exchanged by bucket; only the per-bucket sizes meet in one partition
    assert "hashpartitioning(_bkt" in p
    single = [line for line in p.splitlines() if "SinglePartition" in line]
    assert len(single) <= 1


def test_split_counts_partition_the_input(spark):
    df = spark.range(1003).select(F.col("id").alias("order_id"), (F.col("id") % 17).alias("score_time"))
    s = D.temporal_split(df)
    assert s.count() == 1003 and s.select("order_id").distinct().count() == 1003
