"""The registered queries of this subpackage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, mixing, personal_data, prefix_trie, quality_rules, sharding, simhash, substring_dedup, token_rollup, token_store, topk, warc
from .common import shared, written
from .oracles import ORACLES

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: The two tokenizers that op13 aligns.
BYTE_LEVEL, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
#: Id appended to each document of the token store.
END_ID = 2
#: Byte limit of a shard.
SHARD_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all documents to source weights 5, 2, 1, ... takes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    found = mixing.mix_sizes(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")), mixing.pattern_weights(docs))
    return found.select("row.doc_id", "row.source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule features and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    found = quality_rules.judge(docs, table(spark, sf_dir, "labels"))
    return found.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "failed_rule", "kept")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words removed from each document as parts of repeated 35-word windows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs, with_text=False).select("row.doc_id", "n_words", "n_removed", "kept_sha256")


def op4_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WARC records of every page, by way of ARC files."""
    found = warc.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of their decoded text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encoded_digests(docs, TOKENIZER).select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op6_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals after four commits over all documents: insert all, revise
    the counts of texts with repeated lines (as cleaned of them), delete all
    but the first of equal texts, and the second commit again, which does
    nothing."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    clean = F.concat_ws("\n", F.array_distinct(F.split("text", "\n")))
    docs = docs.withColumn("clean", F.when(clean != F.col("text"), clean)).withColumn("key", F.md5(F.coalesce("text", F.lit(""))))
    rows = written(token_rollup.count_tokens(docs, TOKENIZER, ("text", "clean")).select(
        "row.*", "n_text", F.when(F.col("n_clean") > 0, F.col("n_clean")).alias("n_clean")), "counts")
    revised = rows.where("n_clean is not null")
    first = rows.groupBy("key").agg(F.min("doc_id").alias("first")).withColumnRenamed("key", "_key")
    gone = rows.join(first, F.col("key") == F.col("_key")).where("doc_id > first").withColumn("now", F.coalesce("n_clean", "n_text"))
    rollup, name = token_rollup.Rollup(spark, shared(spark, "token-totals")), "word_bpe_49k"
    changes = {
        "1-insert": token_rollup.signed(rows, 1, "n_text", name),
        "2-revise": token_rollup.signed(revised, -1, "n_text", name).unionByName(token_rollup.signed(revised, 1, "n_clean", name)),
        "3-delete": token_rollup.signed(gone, -1, "now", name),
    }
    for batch in ("1-insert", "2-revise", "3-delete", "2-revise"):
        rollup.commit(batch, changes[batch])
    return token_rollup.rolled_up(rollup.totals())


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=4, max_bits=4)
    return found.select("row.doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, as read back from the token store."""
    path = token_store.new_store(spark)
    token_store.write_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), path, TOKENIZER, END_ID)
    return token_store.digests(spark, path).withColumnRenamed("id", "doc_id")


def op9_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document, none over the byte limit, as read back from
    the written shards."""
    docs, path = table(spark, sf_dir, "documents").select("doc_id", "text"), shared(spark, "shards")
    sharding.write_shards(docs, path, SHARD_BYTES)
    found = sharding.read_shards(docs, path)
    return found.select("row.doc_id", "bytes", "depth", "shard", "shard_rows", "shard_bytes")


def op10_voronoi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five vectors with the highest inner product for each query vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("id") % 50 == 0)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all conversations, rebuilt with shared
    first turns."""
    turns = prefix_trie.turn_rows(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.with_shared_heads(turns))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document: those of the rules (counted
    and digested) and those that the trees add."""
    found = personal_data.find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    every = F.sort_array(F.concat("base", "added"))
    return found.select("row.doc_id", *[count(k) for k in personal_data.KINDS], F.sha2(personal_data.shown(F.col("base")), 256).alias("base_sha256"),
                        personal_data.shown(every).alias("spans"), F.size("added").cast("long").alias("n_added"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups and links of two tokenizers over every document."""
    found = alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"), BYTE_LEVEL, PIECES)
    return found.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def queries() -> dict:
    own = (op1_source_mix, op2_quality_rules, op3_substring_dedup, op4_arc_to_warc, op5_bpe_codec, op6_token_rollup,
           op7_simhash, op8_token_store, op9_extendible_shards, op10_voronoi_topk,
           op11_prefix_trie, op12_personal_data, op13_token_alignment)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
