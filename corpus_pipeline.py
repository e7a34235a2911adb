"""From raw documents to token ids: quality rules, near-duplicates, repeated
passages, the mix of sources, tokens. Each stage takes (spark, docs, sf_dir)
and returns a DataFrame; ``docs`` is what the stage before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rebuy.llm import bpe, mixing, quality_rules, simhash, substring_dedup
from rebuy.llm.common import written
from rebuy.llm.queries import TOKENIZER, table

#: SQL has no XXH64, no random rounding and no BPE.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the cutoffs of their language."""
    found = quality_rules.judge(docs, table(spark, sf_dir, "labels"), keep_text=True)
    return found.where("kept").select(*[F.col(f"row.`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id."""
    return simhash.keep_one(docs, shingle=4, max_bits=4).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without words of repeated 35-word windows. A text that loses
    none stays as it is; of others the kept words are joined by a space, and
    one that loses all its words is left out."""
    found = substring_dedup.remove_repeats(docs, width=35)
    cut = F.col("n_removed") > 0
    own = {"text": F.when(cut, F.col("kept")).otherwise(F.col("text")),
           "n_chars": F.when(cut, F.char_length("kept").cast("long")).otherwise(F.col("row.n_chars"))}
    return found.where("n_removed < n_words or n_removed = 0").select(
        *[own.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to source weights 5, 2, 1, ... takes them."""
    found = mixing.mix(docs, mixing.pattern_weights(docs))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return found.where("copies > 0").withColumn("copy", copies).select("row.*").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text that they decode to."""
    found = bpe.encode_decode(docs, TOKENIZER)
    return found.select("row.doc_id", "row.source", "row.lang", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality_rules", quality), ("simhash_near_dedup", near_duplicates), ("substring_dedup", repeated_passages),
          ("source_mix", mix), ("bpe", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
