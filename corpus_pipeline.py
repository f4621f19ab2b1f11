"""The corpus pipeline: toxic documents go, one of each group of near copies stays, passages that
an earlier document has go, documents that leak a benchmark item go, and the rest is packed.

Each stage works on all documents that the one before it kept. A near copy has a similarity of
0.8 or more in shingles of five words; a passage is 50 words or longer.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partnerscope.llm import decontaminate, minhash, packing, substring, toxicity
from partnerscope.llm.common import Work, table, two_columns

SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
PASSAGE_WORDS = 50


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below one half, by a lexicon learned from the labels.

    Null and empty texts have no hit and stay; repeated rows are scored alike.
    """
    model = toxicity.fit(two_columns(docs, "doc_id", "text"), table(spark, sf_dir, "labels"))
    return toxicity.with_toxicity(docs, model).where("toxicity < 0.5").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group of near copies.

    Texts are judged one by one, also those that share an id. Rows that repeat id and text are one
    document and stay or go together. Rows without id, and texts without words, stay.
    """
    rows = docs.withColumn("_text", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    ids = rows.groupBy("doc_id").agg(F.min("_text").alias("_first"), F.max("_text").alias("_last"))
    several = Work(spark, "ids").keep(ids.where("_first <> _last").select("doc_id", "_first"), "several")
    # Of texts with one id the first keeps it; the others get ids of their own, beyond all others.
    own = (F.xxhash64("doc_id", "_text").bitwiseAND((1 << 61) - 1) + (1 << 61)).alias("_id")
    rows = rows.join(several, "doc_id", "left")
    rows = rows.withColumn("_id", F.when(F.col("_first").isNull() | (F.col("_first") == F.col("_text")), F.col("doc_id").cast("long")).otherwise(own))
    found = minhash.near_copies(rows.select("_id", "text"), SHINGLE_WORDS, SIMILAR_PERCENT, id_col="_id")
    copies = found.where("NOT kept").select(F.col("doc_id").alias("_id")).distinct()
    return rows.join(copies, "_id", "left_anti").select(*docs.columns)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that one with a smaller id has.

    Null texts become empty; rows without id lose nothing. ``n_chars`` follows the text.
    """
    kept = substring.without_repeats(docs, PASSAGE_WORDS)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item. Null and empty texts hold none and stay."""
    found = decontaminate.with_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("leaked_items") == 0).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: a row for each piece of a document; an empty or null text is its end token."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("repeated passages", drop_repeats),
    ("benchmark leaks", drop_leaks),
    ("packing", pack),
]
#: No SQL: a learned lexicon, a tokenizer and a packing plan have none. Tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Work(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = work.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
