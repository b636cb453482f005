"""A corpus pipeline over documents: toxicity, exact copies, near copies, repeated spans, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of docs, in their order, whatever these are called.

In every stage a null text counts as empty, an empty table gives no rows, and rows with null or repeated doc_ids are rows like
any other: none is lost or judged twice for its id's sake.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import exact_dedup, near_join, packing, sentence_spans, toxicity
from gleanery.llm.common import checkpoint_dir, fresh, remove


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier of labelled documents doesn't call toxic; empty texts get the base rate, so they stay."""
    model = toxicity.learn(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs, "text", model, {"__row__": F.struct(*[F.col(f"`{c}`") for c in docs.columns])})
    return scored.where("predicted = 0").select("__row__.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (null and empty ones are a group too), that of the largest doc_id; a null id comes before all others."""
    return exact_dedup.keep_one(docs, "doc_id", "text")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the least doc_id (nulls first); texts without a word have no copies here."""
    return near_join.keep_one(docs, "doc_id", "text")


def cut_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without spans of sentences that an earlier place has; n_chars follows the text where it was cut."""
    removed = fresh(docs.columns, "n_removed")
    cut = sentence_spans.dedup_spans(docs, "doc_id", "text", removed)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col(removed) > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return cut.select(*[F.col(f"`{c}`") for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens; an empty text is one piece, the end id alone."""
    import public_tokenizers

    return packing.pack(docs, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", cut_repeated_spans),
    ("best-fit packing", pack_sequences),
]

#: Stages of a classifier, min-hashing and a tokenizer have no SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents, each written to the shared folder and read again; a stage's table goes once the next one is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            remove(spark, f"{folder}/{k - 1}")
    return docs
