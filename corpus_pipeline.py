"""A training corpus from raw documents: filter, de-duplicate, mix, encode.

Each stage takes what the one before kept, as Parquet read again, and returns the columns of documents; the last one
returns the encoded documents. Null texts pass every stage as empty ones; an empty table passes as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm import bpe, jaccard_join, line_dedup, mixing, toxicity
from stratamart.llm.storage import documents, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not predict toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, labels)


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that later occurrences of a three-line window cover; n_chars follows the text."""
    out = line_dedup.dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType))


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of similar documents."""
    return jaccard_join.one_per_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, and digests of the ids and of the text decoded from them."""
    coded = docs.select("doc_id", "lang", "source", bpe.digests(spark, with_ids=True)("text").alias("c"))
    return coded.select("doc_id", "lang", "source", "c.n_tokens", "c.ids", "c.ids_sha256", "c.decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_lines),
    ("jaccard_join", one_of_similar),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: A trained classifier, MinHash and byte-pair merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
