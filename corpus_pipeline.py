"""The corpus pipeline: five stages over ``documents``, each handed to the next as a Parquet table.

A stage is ``f(spark, docs, sf_dir) -> DataFrame``. All but the last return the columns of ``documents``.

1. quality: documents that the classifier scores below 0.7 go.
2. exact copies: of equal texts one stays.
3. near copies: of documents linked by a Jaccard similarity of 0.8 over five-word shingles, one stays.
4. decontamination: documents that hold a benchmark item within 8 % edits go.
5. pieces: sampled SentencePiece ids, with the proof that decoding returns the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordwise.llm import decontaminate, exact_dedup, ngram_join, pieces, quality
from recordwise.llm.files import ship
from recordwise.operators.sizing import fresh_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return ngram_join.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return pieces.encode_texts(docs, pieces.model_path())


STAGES = [
    ("quality classifier", good),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("SentencePiece encoding and decoding", as_pieces),
]

# No SQL: a trained model and sampled segmentations decide rows; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = fresh_path(spark, f"pipeline-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
