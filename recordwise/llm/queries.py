"""The registered queries of this subpackage; each reads its whole table."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from recordwise.llm import decontaminate, exact_dedup, licenses, ngram_join, pieces, quality, repeat_removal, resampling, token_binary, token_counts, turn_repair, warc, word_bpe
from recordwise.llm.files import ship
from recordwise.llm.tokens import vocabulary_path
from recordwise.operators.sizing import fresh_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


QUERIES: dict = {}


def query(build):
    """Register ``build``; the package goes to the executors before it runs."""

    @functools.wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return build(spark, folder)

    QUERIES[build.__name__] = run
    return run


@query
def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.with_keepers(table(spark, folder, "pages"))
    files = warc.write_warc(records, fresh_path(spark, "warc"))
    read = warc.read_warc(spark, files, payload=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.copies(table(spark, folder, "documents"))


@query
def op3_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_links(table(spark, folder, "documents")).select("doc_id", "class_id", "n_links")


@query
def op4_repeat_removal(spark: SparkSession, folder: str) -> DataFrame:
    return repeat_removal.remove_repeats(table(spark, folder, "documents")).drop("kept")


@query
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, folder, "documents"), vocabulary_path())
    return counted.select("doc_id", "n_tokens")


@query
def op6_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.find_licenses(table(spark, folder, "documents"))


@query
def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op8_token_binary(spark: SparkSession, folder: str) -> DataFrame:
    shards = token_binary.write_shards(table(spark, folder, "documents"), fresh_path(spark, "shards"), vocabulary_path(), added_tokens=True)
    return token_binary.read_shards(spark, shards)


@query
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.predictions(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op10_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode_texts(table(spark, folder, "documents"), pieces.model_path())


@query
def op11_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turn_repair.reports(turn_repair.repair(turn_repair.damaged(table(spark, folder, "conversations")), present="present"))


@query
def op12_word_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return word_bpe.digests(table(spark, folder, "documents"), vocabulary_path(word_bpe.VOCABULARY))


@query
def op13_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


SQL: dict[str, str] = {"op2_exact_dedup": exact_dedup.COPIES_SQL, "op4_repeat_removal": repeat_removal.SQL, "op11_turn_repair": turn_repair.SQL, "op13_resampling": resampling.SQL}
