"""The operators over the given tables, with production parameters, and the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import (
    decontamination, language, lines, merkle, minhash, packing, periodic, quality, rules, sharding, suffixes, vectors, warc,
)

TOKENIZER = "word_bpe_49k.json"
QUALITY_CUT = 0.3

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.dedup_lines(_table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "text", "n_lines", "n_chunks", "n_removed")


def line_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.dedup_runs(_table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "text", "n_lines", "n_removed")


def decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.digest(
        decontamination.decontaminate(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    )


def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash.near_duplicates(_table(spark, folder, "documents"), settings=minhash.Settings(words=2))
    return found.withColumnRenamed("id", "doc_id")


def repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.repeated_passages(_table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("begin").alias("begin_word"), F.col("end").alias("end_word"),
        (F.col("end") - F.col("begin")).alias("n_words"),
    )


def identify_language(spark: SparkSession, folder: str) -> DataFrame:
    found = language.identify(_table(spark, folder, "documents"))
    return found.select(F.col("source.doc_id").alias("doc_id"), "held_out", "lang_pred", "score")


def nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.nearest(_table(spark, folder, "embeddings"), F.col("id") % 20 == 0)


def pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.digest(packing.pack(_table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER)))


def score_quality(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.score_quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return found.select(
        F.col("id").alias("doc_id"), "held_out", "score", (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted")
    )


def shard(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.digest(sharding.shard_documents(_table(spark, folder, "documents")))


def archive(spark: SparkSession, folder: str) -> DataFrame:
    return warc.digest(warc.round_trip(spark, _table(spark, folder, "pages")))


def periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic.digest(periodic.find_runs(periodic.with_repeated_tail(_table(spark, folder, "documents"))))


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.digest(rules.judge(_table(spark, folder, "documents")))


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.digest(merkle.check_documents(_table(spark, folder, "documents")))


QUERIES: dict[str, Query] = {
    "op1_line_dedup": line_dedup,
    "op1_line_runs": line_runs,
    "op2_decontamination": decontaminate,
    "op3_minhash": near_duplicates,
    "op4_suffix_array": repeated_passages,
    "op5_language_id": identify_language,
    "op6_one_bit_codes": nearest_vectors,
    "op7_packing": pack,
    "op8_quality": score_quality,
    "op9_sharding": shard,
    "op10_warc": archive,
    "op11_periodic_runs": periodic_runs,
    "op12_quality_rules": quality_rules,
    "op13_merkle_manifest": manifest,
}

SQL: dict[str, str] = {
    "op1_line_dedup": lines.sql(),
    "op1_line_runs": lines.runs_sql(),
    "op2_decontamination": decontamination.sql(),
    "op4_suffix_array": suffixes.sql(),
    "op6_one_bit_codes": vectors.sql(),
    "op10_warc": warc.sql(),
    "op11_periodic_runs": periodic.sql(),
    "op12_quality_rules": rules.sql(),
    "op13_merkle_manifest": merkle.sql(),
}
