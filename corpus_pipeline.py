"""From documents to packed training sequences in five stages."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import decontamination, language, lines, minhash, packing
from fleetlens.llm.common import fresh_path
from fleetlens.llm.queries import TOKENIZER

#: Documents whose language is less certain than this are rejected.
LEAST_SCORE = 0.5

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those whose language stays open."""
    found = language.identify(docs)
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("source.*")


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated chunks of lines; a document of which nothing is left goes."""
    found = lines.dedup_lines(docs)
    left = found.where((F.col("n_removed") == 0) | (F.length("text") > 0))
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return left.select(*[changed[c].alias(c) if c in changed else F.col("source")[c].alias(c) for c in docs.columns])


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near duplicates (five words, 0.8), and rows without an id.

    Different texts of a kept id all stay; of rows alike in id and text the first by the other columns.
    """
    found = minhash.near_duplicates(docs)
    kept = found.where("kept and id is not null").select(F.col("id").alias("doc_id")).distinct()
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    one = docs.join(kept, "doc_id", "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct(*others)).alias("rest"))
    one = one.select("doc_id", "text", "rest.*").select(*docs.columns)
    return one.unionByName(docs.where(F.col("doc_id").isNull()))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten consecutive words of a benchmark item."""
    found = decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(F.size("items") == 0).select("source.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(docs, public_tokenizers.path(TOKENIZER)))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("line_dedup", unique_lines),
    ("minhash_near_dedup", distinct_documents),
    ("decontamination", uncontaminated),
    ("packing", packed),
]

#: The classifier and the tokenizer cannot be stated in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to `documents`, each one's result stored in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
