"""From raw documents to packed sequences: quality rules, line dedup, SimHash near-dedup,
benchmark decontamination, best-fit packing.

Each stage works on all that its predecessor kept, which is written as Parquet and read again.
All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from wordloom.llm import line_dedup, line_quality, simhash
from wordloom.llm.common import read, small_batches, stored
from wordloom.llm.decontaminate import decontaminate
from wordloom.llm.packing import pack
from wordloom.llm.token_ids import VOCABULARY


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return line_quality.screen(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of three lines or more, or of 50 words or more, go, and documents
    that lose every line."""
    small_batches(spark)
    count = "deleted" + "_" * max(map(len, docs.columns))  # no column of docs is as long
    cut = line_dedup.dedup_lines(docs, min_run=3, min_words=50, count=count)
    emptied = (F.col(count) > 0) & ~F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    return cut.where(~F.coalesce(emptied, F.lit(False))).select(*[f"`{c}`" for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    small_batches(spark)
    return simhash.keep_one(docs, shingle=4, distance=4, seed=42)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go; rows equal in id and
    text share a verdict."""
    small_batches(spark)
    found = decontaminate(docs, read(spark, sf_dir, "benchmark"))
    gone = found.where("contaminated").select(F.col("doc_id").alias("of_id"), "key").distinct()
    # The row travels as one column, whatever names its own columns have.
    own = F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("own")
    wide = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), own)
    same = wide["id"].eqNullSafe(gone["of_id"]) & (wide["own"] == gone["key"])
    return wide.join(gone, same, "left_anti").select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, packed into sequences of 4096 token ids."""
    small_batches(spark)
    return pack(docs, public_tokenizers.path(VOCABULARY), end_id=1)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", packing),
]

#: Fingerprints and token ids are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
