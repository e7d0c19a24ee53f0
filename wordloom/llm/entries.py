"""The registered queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from wordloom.llm import byte_bpe, collocations, grades, line_dedup, line_quality, ranked_search, tool_calls
from wordloom.llm.common import read, small_batches
from wordloom.llm.decontaminate import decontaminate
from wordloom.llm.extract import extract
from wordloom.llm.packing import pack
from wordloom.llm.repeats import remove_repeats
from wordloom.llm.simhash import near_duplicates
from wordloom.llm.token_files import token_files
from wordloom.llm.token_ids import VOCABULARY


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    groups = near_duplicates(read(spark, sf_dir, "documents"), shingle=4, distance=4, seed=42)
    return groups.select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return extract(read(spark, sf_dir, "pages"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs, items = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return decontaminate(docs, items).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    cut = line_dedup.dedup_lines(read(spark, sf_dir, "documents"), min_run=3)
    text = F.coalesce("text", F.lit(""))
    return cut.select("doc_id", "n_deleted", F.sha2(text, 256).alias("kept_sha256"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.quality(read(spark, sf_dir, "documents")).drop("host", "key")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = read(spark, sf_dir, "documents")
    ratings = read(spark, sf_dir, "labels").select("doc_id", grades.grade().alias("grade"))
    model = grades.train(docs, ratings, levels=3)
    return grades.score(docs, model, wanted=2)


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    messages = tool_calls.exchanges(read(spark, sf_dir, "conversations"))
    return tool_calls.format_conversations(messages, tool_calls.ANSWER_TOOL)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return pack(read(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), end_id=1)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return remove_repeats(read(spark, sf_dir, "documents"), length=400).drop("kept")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = read(spark, sf_dir, "documents")
    return token_files(docs, public_tokenizers.path(VOCABULARY), end_id=2)


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    tokens = byte_bpe.encode(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return byte_bpe.decode(tokens, byte_bpe.token_bytes(spark, path)).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    index = ranked_search.index_documents(read(spark, sf_dir, "documents"))
    return ranked_search.search(index, read(spark, sf_dir, "benchmark"), k=50)


QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_html_extraction": op2_html_extraction,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_line_dedup": op4_line_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_chat_formatting": op7_chat_formatting,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_token_files": op10_token_files,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_ranked_search": op13_ranked_search,
}
ORACLE: dict[str, str] = {
    "op4_line_dedup": line_dedup.ORACLE,
    "op5_quality_rules": line_quality.ORACLE,
    "op7_chat_formatting": tool_calls.ORACLE,
    "op12_phrase_collocations": collocations.ORACLE,
    "op13_ranked_search": ranked_search.ORACLE,
}
