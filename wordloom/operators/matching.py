"""Selecting documents by the words of a query.

Every function returns the matching (query_id, keys). A repeated query word counts
once for ``match_all``; for ``match_phrase`` each query position must be present.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wordloom.sources.batch import QueryBatch
from wordloom.sizing import dealt, join_by_term
from wordloom.sources.corpus import Corpus
from wordloom.sources.tokens import doc_terms, positions


def _term_hits(corpus: Corpus, batch: QueryBatch) -> DataFrame:
    """One row per (query, document, distinct word they share)."""
    terms = batch.lead_terms.select("query_id", "term", "n_terms")
    return join_by_term(doc_terms(corpus), terms, batch.small, list(corpus.keys))


def match_all(corpus: Corpus, batch: QueryBatch) -> DataFrame:
    """Documents that hold every word of the query.

    A document lists each word once, so counting rows counts distinct words: one
    aggregate, combined before its only shuffle.
    """
    found = _term_hits(corpus, batch).groupBy("query_id", *corpus.keys)
    counted = found.agg(F.count(F.lit(1)).alias("n"), F.max("n_terms").alias("n_terms"))
    return counted.where(F.col("n") == F.col("n_terms")).select("query_id", *corpus.keys)


def match_any(corpus: Corpus, batch: QueryBatch) -> DataFrame:
    """Documents that hold at least one word of the query."""
    return _term_hits(corpus, batch).select("query_id", *corpus.keys).distinct()


def match_phrase(corpus: Corpus, batch: QueryBatch) -> DataFrame:
    """Documents that hold the query words next to each other, in order, in one field."""
    # Only words that follow the word they follow in the query are moved (all of them for a
    # query of one word); an alignment with every link is the phrase. Partitioned by
    # document, alignments and documents are counted after one shuffle.
    terms = batch.terms.select("query_id", "qpos", "term", "before", "qlen")
    words = positions(corpus, previous=True)
    hits = join_by_term(words, terms, batch.small, list(corpus.keys))
    linked = (F.col("qlen") == 1) | ((F.col("qpos") > 0) & (F.col("previous") == F.col("before")))
    rows = hits.where(F.coalesce(linked, F.lit(False))).select(
        "query_id",
        *corpus.keys,
        "field_no",
        (F.col("pos") - F.col("qpos")).alias("anchor"),
        "qlen",
    )
    # By so many tasks that none holds more as the corpus grows.
    met = corpus.df.count() * batch.rows_per_document
    found = dealt(rows, met, ["query_id", *corpus.keys]).groupBy(
        "query_id", *corpus.keys, "field_no", "anchor"
    )
    counted = found.agg(F.count(F.lit(1)).alias("n"), F.max("qlen").alias("qlen"))
    whole = counted.where(F.col("n") == F.greatest(F.col("qlen") - 1, F.lit(1)))
    return whole.select("query_id", *corpus.keys).distinct()


def match_fullscan(corpus: Corpus, query_id: int = 0) -> DataFrame:
    """Every document, with weight 1; filters, sort and group do the rest."""
    return corpus.df.select(
        F.lit(query_id).cast("bigint").alias("query_id"),
        *corpus.keys,
        *corpus.attrs,
        F.lit(1).cast("bigint").alias("weight"),
    )
