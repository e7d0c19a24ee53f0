"""The best matches by BM25 of an index, without scoring what cannot be among them.

The index holds, for each word and block of documents, the largest share the word gives to any
of them. Their sum over a query's words bounds the score of every document of the block. First
each query scores the ``k`` blocks with the highest bounds; its k-th best score there is then
reached only in blocks whose bound reaches it, and only those are scored besides. The page is
the one that scoring everything gives.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from wordloom.operators.factors import B, K1, SCALE, _bm25_term, _document_counts, with_idf
from wordloom.operators.ordering import best_rows, relevance
from wordloom.sizing import dealt, few, hint, join_by_term
from wordloom.sources.batch import QueryBatch
from wordloom.sources.term_index import TermIndex
from wordloom.storage import stored


@dataclass(frozen=True)
class BestMatches:
    """``matches``: query_id, keys, weight, rank. ``effort``: per query the ``blocks`` that hold
    one of its words, those ``scored``, and the documents that these scored."""

    matches: DataFrame
    effort: DataFrame


def _by_block(rows: DataFrame, index: TermIndex, batch: QueryBatch, terms: DataFrame) -> DataFrame:
    """``rows`` of ``peaks`` with a query word, dealt by block, so that what is grouped by block
    and more stays in its task: only rows of query words are moved, each once for all queries."""
    wanted = terms.select("term").distinct()
    met = join_by_term(rows, wanted, batch.small, ["block"])
    return dealt(met, index.df.count() * batch.rows_per_document, ["block"])


def block_bounds(
    index: TermIndex, terms: DataFrame, small: bool, batch: QueryBatch | None = None
) -> DataFrame:
    """(query_id, block, bound): no document of the block weighs more for the query. With the
    ``batch`` of the terms, blocks are dealt to tasks."""
    rows = index.peaks.select("term", "block", "peak")
    if batch is not None:
        rows = _by_block(rows, index, batch, terms)
    joined = join_by_term(rows, terms, small, ["block"])
    # A share is rounded on its own: one more millionth covers a product taken in another order.
    share = F.round(F.col("idf") * F.col("peak") * (K1 + 1) * SCALE).cast("bigint") + 1
    return joined.groupBy("query_id", "block").agg(F.sum(share).alias("bound"))


def _scored(
    index: TermIndex, batch: QueryBatch, terms: DataFrame, visits: DataFrame
) -> DataFrame:
    """BM25 of the documents of the blocks that each query visits.

    Rows of words and blocks meet the queries and the visits before their postings are unlisted,
    and a document's words are summed in the task that holds its block.
    """
    first, *others = index.keys
    listed = [*index.keys, "doc_len", F.transform("slots", F.size).alias("tf")]
    rows = index.peaks.select("term", "block", *listed)
    small = few(visits.count())
    blocks = hint(visits.select("block").distinct(), small)
    rows = _by_block(rows.join(blocks, "block", "left_semi"), index, batch, terms)
    there = visits.groupBy("block").agg(F.collect_list("query_id").alias("visitors"))
    hits = join_by_term(rows.join(hint(there, small), "block"), terms, batch.small, ["block"])
    hits = hits.where(F.array_contains("visitors", F.col("query_id")))
    at = lambda c: F.get(c, F.col("__at")).alias(c)
    words = hits.select(
        *["query_id", "block", "idf", "avg_len", "doc_len", "tf", *others],
        F.posexplode(first).alias("__at", first),
    ).select("query_id", "block", "idf", "avg_len", first, *map(at, [*others, "doc_len", "tf"]))
    share = _bm25_term(F.col("tf").cast("double"), K1, B)
    scored = words.groupBy("query_id", "block", *index.keys).agg(F.sum(share).alias("weight"))
    return scored.drop("block")


def best_bm25(index: TermIndex, batch: QueryBatch, k: int = 20) -> BestMatches:
    """The ``k`` documents of best BM25 for each query among those that hold any of its words,
    equal scores by key; as ``page(rank_bm25(...), limit=k)``."""
    if k < 1:
        raise ValueError("k is below 1")
    index = index.opened(batch.terms)
    counts = _document_counts(index, batch)
    terms = stored(
        with_idf(batch, counts)
        .where(F.col("qpos") == F.col("first_qpos"))
        .select("query_id", "term", "idf", "avg_len"),
        "terms",
    )
    bounds = stored(block_bounds(index, terms, batch.small, batch), "bounds")
    # Each of these blocks holds a match, so they hold k, or all there are.
    first = best_rows(bounds, [F.desc("bound")], k, ["block"]).drop("rank")
    first = stored(first, "blocks")
    early = stored(_scored(index, batch, terms, first), "scored")
    reached = best_rows(early, relevance(), k, index.keys).where(F.col("rank") == k)
    reached = reached.select("query_id", F.col("weight").alias("reached"))
    rest = bounds.join(first, ["query_id", "block"], "left_anti")
    rest = rest.join(reached, "query_id", "left")
    rest = stored(rest.where(F.col("bound") >= F.coalesce("reached", F.lit(0))), "blocks")
    # What weighs less than the k-th best so far is not on the page, and is not kept.
    late = _scored(index, batch, terms, rest).join(
        hint(reached, few(batch.queries)), "query_id", "left"
    )
    late = stored(late.where(F.col("weight") >= F.coalesce("reached", F.lit(0))), "scored")
    found = early.unionByName(late.drop("reached"))
    scored = early.unionByName(_scored(index, batch, terms, rest))
    visits = first.select("query_id").unionByName(rest.select("query_id"))
    effort = (
        bounds.groupBy("query_id").agg(F.count(F.lit(1)).alias("blocks"))
        .join(visits.groupBy("query_id").agg(F.count(F.lit(1)).alias("scored")), "query_id")
        .join(scored.groupBy("query_id").agg(F.count(F.lit(1)).alias("documents")), "query_id")
    )
    return BestMatches(best_rows(found, relevance(), k, index.keys), effort)
