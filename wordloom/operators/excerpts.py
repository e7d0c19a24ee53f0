"""Keywords of query texts and excerpts of matching documents."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from wordloom.sizing import bounded, hint, join_by_term
from wordloom.sources.batch import QueryBatch
from wordloom.sources.corpus import Corpus, term_counts


def keywords(corpus: Corpus, batch: QueryBatch) -> DataFrame:
    """Each word of each query text with its documents and hits in the corpus."""
    counts = term_counts(corpus, batch.terms, batch.small)
    joined = join_by_term(batch.terms, counts, batch.small, ["query_id", "qpos"], "left")
    return joined.select(
        "query_id",
        "qpos",
        "term",
        F.coalesce("docs", F.lit(0)).alias("docs"),
        F.coalesce("hits", F.lit(0)).alias("hits"),
    )


def _first_spot(words: Column) -> Column:
    """Position, from 1, of the first of the query words in ``list``; null without one."""
    spots = F.transform("list", lambda term: F.array_position(words, term))
    return F.array_min(F.filter(spots, lambda spot: spot > 0))


def excerpts(
    corpus: Corpus,
    batch: QueryBatch,
    matches: DataFrame,
    around: int = 5,
    rows: int | None = None,
) -> DataFrame:
    """For each match the words around its first hit: query_id, keys, field, pos, excerpt.

    The first hit is the lowest position of the first field that has one. Matches
    are a page of results, of at most ``rows`` rows; when that bound is small they are
    broadcast and the corpus is scanned in place, otherwise Spark chooses the join.
    Each match then finds its first hit in its own word lists.
    """
    keys = list(corpus.keys)
    wanted = matches.select("query_id", *keys)
    # The page meets whole texts; only its documents are split into words.
    met = corpus.df.join(hint(wanted, bounded(wanted, rows)), keys)
    found = replace(corpus, df=met, attrs=("query_id",)).lists.select(*keys, "query_id", "words")
    found = found.join(hint(batch.info.select("query_id", "list"), batch.small), "query_id")
    places = []
    for i, field in enumerate(corpus.fields):
        words = F.col("words")[i]
        first = _first_spot(words)
        place = F.struct(
            F.lit(field).alias("field"), (first - 1).cast("int").alias("pos"), words.alias("text")
        )
        places.append(F.when(first.isNotNull(), place))
    found = found.select("query_id", *keys, F.coalesce(*places).alias("hit"))
    start = F.greatest(F.col("hit.pos") - around, F.lit(0))
    length = F.col("hit.pos") + around + 1 - start
    return found.where(F.col("hit").isNotNull()).select(
        "query_id",
        *keys,
        F.col("hit.field").alias("field"),
        F.col("hit.pos").alias("pos"),
        F.array_join(F.slice(F.col("hit.text"), start + 1, length), " ").alias("excerpt"),
    )
