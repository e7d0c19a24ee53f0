"""Word tables of a corpus: every word with its position, or each word once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wordloom.sources.corpus import MARKER, Corpus
from wordloom.sources.term_index import TermIndex


def positions(
    corpus: Corpus, carry: Sequence[str] = (), marker: bool = False, previous: bool = False
) -> DataFrame:
    """One row per word: keys, carried attributes, field_no, field_len, pos, term, doc_len.

    With ``previous`` also the word before it in the field, null for the first. With
    ``marker`` every document also has one row with the marker word. The
    outer form of explode keeps Spark from adding a filter that would tokenise
    the text a second time; its null row for an empty list never joins a query.
    """
    if isinstance(corpus, TermIndex):
        return corpus.positions(carry, marker, previous)
    lists = corpus.lists
    kept = [*corpus.keys, *carry, "doc_len"]
    if len(corpus.fields) == 1:
        one = lists.select(
            *kept,
            F.lit(0).alias("field_no"),
            F.size(F.col("words")[0]).alias("field_len"),
            F.col("words")[0].alias("list"),
        )
    else:
        one = lists.select(*kept, F.posexplode_outer("words").alias("field_no", "list"))
        one = one.withColumn("field_len", F.size("list"))
    if marker:
        extra = F.when(F.col("field_no") == 0, F.array(F.lit(MARKER)))
        extra = extra.otherwise(F.array().cast("array<string>"))
        one = one.withColumn("list", F.concat("list", extra))
    kept += ["field_no", "field_len"]
    if not previous:
        return one.select(*kept, F.posexplode_outer("list").alias("pos", "term"))
    shifted = F.concat(F.array(F.lit(None).cast("string")), F.col("list"))
    pairs = one.select(*kept, F.posexplode_outer(F.arrays_zip("list", shifted)).alias("pos", "pair"))
    # The shifted list is one longer: its last pair has no word of its own.
    return pairs.select(
        *kept, "pos", F.col("pair")["list"].alias("term"), F.col("pair")["1"].alias("previous")
    )


def field_counts(corpus: Corpus, carry: Sequence[str] = (), marker: bool = False) -> DataFrame:
    """Each distinct word of each field once: keys, carried attributes, doc_len, field_no, term
    and its occurrences ``n``. With ``marker`` every document also has the marker word once.

    A field's words are sorted in their row and cut where the word changes: nothing is grouped.
    """
    if isinstance(corpus, TermIndex):
        return corpus.field_counts(carry, marker)
    lists = corpus.lists
    kept = [*corpus.keys, *carry, "doc_len", "field_no"]
    if len(corpus.fields) == 1:
        one = lists.withColumns({"field_no": F.lit(0), "list": F.col("words")[0]})
    else:
        one = lists.select(*kept[:-1], F.posexplode_outer("words").alias("field_no", "list"))
    listed = F.col("list")
    if marker:
        extra = F.when(F.col("field_no") == 0, F.array(F.lit(MARKER)))
        listed = F.concat(listed, extra.otherwise(F.array().cast("array<string>")))
    sorted_lists = one.select(*kept, F.sort_array(listed).alias("list"))
    changes = F.filter(
        F.sequence(F.lit(0), F.size("list") - 1),
        lambda i: (i == 0) | (F.get("list", i) != F.get("list", i - 1)),
    )
    starts = F.when(F.size("list") > 0, changes).otherwise(F.array().cast("array<int>"))
    counted = F.transform(
        "starts",
        lambda s, j: F.struct(
            F.get("list", s).alias("term"),
            (F.coalesce(F.get("starts", j + 1), F.size("list")) - s).alias("n"),
        ),
    )
    begun = sorted_lists.withColumn("starts", starts)
    words = begun.select(*kept, F.explode_outer(counted).alias("word"))
    return words.select(*kept, F.col("word.term").alias("term"), F.col("word.n").alias("n"))


def tokens(corpus: Corpus) -> DataFrame:
    """The token table: keys, field name, position in the field, lower-cased word."""
    names = F.array(*[F.lit(f) for f in corpus.fields])
    return (
        positions(corpus)
        .where(F.col("term").isNotNull())
        .select(*corpus.keys, names[F.col("field_no")].alias("field"), "pos", "term")
    )


def doc_terms(corpus: Corpus, carry: Sequence[str] = (), marker: bool = False) -> DataFrame:
    """Each distinct word of each document once: keys, carried attributes, doc_len, term."""
    if isinstance(corpus, TermIndex):
        return corpus.doc_terms(carry, marker)
    once = F.array_distinct(F.flatten("words"))
    if marker:
        once = F.concat(once, F.array(F.lit(MARKER)))
    return corpus.lists.select(
        *corpus.keys, *carry, "doc_len", F.explode_outer(once).alias("term")
    )
