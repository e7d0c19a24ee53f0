"""Batches of queries as DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from wordloom.codes import GROUP_FUNCTIONS, MATCH_MODES, PAGE_BOUND, RANKERS, SORT_MODES
from wordloom.functions.text import words
from wordloom.sizing import Size

# A bigint holds this many query positions as single bits.
MASK_BITS = 62
# Distinct words of a batch that one document is taken to hold, at most.
MET_WORDS = 256


@dataclass(frozen=True)
class QueryBatch:
    """Many queries answered in one pass.

    ``info`` has one row per query: query_id, comment, status and message (see
    ``validate_queries``), qlen, n_terms (distinct words) and ``list``, its words in order. ``small`` says that the words were
    measured and may be broadcast; ``max_len`` is the longest query and ``queries``
    their number.
    """

    info: DataFrame
    small: bool
    max_len: int
    queries: int

    def words(self, marker: str | None = None) -> DataFrame:
        """One row per query word: query_id, qpos, term, first_qpos, before, qlen, n_terms.

        ``first_qpos`` is the position of the first equal word of the query, ``before``
        the word one position earlier. With a ``marker`` each query ends with that word.
        """
        listed = F.col("list") if marker is None else F.concat("list", F.array(F.lit(marker)))
        exploded = self.info.select(
            "query_id", "qlen", "n_terms", "list", F.posexplode_outer(listed).alias("qpos", "term")
        )
        first = (F.array_position("list", F.col("term")) - 1).cast("int")
        before = F.get("list", F.col("qpos") - 1)
        return exploded.where(F.col("term").isNotNull()).select(
            "query_id",
            "qpos",
            "term",
            first.alias("first_qpos"),
            before.alias("before"),
            "qlen",
            "n_terms",
        )

    @property
    def terms(self) -> DataFrame:
        """The query words, see ``words``."""
        return self.words()

    @property
    def lead_terms(self) -> DataFrame:
        """Each distinct word of each query once."""
        return self.terms.where(F.col("qpos") == F.col("first_qpos"))

    @property
    def rows_per_document(self) -> int:
        """About how many rows a document makes at most: one per query, one per word met."""
        return self.queries + min(self.queries * self.max_len, MET_WORDS)

    @property
    def fits_mask(self) -> bool:
        return self.max_len <= MASK_BITS


def query_batch(queries: DataFrame) -> QueryBatch:
    """Batch from (query_id, text[, comment]); texts are split by the corpus rule.

    Measures the query words with one aggregate, to decide on a broadcast.
    """
    comment = F.col("comment") if "comment" in queries.columns else F.lit("")
    info = queries.select(
        F.col("query_id").cast("bigint").alias("query_id"),
        comment.alias("comment"),
        words("text").alias("list"),
        F.col("text").isNull().alias("missing"),
    ).select(
        "query_id",
        "comment",
        F.when(F.col("missing"), "error")
        .when(F.size("list") == 0, "warning")
        .otherwise("ok")
        .alias("status"),
        F.when(F.col("missing"), "query text is missing")
        .when(F.size("list") == 0, "query has no words")
        .otherwise("")
        .alias("message"),
        F.size("list").alias("qlen"),
        F.size(F.array_distinct("list")).alias("n_terms"),
        "list",
    )
    # Width of a row of ``terms``: six columns of 8 bytes, the row header and two words.
    length = 2 * F.octet_length(F.array_join("list", "")) + 64 * F.col("qlen")
    row = info.agg(
        F.count(F.lit(1)),
        F.sum("qlen"),
        F.sum(length.cast("bigint")),
        F.max("qlen"),
        F.count_distinct(F.struct("query_id")),
    ).first()
    if row[0] != row[4]:
        raise ValueError("a query_id occurs twice")
    return QueryBatch(
        info=info,
        small=Size(row[1] or 0, row[2] or 0).small,
        max_len=row[3] or 0,
        queries=row[0],
    )


def _rules(columns: list[str]) -> list[tuple[str, Column, str]]:
    """(status, condition that a bad query meets, message) for the columns present."""

    def outside(column: str, codes: dict[str, int]) -> Column:
        return ~F.col(column).isin(list(codes.values()))

    checks = [
        (["offset"], "error", lambda: ~F.col("offset").between(0, PAGE_BOUND - 1), "offset out of range"),
        (["limit"], "error", lambda: ~F.col("limit").between(1, PAGE_BOUND - 1), "limit out of range"),
        (["max_matches"], "error", lambda: F.col("max_matches") < 0, "max_matches is negative"),
        (["mode"], "error", lambda: outside("mode", MATCH_MODES), "unknown match mode"),
        (["ranker"], "error", lambda: outside("ranker", RANKERS), "unknown ranker"),
        (["sort"], "error", lambda: outside("sort", SORT_MODES), "unknown sort mode"),
        (["groupfunc"], "error", lambda: outside("groupfunc", GROUP_FUNCTIONS), "unknown group function"),
        (["min_id", "max_id"], "error", lambda: F.col("min_id") > F.col("max_id"), "id range is reversed"),
        (["filter_min", "filter_max"], "error", lambda: F.col("filter_min") > F.col("filter_max"), "filter range is reversed"),
        (["text"], "error", lambda: F.col("text").isNull(), "query text is missing"),
        (["text"], "warning", lambda: F.size(words("text")) == 0, "query has no words"),
    ]
    return [
        (status, condition(), message)
        for needed, status, condition, message in checks
        if set(needed) <= set(columns)
    ]


def validate_queries(queries: DataFrame) -> DataFrame:
    """``queries`` plus status ('ok', 'warning', 'error') and message.

    The first rule a query breaks names its status; errors come before warnings.
    A setting that is null is read as its default and breaks no rule.
    """
    status: Column = F.lit("ok")
    message: Column = F.lit("")
    for level, broken, text in reversed(_rules(queries.columns)):
        status = F.when(broken, F.lit(level)).otherwise(status)
        message = F.when(broken, F.lit(text)).otherwise(message)
    return queries.withColumn("status", status).withColumn("message", message)
