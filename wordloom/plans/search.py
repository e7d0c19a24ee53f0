"""A batch of queries from words to pages of matches, totals and word statistics."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from wordloom.codes import (
    DEFAULT_LIMIT,
    DEFAULT_MAX_MATCHES,
    DEFAULT_OFFSET,
    MATCH_MODES,
    RANKERS,
    code_name,
)
from wordloom.operators.attributes import override, select
from wordloom.operators.clauses import ClauseBatch, match_boolean, match_extended, ranking_batch
from wordloom.operators.filters import Filter, apply_filters, filter_id_range
from wordloom.operators.grouping import GROUP_SORT, group_best, group_by, page_groups
from wordloom.operators.matching import match_fullscan
from wordloom.operators.ordering import Order, cutoff, page, relevance
from wordloom.operators.ranking import Weights, apply_index_weights, rank_none, ranked
from wordloom.sizing import bounded, checkpointed, hint, join_by_term
from wordloom.sources.batch import QueryBatch
from wordloom.sources.corpus import Corpus, term_counts
from wordloom.sources.term_index import TermIndex

CLAUSE_MODES = ("boolean", "extended", "extended2")


@dataclass(frozen=True)
class Group:
    """Grouping of a search: attribute, function, distinct attribute and group order."""

    attr: str | Sequence[str]
    func: str | int = "day"
    distinct: str | None = None
    groupsort: Sequence[tuple[str, str]] = GROUP_SORT


@dataclass(frozen=True)
class SearchResult:
    """``matches`` is the page per query, ``summary`` the totals, ``word_stats`` the words."""

    matches: DataFrame
    summary: DataFrame
    word_stats: DataFrame


def result_matches(
    corpus: Corpus,
    best: DataFrame,
    items: Sequence[str] = ("*",),
    rows: int | None = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Attributes of the ranked page, joined last.

    A page has at most ``rows`` rows; when that bound is small it is broadcast and
    the corpus scanned in place, reading keys and attributes only. Otherwise Spark
    chooses the join from the sizes that it meets.
    """
    missing = [a for a in corpus.attrs if a not in best.columns]
    if missing:
        documents = corpus.df.select(*corpus.keys, *missing)
        best = documents.join(hint(best, bounded(best, rows)), list(corpus.keys))
    front = ["query_id", "rank", *extra, *corpus.keys, "weight"]
    best = best.select(*front, *corpus.attrs)
    if list(items) == ["*"]:
        return best
    return select(best, [*front, *[i for i in items if i not in front]])


def result_summary(
    info: DataFrame, matches: DataFrame, bound: int = DEFAULT_MAX_MATCHES
) -> DataFrame:
    """Per query: total_found matches (or groups), total kept, and its comment.

    Matches are counted on the map side; a query without matches has zeros. A batch's own
    status and message of each query come along.
    """
    counts = matches.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    found = F.coalesce("n", F.lit(0))
    known = [c for c in ("status", "message") if c in info.columns]
    return info.join(counts, "query_id", "left").select(
        "query_id",
        F.least(found, F.lit(bound)).alias("total"),
        found.alias("total_found"),
        *known,
        "comment",
    )


def word_stats(corpus: Corpus, batch: QueryBatch) -> DataFrame:
    """Per distinct query word: documents that hold it and its occurrences."""
    counts = term_counts(corpus, batch.terms, batch.small)
    joined = join_by_term(batch.lead_terms, counts, batch.small, ["query_id"], "left")
    return joined.select(
        "query_id",
        F.col("term").alias("word"),
        F.coalesce("docs", F.lit(0)).alias("docs"),
        F.coalesce("hits", F.lit(0)).alias("hits"),
    )


def search(
    corpus: Corpus,
    queries: QueryBatch | ClauseBatch | None,
    mode: str | int = "all",
    ranker: str | int = "proximity_bm25",
    rank_expr: str | None = None,
    field_weights: Weights = None,
    index_weights: Mapping[str, int] | None = None,
    filters: Sequence[Filter] = (),
    id_range: tuple[int, int] = (0, 0),
    overrides: Mapping[str, DataFrame] | None = None,
    sort: Order | Callable[[DataFrame], Order] | None = None,
    carry: Sequence[str] = (),
    group: Group | None = None,
    offset: int = DEFAULT_OFFSET,
    limit: int = DEFAULT_LIMIT,
    max_matches: int = DEFAULT_MAX_MATCHES,
    cutoff_at: int = 0,
    items: Sequence[str] = ("*",),
    keep: bool = False,
) -> SearchResult:
    """Run every query of a batch in one pass.

    Filters run on the corpus before its texts are split; statistics for BM25 come
    from the whole corpus. Attributes named in ``carry`` travel with the words
    because a sort, group, override or rank expression reads them per match; all
    others are joined to the final page. ``sort`` is an order or a function of the
    matches giving one. A ``group`` with a ``sort`` or ``items`` gives per group the match that
    comes first in that order, with its attributes; ``group`` alone gives the match of best
    weight. A page beyond ``max_matches`` is an error. ``keep`` checkpoints the weighted matches in the folder the
    session names, so the page, the totals and a lost executor do not repeat the
    pass over the texts.
    """
    mode = code_name(MATCH_MODES, mode)
    bound = max_matches or DEFAULT_MAX_MATCHES
    if offset + limit > bound:
        raise ValueError(f"offset + limit is beyond max_matches ({bound})")
    changed = dict(overrides or {})
    late = [f for f in filters if getattr(f, "attr", None) in changed]
    early = [f for f in filters if f not in late]
    carried = list(dict.fromkeys([*carry, *changed, *_group_attrs(group)]))

    df = apply_filters(filter_id_range(corpus.df, *id_range), early)
    chosen, attached = replace(corpus, df=df), []
    if isinstance(corpus, TermIndex) and queries is not None:
        # Postings have no attributes: the matches join the documents that are left.
        chosen = corpus = corpus.opened(queries.terms)
        narrowed = bool(early or carried or id_range != (0, 0))
        carried, attached = [], carried
    by_clause = isinstance(queries, ClauseBatch)
    if by_clause != (mode in CLAUSE_MODES) or (queries is None) != (mode == "fullscan"):
        raise ValueError(f"mode {mode!r} does not take this kind of batch")
    batch = ranking_batch(queries) if by_clause else queries
    keys = ["query_id", *corpus.keys]
    if mode == "fullscan":
        matches = match_fullscan(chosen).select(*keys, *carried, "weight")
    elif by_clause and code_name(RANKERS, ranker) == "none":
        # Nothing to weigh: the texts are split once, for the clauses.
        select_by = match_boolean if mode == "boolean" else match_extended
        matches = rank_none(select_by(chosen, queries, carried))
    else:
        found_by_words = ranked(
            chosen,
            batch,
            ranker,
            "any" if by_clause else mode,
            field_weights,
            rank_expr,
            () if by_clause else carried,
            stats=corpus if early or id_range != (0, 0) else None,
            exact=True,
        )
        if by_clause:
            select_by = match_boolean if mode == "boolean" else match_extended
            # Documents found without any of the words to rank by weigh 1.
            matches = select_by(chosen, queries, carried).join(found_by_words, keys, "left")
            matches = matches.withColumn("weight", F.coalesce("weight", F.lit(1)))
        else:
            matches = found_by_words
    if isinstance(corpus, TermIndex) and queries is not None and narrowed:
        matches = matches.join(df.select(*corpus.keys, *attached), list(corpus.keys))
    if index_weights:
        matches = apply_index_weights(matches, index_weights)
    for attr, values in changed.items():
        matches = override(matches, attr, values, corpus.keys)
    matches = cutoff(apply_filters(matches, late), cutoff_at, corpus.keys)
    if keep:
        matches = checkpointed(matches)

    order = sort(matches) if callable(sort) else sort or relevance(matches)
    rows = limit * (batch.queries if batch is not None else 1)
    if group is not None and (sort is not None or list(items) != ["*"]):
        if group.distinct:
            raise ValueError("a distinct count does not go with a sort or select list")
        found = group_best(matches, group.attr, group.func, order, corpus.keys)
        best = page_groups(found, group.groupsort, offset, limit, bound)
        names = [c for c in ("group_key", "group_key2", "count") if c in best.columns]
        paged = result_matches(corpus, best, items, rows, names)
    elif group is not None:
        found = group_by(matches, group.attr, group.func, group.distinct, keys=corpus.keys)
        paged = page_groups(found, group.groupsort, offset, limit, bound)
    else:
        found = matches
        best = page(matches, offset, limit, order, corpus.keys, bound)
        paged = result_matches(corpus, best, items, rows)
    info = _one_query(corpus) if batch is None else batch.info
    return SearchResult(
        matches=paged,
        summary=result_summary(info, found, bound),
        word_stats=word_stats(corpus, batch) if batch is not None else None,
    )


def _one_query(corpus: Corpus) -> DataFrame:
    """The single query of a full scan."""
    one = corpus.df.sparkSession.range(1)
    return one.select(F.col("id").alias("query_id"), F.lit("").alias("comment"))


def _group_attrs(group: Group | None) -> list[str]:
    if group is None:
        return []
    attrs = [group.attr] if isinstance(group.attr, str) else list(group.attr)
    return attrs + ([group.distinct] if group.distinct else [])
