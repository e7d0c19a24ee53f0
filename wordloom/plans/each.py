"""A batch in which every query has its own settings, as rows of a table.

Queries of different modes, rankers, filters and orders share one pass over the texts and one
table of ranking factors: what a query keeps, how it weighs and how it sorts are expressions
over its factors and its own settings, which are joined to the matches. A query with a bad
setting is reported in the summary and the others run.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from wordloom.codes import (
    DEFAULT_LIMIT,
    DEFAULT_MAX_MATCHES,
    MATCH_MODES,
    RANKERS,
    SORT_MODES,
)
from wordloom.functions.text import words
from wordloom.operators.factors import factors
from wordloom.operators.ordering import best_rows
from wordloom.operators.ranking import NEEDS, PACKED, weight_column
from wordloom.plans.search import SearchResult, result_matches, word_stats
from wordloom.sizing import few, hint
from wordloom.sources.batch import query_batch, validate_queries
from wordloom.sources.corpus import Corpus
from wordloom.sources.term_index import TermIndex

#: Settings with their types and defaults; a null or missing one takes the default.
SETTINGS: dict[str, tuple[str, object]] = {
    "mode": ("int", MATCH_MODES["all"]),
    "ranker": ("int", RANKERS["proximity_bm25"]),
    "sort": ("int", SORT_MODES["relevance"]),
    "sort_by": ("string", None),
    "offset": ("int", 0),
    "limit": ("int", DEFAULT_LIMIT),
    "max_matches": ("int", DEFAULT_MAX_MATCHES),
    "cutoff": ("int", 0),
    "min_id": ("bigint", 0),
    "max_id": ("bigint", 0),
    "field_weights": ("map<string,int>", None),
    "comment": ("string", ""),
}
MODES = ("all", "any", "phrase")
SORTS = ("relevance", "attr_desc", "attr_asc")


def _settings(corpus: Corpus, queries: DataFrame) -> DataFrame:
    """Every setting of every query, with status and message."""
    given = [
        (F.col(name) if name in queries.columns else F.lit(None)).cast(kind).alias(name)
        for name, (kind, _) in SETTINGS.items()
    ]
    rows = queries.select(F.col("query_id").cast("bigint").alias("query_id"), "text", *given)
    rows = validate_queries(rows)
    for name, (kind, default) in SETTINGS.items():
        if default is not None:
            rows = rows.withColumn(name, F.coalesce(name, F.lit(default).cast(kind)))
    unset = F.col("max_matches") == 0
    bound = F.when(unset, DEFAULT_MAX_MATCHES).otherwise(F.col("max_matches"))
    rows = rows.withColumn("max_matches", bound)
    heaviest = sum((F.abs(w).cast("bigint") for w in _weights(corpus)), F.lit(0))
    heaviest = heaviest * max(PACKED.values()) * F.size(words("text"))
    named = F.map_keys("field_weights")
    known = F.coalesce(F.col("sort_by").isin(*corpus.attrs), F.lit(False))
    sorts = F.col("sort") != SORT_MODES["relevance"]
    rules = [
        (~_is("mode", MATCH_MODES, MODES), "this mode takes a batch of its own"),
        (_is("ranker", RANKERS, ["expr"]), "a rank expression takes a batch of its own"),
        (~_is("sort", SORT_MODES, SORTS), "this sort takes a batch of its own"),
        (sorts & ~known, "unknown sort attribute"),
        (F.col("cutoff") < 0, "cutoff is negative"),
        (F.col("offset") + F.col("limit") > F.col("max_matches"), "page beyond max_matches"),
        (F.size(F.array_except(named, F.array(*map(F.lit, corpus.fields)))) > 0, "unknown field"),
        (_is("ranker", RANKERS, PACKED) & (heaviest >= 1 << 31), "field weights too large"),
    ]
    broken = F.coalesce(*[F.when(rule, said) for rule, said in rules])
    fine = F.col("status") != "error"
    rows = rows.withColumn("__broken", F.when(fine, broken))
    wrong = F.col("__broken").isNotNull()
    return rows.withColumns(
        {
            "message": F.coalesce("__broken", "message"),
            "status": F.when(wrong, "error").otherwise(F.col("status")),
        }
    ).drop("__broken")


def _weights(corpus: Corpus) -> list[Column]:
    return [F.coalesce(F.element_at("field_weights", F.lit(f)), F.lit(1)) for f in corpus.fields]


def _is(column: str, codes: dict[str, int], names: object) -> Column:
    return F.col(column).isin([codes[n] for n in names])


def _either(cases: list[tuple[Column, Column]]) -> Column:
    """The value of the case that holds; null where none does."""
    return reduce(lambda rest, case: F.when(case[0], case[1]).otherwise(rest), cases, F.lit(None))


def _filtered(matches: DataFrame, filters: DataFrame, attrs: list[str], small: bool) -> DataFrame:
    """The matches that pass all filters of their query. A filter drops a null, an excluding
    one keeps it; a list passes when one of its values does."""
    lists = [
        F.collect_list(F.when(F.col("attr") == a, F.struct("lo", "hi", "exclude"))).alias(f"__f{i}")
        for i, a in enumerate(attrs)
    ]
    per_query = filters.groupBy("query_id").agg(*lists)
    joined = matches.join(hint(per_query, small), "query_id", "left")
    for i, attr in enumerate(attrs):
        listed = isinstance(matches.schema[attr].dataType, T.ArrayType)
        passed = F.forall(f"__f{i}", _inside(attr, listed))
        joined = joined.where(F.coalesce(passed, F.lit(True))).drop(f"__f{i}")
    return joined


def _inside(attr: str, listed: bool) -> Callable[[Column], Column]:
    """Whether an attribute passes a filter."""

    def test(f: Column) -> Column:
        if listed:
            found = F.exists(F.col(attr), lambda x: x.between(f["lo"], f["hi"]))
        else:
            found = F.col(attr).between(f["lo"], f["hi"])
        return F.coalesce(found, F.lit(False)) != f["exclude"]

    return test


def search_each(
    corpus: Corpus, queries: DataFrame, filters: DataFrame | None = None
) -> SearchResult:
    """Run every query of ``queries`` with its own settings.

    ``queries`` has query_id, text and any of ``SETTINGS``: modes all, any and phrase, every
    ranker but the expression, relevance and attribute sorts with ``sort_by``. ``filters`` has
    query_id, attr, lo, hi and exclude, several for a query: all must hold. Modes by clauses,
    full scans, groups and expressions have no place in the shared pass: such a query is reported.
    """
    settings = _settings(corpus, queries)
    info = settings.select("query_id", "max_matches", "status", "message", "comment")
    good = settings.where(F.col("status") != "error")
    batch = query_batch(good.select("query_id", "text", "comment"))
    small = few(batch.queries) and batch.small
    # One small row per kind of query: at most modes x rankers x attributes x two.
    kinds = good.select("mode", "ranker", "sort", "sort_by").distinct().collect()
    modes = {name for name in MODES for r in kinds if r["mode"] == MATCH_MODES[name]}
    rankers = sorted(n for n, code in RANKERS.items() if code in {r["ranker"] for r in kinds})
    sorted_by = {r["sort_by"] for r in kinds if r["sort"] != SORT_MODES["relevance"]}
    filtered_by: set[str] = set()
    if filters is not None:
        filtered_by = {r[0] for r in filters.select("attr").distinct().collect()}
        if filtered_by - set(corpus.attrs):
            raise ValueError(f"no such attributes: {sorted(filtered_by - set(corpus.attrs))}")
    if isinstance(corpus, TermIndex):
        corpus = corpus.opened(batch.terms)
    table = factors(
        corpus,
        batch,
        runs="phrase" in modes or any(NEEDS[r].runs for r in rankers),
        scored=any(NEEDS[r].scored for r in rankers),
        ends="boosted" in rankers,
        carry=sorted(sorted_by | filtered_by),
    )
    own = good.drop("text", "comment", "status", "message")
    matches = table.join(hint(own, small), "query_id")

    keeps = [(_is("mode", MATCH_MODES, ["any"]), F.lit(True))]
    keeps.append((_is("mode", MATCH_MODES, ["all"]), F.col("matched_terms") == F.col("n_terms")))
    if "phrase" in modes:
        keeps.append((_is("mode", MATCH_MODES, ["phrase"]), F.col("best_run") == F.col("qlen")))
    low = (F.col("min_id") == 0) | (F.col("doc_id") >= F.col("min_id"))
    high = (F.col("max_id") == 0) | (F.col("doc_id") <= F.col("max_id"))
    matches = matches.where(_either(keeps) & low & high)
    if filtered_by:
        matches = _filtered(matches, filters, sorted(filtered_by), small)

    weights = _weights(corpus)
    weighs = [(_is("ranker", RANKERS, [r]), weight_column(r, weights)) for r in rankers]
    packed = [r for r in rankers if r in PACKED]
    exact = F.lit(None).cast("bigint")
    if packed:
        exact = F.when(_is("ranker", RANKERS, packed), F.col("bm25"))
    relevant = F.col("sort") == SORT_MODES["relevance"]
    matches = matches.select(
        "query_id",
        *corpus.keys,
        *sorted(sorted_by),
        *["sort", "sort_by", "offset", "limit", "cutoff"],
        _either(weighs).cast("bigint").alias("weight"),
        exact.alias("__exact"),
    )
    most = own.agg(F.max("cutoff"), F.max(F.col("offset") + F.col("limit"))).first()
    if most[0]:
        first = best_rows(matches.where("cutoff > 0"), [], most[0], corpus.keys, rank="__cut")
        first = first.where(F.col("__cut") <= F.col("cutoff")).drop("__cut")
        matches = matches.where("cutoff = 0").unionByName(first)

    order: list[Column] = []
    for attr in sorted(sorted_by):
        mine = F.col("sort_by") == attr
        falling = F.when(mine & (F.col("sort") == SORT_MODES["attr_desc"]), F.col(attr))
        rising = F.when(mine & (F.col("sort") == SORT_MODES["attr_asc"]), F.col(attr))
        order += [falling.desc_nulls_last(), rising.asc_nulls_last()]
    order += [F.when(relevant, F.col(c)).desc_nulls_last() for c in ("weight", "__exact")]
    best = best_rows(matches, order, most[1] or 1, corpus.keys)
    on_page = (F.col("rank") - F.col("offset")).between(1, F.col("limit"))
    page = best.where(on_page).select("query_id", "rank", *corpus.keys, "weight")
    counts = matches.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    found = F.coalesce("n", F.lit(0))
    summary = info.join(counts, "query_id", "left").select(
        "query_id",
        F.least(found, F.col("max_matches")).alias("total"),
        found.alias("total_found"),
        *["status", "message", "comment"],
    )
    rows = (most[1] or 1) * batch.queries
    return SearchResult(result_matches(corpus, page, rows=rows), summary, word_stats(corpus, batch))
