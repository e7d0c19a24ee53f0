"""Weights of matches.

Each ranker is an expression over the factor columns. Definitions are ours where
only a name fixes the ranker; no score is claimed to equal any other system's.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from wordloom.codes import RANKERS, code_name
from wordloom.operators.factors import B, K1, factors, minor
from wordloom.sources.batch import QueryBatch
from wordloom.sources.corpus import Corpus

Weights = Mapping[str, int] | Sequence[int] | None


@dataclass(frozen=True)
class Needs:
    """Which factors a ranker reads."""

    runs: bool
    scored: bool


NEEDS = {
    "proximity_bm25": Needs(runs=True, scored=True),
    "bm25": Needs(runs=False, scored=True),
    "none": Needs(runs=False, scored=False),
    "wordcount": Needs(runs=False, scored=False),
    "proximity": Needs(runs=True, scored=False),
    "matchany": Needs(runs=True, scored=False),
    "fieldmask": Needs(runs=False, scored=False),
    "boosted": Needs(runs=True, scored=True),
    "expr": Needs(runs=True, scored=True),
}


def field_weight_list(corpus: Corpus, weights: Weights) -> list[int]:
    """One weight per field from weights by name or by position; 1 where none is given."""
    if weights is None:
        return [1] * len(corpus.fields)
    if isinstance(weights, Mapping):
        unknown = set(weights) - set(corpus.fields)
        if unknown:
            raise ValueError(f"no such fields: {sorted(unknown)}")
        return [int(weights.get(f, 1)) for f in corpus.fields]
    given = [int(w) for w in weights]
    if len(given) > len(corpus.fields):
        raise ValueError("more weights than fields")
    return given + [1] * (len(corpus.fields) - len(given))


def _weighted(prefixes: Mapping[str, int], weights: list[int]) -> Column:
    """Sum over fields of weight * sum of (multiple * factor)."""
    result: Column = F.lit(0).cast("bigint")
    for i, weight in enumerate(weights):
        for prefix, multiple in prefixes.items():
            result = result + F.lit(weight).cast("bigint") * multiple * F.col(f"{prefix}_{i}")
    return result


def weight_column(ranker: str | int, weights: list[int], expr: str | None = None) -> Column:
    """The weight of a row of factors."""
    name = code_name(RANKERS, ranker)
    if name == "none":
        return F.lit(1).cast("bigint")
    if name == "bm25":
        return F.col("bm25")
    if name == "wordcount":
        return _weighted({"hits": 1}, weights)
    if name == "fieldmask":
        return F.col("field_mask")
    if name == "proximity":
        return _weighted({"lcs": 1}, weights)
    if name == "proximity_bm25":
        return F.shiftleft(_weighted({"lcs": 1}, weights), 32) + minor(F.col("bm25"))
    if name == "boosted":
        major = _weighted({"lcs": 4, "head": 2, "exact": 1}, weights)
        return F.shiftleft(major, 32) + minor(F.col("bm25"))
    if name == "matchany":
        result: Column = F.lit(0).cast("bigint")
        for i, weight in enumerate(weights):
            here = F.col(f"lcs_{i}") * F.col("qlen") + F.col(f"terms_{i}")
            result = result + F.lit(weight).cast("bigint") * here
        return result
    if expr is None:
        raise ValueError("the expr ranker needs an expression")
    return F.expr(expr)


def expression_factors(df: DataFrame, weights: list[int]) -> DataFrame:
    """``df`` plus the names a rank expression may use.

    bm25, sum_lcs, hit_count, word_count, field_mask, doc_len.
    """
    return df.withColumns(
        {
            "sum_lcs": _weighted({"lcs": 1}, weights),
            "hit_count": _weighted({"hits": 1}, [1] * len(weights)),
            "word_count": F.col("matched_terms"),
        }
    )


# What the packed rankers multiply a field weight by, at most, per word of a run.
PACKED = {"proximity_bm25": 1, "boosted": 7}


def _check_packed(name: str, weights: list[int], batch: QueryBatch) -> None:
    """Refuse field weights whose major part could leave its 31 bits."""
    most = sum(abs(w) for w in weights) * PACKED[name] * max(1, batch.max_len)
    if most >= 1 << 31:
        raise ValueError("field weights too large for a packed weight")


def ranked(
    corpus: Corpus,
    batch: QueryBatch,
    ranker: str | int = "proximity_bm25",
    mode: str = "any",
    field_weights: Weights = None,
    expr: str | None = None,
    carry: Sequence[str] = (),
    stats: Corpus | None = None,
    k1: float = K1,
    b: float = B,
    exact: bool = False,
) -> DataFrame:
    """(query_id, keys, carried attributes, weight) of the matches by words or phrase.

    One factor table serves the selection and the weight: a document holds all
    words when its matched words are the query's, and the phrase when its longest
    run is the query's length. With ``exact`` the rankers that pack BM25 into the low 32
    bits also give it whole, as ``bm25``, for ``relevance`` to order by.
    """
    name = code_name(RANKERS, ranker)
    needs = NEEDS[name]
    table = factors(
        corpus,
        batch,
        runs=needs.runs or mode == "phrase",
        scored=needs.scored,
        ends=name == "boosted",
        carry=carry,
        stats=stats,
        k1=k1,
        b=b,
    )
    if mode == "all":
        table = table.where(F.col("matched_terms") == F.col("n_terms"))
    elif mode == "phrase":
        table = table.where(F.col("best_run") == F.col("qlen"))
    elif mode != "any":
        raise ValueError(f"mode {mode!r} selects by clauses, see match_extended")
    weights = field_weight_list(corpus, field_weights)
    if name == "expr":
        table = expression_factors(table, weights)
    if name in PACKED:
        _check_packed(name, weights, batch)
    weight = weight_column(name, weights, expr).alias("weight")
    whole = ["bm25"] if exact and name in PACKED else []
    return table.select("query_id", *corpus.keys, *carry, weight, *whole)


def rank_proximity_bm25(
    corpus: Corpus, batch: QueryBatch, field_weights: Weights = None
) -> DataFrame:
    """Weighted longest runs in the high 32 bits, BM25 in the low 32. Keeps both parts."""
    table = factors(corpus, batch, runs=True, scored=True)
    weights = field_weight_list(corpus, field_weights)
    _check_packed("proximity_bm25", weights, batch)
    return table.select(
        "query_id",
        *corpus.keys,
        weight_column("proximity", weights).alias("major"),
        minor(F.col("bm25")).alias("minor"),
        weight_column("proximity_bm25", weights).alias("weight"),
    )


def rank_bm25(corpus: Corpus, batch: QueryBatch, k1: float = K1, b: float = B) -> DataFrame:
    """BM25 in millionths, each word's share rounded on its own."""
    return ranked(corpus, batch, "bm25", k1=k1, b=b)


def rank_none(matches: DataFrame) -> DataFrame:
    """Weight 1 for every match."""
    return matches.withColumn("weight", F.lit(1).cast("bigint"))


def rank_wordcount(corpus: Corpus, batch: QueryBatch, field_weights: Weights = None) -> DataFrame:
    """Weighted number of occurrences of query words per field."""
    return ranked(corpus, batch, "wordcount", field_weights=field_weights)


def rank_proximity(corpus: Corpus, batch: QueryBatch, field_weights: Weights = None) -> DataFrame:
    """Weighted longest run of query words, in query order and adjacent, per field."""
    return ranked(corpus, batch, "proximity", field_weights=field_weights)


def rank_matchany(corpus: Corpus, batch: QueryBatch, field_weights: Weights = None) -> DataFrame:
    """Weighted (longest run * query length + distinct query words) per field."""
    return ranked(corpus, batch, "matchany", field_weights=field_weights)


def rank_fieldmask(corpus: Corpus, batch: QueryBatch) -> DataFrame:
    """Bit i is set when field i holds a query word."""
    return ranked(corpus, batch, "fieldmask")


def rank_boosted(corpus: Corpus, batch: QueryBatch, field_weights: Weights = None) -> DataFrame:
    """Weighted (4 * run + 2 if the first query word opens the field + 1 if the field
    is the query) in the high 32 bits, BM25 in the low 32."""
    return ranked(corpus, batch, "boosted", field_weights=field_weights)


def rank_expr(
    corpus: Corpus, batch: QueryBatch, expr: str, field_weights: Weights = None
) -> DataFrame:
    """A Spark SQL expression over the names of ``expression_factors``."""
    return ranked(corpus, batch, "expr", expr=expr, field_weights=field_weights)


def apply_index_weights(matches: DataFrame, weights: Mapping[str, int]) -> DataFrame:
    """Multiply the weight of each match by that of its index; 1 where none is given."""
    factor: Column = F.lit(1)
    for name, weight in weights.items():
        factor = F.when(F.col("index_name") == name, F.lit(int(weight))).otherwise(factor)
    return matches.withColumn("weight", F.col("weight") * factor)
