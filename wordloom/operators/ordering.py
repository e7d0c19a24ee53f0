"""Orders of matches, and the best rows per query.

An order is a list of sort keys and always ends with the document key, because
equal weights are common. Sorting a whole result is Spark's range-partitioned sort;
ranks are given only to a bounded number of rows per query.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from wordloom.codes import DEFAULT_LIMIT, DEFAULT_MAX_MATCHES, DEFAULT_OFFSET, PAGE_BOUND
from wordloom.sizing import fan_in, few, hint
from wordloom.storage import stored, written

Order = list[Column]

# Ages that part the time segments.
SEGMENTS = (
    timedelta(hours=1),
    timedelta(days=1),
    timedelta(days=7),
    timedelta(days=30),
    timedelta(days=90),
)

# Names of computed columns in a sort clause.
SPECIAL_NAMES = {
    "@id": "doc_id",
    "@weight": "weight",
    "@group": "group_key",
    "@count": "count",
    "@distinct": "distinct",
}


def _direct(column: Column, desc: bool) -> Column:
    return column.desc_nulls_last() if desc else column.asc_nulls_last()


def relevance(df: DataFrame | None = None) -> Order:
    """Best weight first. Where ``df`` has the exact ``bm25`` beside a weight that packs it
    into 32 bits, it decides between weights that the packing made equal."""
    exact = [_direct(F.col("bm25"), True)] if df is not None and "bm25" in df.columns else []
    return [_direct(F.col("weight"), True), *exact]


def attribute(attr: str, desc: bool = True) -> Order:
    """By an attribute."""
    return [_direct(F.col(attr), desc)]


def extended(clauses: Sequence[tuple[str, str]]) -> Order:
    """By several columns, each with 'asc' or 'desc'; @id, @weight, @group, @count, @distinct too."""
    keys = []
    for name, direction in clauses:
        if direction not in ("asc", "desc"):
            raise ValueError(f"direction {direction!r} is neither 'asc' nor 'desc'")
        keys.append(_direct(F.col(SPECIAL_NAMES.get(name, name)), direction == "desc"))
    return keys


def expression(expr: str) -> Order:
    """By a Spark SQL expression, largest first."""
    return [_direct(F.expr(expr), True)]


def time_segment(df: DataFrame, ts: str, now: datetime) -> Column:
    """Age class of a timestamp at ``now``: 0 up to an hour, then day, week, 30 and 90 days, older."""
    kind = df.schema[ts].dataType
    segment: Column = F.lit(len(SEGMENTS))
    for i in reversed(range(len(SEGMENTS))):
        bound = F.lit((now - SEGMENTS[i]).isoformat(sep=" ")).cast(kind)
        segment = F.when(F.col(ts) >= bound, F.lit(i)).otherwise(segment)
    return segment


def time_segments(df: DataFrame, ts: str, now: datetime) -> Order:
    """Newest age class first, then best weight."""
    return [time_segment(df, ts, now).asc(), *relevance(df)]


def sort_matches(
    df: DataFrame, order: Order, keys: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The whole result in order, per query: a distributed sort, no rank column."""
    return df.orderBy("query_id", *order, *keys)


def best_rows(
    df: DataFrame,
    order: Order,
    k: int,
    keys: Sequence[str] = ("doc_id",),
    by: Sequence[str] = ("query_id",),
    rank: str = "rank",
) -> DataFrame:
    """The first ``k`` rows of each group with their rank.

    Spark trims each input partition to ``k`` rows per group. On a wide cluster the
    trimmed rows are first reduced in slices of the key, so a query matching a
    third of all documents never meets in one task before it is down to ``k`` rows
    per slice.
    """
    full = [*order, *[F.col(c).asc() for c in keys]]
    slices = fan_in(df, k)
    if slices > 1:
        part = F.pmod(F.xxhash64(*keys), F.lit(slices)).cast("int")
        sliced = Window.partitionBy(*by, "__slice").orderBy(*full)
        df = df.withColumn("__slice", part).withColumn("__n", F.row_number().over(sliced))
        df = df.where(F.col("__n") <= k).drop("__slice", "__n")
    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*full)))
    return numbered.where(F.col(rank) <= k)


def max_matches(
    df: DataFrame,
    n: int = DEFAULT_MAX_MATCHES,
    order: Order | None = None,
    keys: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The best ``n`` rows per query; 0 leaves the default of 1000."""
    if n < 0:
        raise ValueError("max_matches is negative")
    return best_rows(df, order or relevance(df), n or DEFAULT_MAX_MATCHES, keys)


def page(
    df: DataFrame,
    offset: int = DEFAULT_OFFSET,
    limit: int = DEFAULT_LIMIT,
    order: Order | None = None,
    keys: Sequence[str] = ("doc_id",),
    bound: int = 0,
) -> DataFrame:
    """Rows offset+1 .. offset+limit per query in order. A caller may name a ``bound``: the
    page then lies within the best ``bound`` rows per query. Unless named, there is none."""
    if not 0 <= offset < PAGE_BOUND:
        raise ValueError("offset out of range")
    if not 0 < limit < PAGE_BOUND:
        raise ValueError("limit out of range")
    last = min(offset + limit, bound) if bound else offset + limit
    if offset >= last:
        return df.withColumn("rank", F.lit(0)).where(F.lit(False))
    best = best_rows(df, order or relevance(df), last, keys)
    return best.where(F.col("rank") > offset) if offset else best


def deep_page(
    df: DataFrame,
    offset: int,
    limit: int,
    order: Order | None = None,
    keys: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Rows offset+1 .. offset+limit per query in order, for pages however deep.

    The rows are sorted into ranges by (query, order, key) and written; each range counts its
    rows of each query, which gives the rank at which a query enters it. Only the ranges that
    hold a part of the page are read again and ranked, each on its own: no task holds more
    than a range, and the key parts equal weights, so a hot query fills as many ranges as its
    rows need. ``page`` is cheaper near the top.
    """
    if not 0 <= offset < PAGE_BOUND:
        raise ValueError("offset out of range")
    if not 0 < limit < PAGE_BOUND:
        raise ValueError("limit out of range")
    order = list(order or relevance(df))
    by = [F.col("query_id").asc(), *order, *[F.col(c).asc() for c in keys]]
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(ranges, *by).withColumn("__range", F.spark_partition_id())
    dealt = written(dealt, "ranges", ["__range"])
    # A query is in neighbouring ranges: at most ranges + queries counts.
    counts = dealt.groupBy("query_id", "__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("query_id").orderBy("__range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    holds = (F.col("__before") < offset + limit) & (F.col("__before") + F.col("__n") > offset)
    found = stored(counts.where(holds).drop("__n"), "page")
    # Files of other ranges are not opened.
    wanted = [row[0] for row in found.select("__range").distinct().collect()]
    rows = dealt.where(F.col("__range").isin(wanted)).join(
        hint(found, few(ranges + found.count())), ["query_id", "__range"]
    )
    local = Window.partitionBy("query_id", "__range").orderBy(*by[1:])
    ranked = rows.withColumn("rank", (F.row_number().over(local) + F.col("__before")).cast("int"))
    on_page = F.col("rank").between(offset + 1, offset + limit)
    return ranked.where(on_page).select(*df.columns, "rank")


def cutoff(df: DataFrame, n: int, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The first ``n`` matches per query by key, before ranking; 0 keeps all."""
    if n < 0:
        raise ValueError("cutoff is negative")
    return best_rows(df, [], n, keys, rank="__cut").drop("__cut") if n else df
