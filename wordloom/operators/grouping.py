"""Groups of matches per query, each with its count and best match."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from wordloom.codes import DEFAULT_LIMIT, DEFAULT_OFFSET, GROUP_FUNCTIONS, code_name
from wordloom.operators.ordering import Order, extended, page

# Fixed value: groups are listed by key, largest first, unless told otherwise.
GROUP_SORT = (("@group", "desc"),)


def group_keys(df: DataFrame, attr: str | Sequence[str], func: str | int) -> dict[str, Column]:
    """Group key columns of a grouping function.

    Day, week (from Monday), month and year are named by their first date. A
    multi-value attribute gives one key per distinct element.
    """
    name = code_name(GROUP_FUNCTIONS, func)
    if name == "attrpair":
        first, second = attr
        return {"group_key": F.col(first), "group_key2": F.col(second)}
    if not isinstance(attr, str):
        raise ValueError(f"{name} takes one attribute")
    if name == "attr":
        if isinstance(df.schema[attr].dataType, T.ArrayType):
            return {"group_key": F.explode(F.array_distinct(attr))}
        return {"group_key": F.col(attr)}
    moment = F.col(attr)
    if isinstance(df.schema[attr].dataType, T.NumericType):
        moment = F.timestamp_seconds(moment)  # Unix seconds, as ``typed`` reads them
    date = moment.cast("date")
    return {"group_key": date if name == "day" else F.trunc(date, name)}


def with_groups(df: DataFrame, attr: str | Sequence[str], func: str | int) -> DataFrame:
    """``df`` plus its group key columns."""
    keys = group_keys(df, attr, func)
    return df.select("*", *[column.alias(name) for name, column in keys.items()])


def _names(df: DataFrame) -> list[str]:
    return [c for c in ("group_key", "group_key2") if c in df.columns]


def group_by(
    df: DataFrame,
    attr: str | Sequence[str],
    func: str | int = "day",
    distinct: str | None = None,
    approximate: bool = False,
    keys: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """One row per (query, group): count, best match, and distinct values of an attribute.

    The best match has the highest weight (where the frame has the exact ``bm25`` beside a
    weight that packs it, then the highest of these), then the lowest key. Every task keeps one row
    per group (with ``distinct``: per group and value) before the shuffle, so a group
    holding a third of all matches costs one row per task.
    """
    grouped = with_groups(df, attr, func)
    names = _names(grouped)
    exact = ["bm25"] if "bm25" in grouped.columns and distinct != "bm25" else []
    rows = grouped.select(
        "query_id",
        *names,
        *keys,
        "weight",
        *exact,
        *([F.col(distinct).alias("__value")] if distinct else []),
    )
    group = ["query_id", *names]
    falling = [F.negative(c).alias(f"__minus_{c}") for c in ("weight", *exact)]
    best_match = F.min_by(F.struct(*keys, "weight", *exact), F.struct(*falling, *keys))
    if distinct is None:
        result = rows.groupBy(*group).agg(
            F.count(F.lit(1)).alias("count"), best_match.alias("__best")
        )
        return result.select(
            *group,
            "count",
            *[F.col("__best")[k].alias(f"best_{k}") for k in keys],
            F.col("__best")["weight"].alias("best_weight"),
        )
    if approximate:
        result = rows.groupBy(*group).agg(
            F.count(F.lit(1)).alias("count"),
            F.approx_count_distinct("__value").alias("distinct"),
            best_match.alias("__best"),
        )
    else:
        per_value = rows.groupBy(*group, "__value").agg(
            F.count(F.lit(1)).alias("__n"), best_match.alias("__best")
        )
        per_value = per_value.select(*group, "__value", "__n", "__best.*")
        result = per_value.groupBy(*group).agg(
            F.sum("__n").alias("count"),
            F.count("__value").alias("distinct"),
            best_match.alias("__best"),
        )
    return result.select(
        *group,
        "count",
        "distinct",
        *[F.col("__best")[k].alias(f"best_{k}") for k in keys],
        F.col("__best")["weight"].alias("best_weight"),
    )


def group_best(
    df: DataFrame,
    attr: str | Sequence[str],
    func: str | int,
    order: Order,
    keys: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """One row per (query, group): count, and the whole row that comes first in ``order``."""
    rows = with_groups(df, attr, func)
    group = ["query_id", *_names(rows)]
    full = [*order, *[F.col(k).asc() for k in keys]]
    # Slices of the key first: a group that holds a third of all matches is counted and cut
    # to one row per slice before it meets. Count and best row share one pass.
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = rows.withColumn("__slice", F.pmod(F.xxhash64(*keys), F.lit(slices)).cast("int"))
    part = Window.partitionBy(*group, "__slice")
    first = sliced.withColumns(
        {
            "__n": F.row_number().over(part.orderBy(*full)),
            "count": F.count(F.lit(1)).over(part),
        }
    ).where(F.col("__n") == 1)
    whole = Window.partitionBy(*group)
    return first.withColumns(
        {
            "__n": F.row_number().over(whole.orderBy(*full)),
            "count": F.sum("count").over(whole),
        }
    ).where(F.col("__n") == 1).drop("__n", "__slice")


def page_groups(
    groups: DataFrame,
    groupsort: Sequence[tuple[str, str]] = GROUP_SORT,
    offset: int = DEFAULT_OFFSET,
    limit: int = DEFAULT_LIMIT,
    bound: int = 0,
) -> DataFrame:
    """A page of groups per query in the given order; limits count groups."""
    return page(groups, offset, limit, extended(groupsort), _names(groups), bound)
