"""Attribute filters.

An included filter drops a row whose attribute is null, an excluded one keeps it.
On a multi-value attribute a filter holds when any element satisfies it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from wordloom.functions.text import as_float32
from wordloom.sizing import hint, measure

# Up to this many listed values an IN list is planned and pushed down quickly.
LISTED = 10_000

Filter = Callable[[DataFrame], DataFrame]


def _keep(df: DataFrame, attr: str, test: Callable[[Column], Column], exclude: bool) -> DataFrame:
    column = F.col(attr)
    if isinstance(df.schema[attr].dataType, T.ArrayType):
        condition = F.exists(column, test)
    else:
        condition = test(column)
    return df.where(~F.coalesce(condition, F.lit(False)) if exclude else condition)


def filter_values(
    df: DataFrame, attr: str, values: Iterable[int] | DataFrame, exclude: bool = False
) -> DataFrame:
    """Keep rows whose attribute is in a set of integers.

    A listed set of up to ``LISTED`` values becomes an ``IN`` that reaches the scan. A longer
    one, or a set held in a one-column DataFrame, becomes a semi (excluded: anti) join,
    broadcast when measured small; beyond that Spark splits a skewed attribute value at run
    time. The set is read as the attribute's type, where a value that this type cannot hold
    exactly equals nothing; so lists and tables agree on every numeric type.
    """
    if not isinstance(values, DataFrame):
        listed = [int(v) for v in values]
        if len(listed) <= LISTED:
            return _keep(df, attr, lambda c: c.isin(listed), exclude)
        values = df.sparkSession.createDataFrame([(v,) for v in listed], "__value bigint")
    kind = df.schema[attr].dataType
    is_list = isinstance(kind, T.ArrayType)
    element = (kind.elementType if is_list else kind).simpleString()
    given = values.toDF("__given")
    own = F.col("__given").try_cast(element)
    # Exact: the value reads back as it was given.
    back = own.try_cast(given.schema["__given"].dataType.simpleString())
    wanted = given.where(back == F.col("__given")).select(own.alias("__value")).distinct()
    side = hint(wanted, measure(wanted).small)
    how = "left_anti" if exclude else "left_semi"
    if is_list:
        # A row's array is itself a key, so the hits of each distinct array are found once.
        lists = df.select(F.col(attr).alias("__list")).distinct()
        each = lists.select("__list", F.explode("__list").alias("__value"))
        hit = each.join(side, "__value", "left_semi").select("__list").distinct()
        return df.join(hit, df[attr] == hit["__list"], how)
    return df.join(side, df[attr] == side["__value"], how)


def filter_range(df: DataFrame, attr: str, lo: int, hi: int, exclude: bool = False) -> DataFrame:
    """Keep rows with lo <= attribute <= hi."""
    if lo > hi:
        raise ValueError(f"range of {attr} is reversed: {lo} > {hi}")
    return _keep(df, attr, lambda c: c.between(lo, hi), exclude)


def filter_float_range(
    df: DataFrame, attr: str, lo: float, hi: float, exclude: bool = False
) -> DataFrame:
    """Keep rows with lo <= attribute <= hi, all three as 32-bit floats.

    The cast would hide the bounds from the Parquet scan, so a slightly wider
    range on the uncast attribute goes along; it drops nothing the cast keeps.
    """
    if lo > hi:
        raise ValueError(f"range of {attr} is reversed: {lo} > {hi}")
    low, high = (F.lit(float(b)).cast("float") for b in (lo, hi))
    if not exclude and isinstance(df.schema[attr].dataType, (T.FloatType, T.DoubleType)):
        below = float(np.nextafter(np.float32(lo), np.float32(-np.inf)))
        above = float(np.nextafter(np.float32(hi), np.float32(np.inf)))
        df = df.where((F.col(attr) >= below) & (F.col(attr) <= above))
    return _keep(df, attr, lambda c: as_float32(c).between(low, high), exclude)


def filter_id_range(df: DataFrame, lo: int = 0, hi: int = 0, id: str = "doc_id") -> DataFrame:
    """Keep ids from lo to hi inclusive; an upper bound of 0 means none."""
    if hi and lo > hi:
        raise ValueError(f"id range is reversed: {lo} > {hi}")
    kept = df.where(F.col(id) >= lo) if lo else df
    return kept.where(F.col(id) <= hi) if hi else kept


def values(attr: str, of: Iterable[int] | DataFrame, exclude: bool = False) -> Filter:
    """``filter_values`` as an argument for ``apply_filters`` and ``search``."""
    return _named(attr, lambda df: filter_values(df, attr, of, exclude))


def between(attr: str, lo: int, hi: int, exclude: bool = False) -> Filter:
    """``filter_range`` as an argument."""
    return _named(attr, lambda df: filter_range(df, attr, lo, hi, exclude))


def float_between(attr: str, lo: float, hi: float, exclude: bool = False) -> Filter:
    """``filter_float_range`` as an argument."""
    return _named(attr, lambda df: filter_float_range(df, attr, lo, hi, exclude))


def id_between(lo: int = 0, hi: int = 0) -> Filter:
    """``filter_id_range`` as an argument."""
    return _named("doc_id", lambda df: filter_id_range(df, lo, hi))


def _named(attr: str, apply: Filter) -> Filter:
    apply.attr = attr  # tells ``search`` whether an override changes the attribute
    return apply


def apply_filters(df: DataFrame, filters: Iterable[Filter]) -> DataFrame:
    """Rows that pass every filter. Filters are arguments of one call, never shared state."""
    for one in filters:
        df = one(df)
    return df
