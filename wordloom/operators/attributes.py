"""Attribute values: select lists, types, overrides and bulk updates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, functions as F, types as T

from wordloom.codes import ATTRIBUTE_TYPES
from wordloom.sizing import hint, join_by_key, unique_size
from wordloom.sources.corpus import Corpus


def select(df: DataFrame, items: Sequence[str] = ("*",)) -> DataFrame:
    """A select list of attributes and Spark SQL expressions, with optional aliases."""
    return df.selectExpr(*items)


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast attributes to the named types; a number becomes a timestamp as Unix seconds."""
    columns = {}
    for name, kind in types.items():
        if kind not in ATTRIBUTE_TYPES:
            raise ValueError(f"{kind!r} is no attribute type")
        column = F.col(name)
        numeric = isinstance(df.schema[name].dataType, T.NumericType)
        if kind == "timestamp" and numeric:
            columns[name] = F.timestamp_seconds(column)
        else:
            columns[name] = column.cast(ATTRIBUTE_TYPES[kind])
    return df.withColumns(columns)


def override(
    df: DataFrame, attr: str, values: DataFrame, keys: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """``df`` with other values of an attribute for some (query, document).

    ``values`` has query_id, the keys and ``value``, unique per key. Apply it before
    filters, sorts, groups and select lists.
    """
    kind = df.schema[attr].dataType
    side = values.select(
        "query_id", *keys, F.col("value").cast(kind).alias("__value"), F.lit(True).alias("__set")
    )
    joined = join_by_key(df, side, ["query_id", *keys], "left")
    changed = F.when(F.col("__set"), F.col("__value")).otherwise(F.col(attr))
    return joined.withColumn(attr, changed).drop("__value", "__set")


def update_attributes(
    corpus: Corpus, updates: DataFrame, attrs: Sequence[str], mva: bool = False
) -> Corpus:
    """The corpus with new attribute values for the documents in ``updates``.

    ``updates`` has the keys and every attribute in ``attrs``; with ``mva`` those are
    arrays that replace the whole list. A repeated id is an error, an id the corpus
    lacks changes nothing. Write the result to a new path: Spark cannot overwrite
    what it reads.
    """
    for attr in attrs:
        is_list = isinstance(updates.schema[attr].dataType, T.ArrayType)
        if is_list != mva:
            raise ValueError(f"values of {attr} are {'' if is_list else 'not '}lists")
    types = corpus.df.schema
    new = [F.col(a).cast(types[a].dataType.simpleString()).alias(f"__{a}") for a in attrs]
    side = updates.select(*corpus.keys, *new, F.lit(True).alias("__set"))
    joined = join_by_key(corpus.df, side, list(corpus.keys), "left")
    changed = {a: F.when(F.col("__set"), F.col(f"__{a}")).otherwise(F.col(a)) for a in attrs}
    df = joined.withColumns(changed).select(*corpus.df.columns)
    return replace(corpus, df=df)


def updated_count(corpus: Corpus, updates: DataFrame) -> DataFrame:
    """How many documents of the corpus the updates reach: one row, ``updated``.

    The ids of a small update are broadcast and the corpus is scanned for its keys
    only, whichever side is larger.
    """
    ids = updates.select(*corpus.keys)
    side = hint(ids, unique_size(ids, corpus.keys).small)
    found = corpus.df.select(*corpus.keys).join(side, list(corpus.keys), "left_semi")
    return found.agg(F.count(F.lit(1)).alias("updated"))
