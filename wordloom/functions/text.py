"""Column functions on text and numbers, all built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WORD = r"[\p{L}\p{N}]+"

# The characters that have a meaning in a query text.
SPECIAL = r'([=()|\-!@~"&/\\^$])'


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def words(column: str | Column) -> Column:
    """Lower-cased words of a text in order; a null text has none."""
    text = F.lower(F.coalesce(_col(column), F.lit("")))
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def escape_text(column: str | Column) -> Column:
    """Text with a backslash before each character special to a query."""
    return F.regexp_replace(_col(column), SPECIAL, r"\\$1")


def as_float32(column: str | Column) -> Column:
    """The value as a 32-bit float, the width float bounds are compared in."""
    return _col(column).cast("float")
