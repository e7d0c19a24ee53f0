"""Size checks before broadcasts, and the joins that follow from them.

A side is broadcast only after one aggregate over it has shown that it is small;
a larger side takes a shuffle join, salted where one key may be hot.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Rows that a task of ``dealt`` gets at most, about, when keys spread evenly.
DEALT_ROWS = 600_000


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int

    @property
    def small(self) -> bool:
        return few(self.rows) and self.bytes <= BROADCAST_BYTES


def few(rows: int) -> bool:
    """Whether a proven bound on the rows of a narrow table allows a broadcast."""
    return rows <= BROADCAST_ROWS


def bounded(df: DataFrame, rows: int | None) -> bool:
    """Whether ``df``, of at most ``rows`` rows, is proven small in rows and bytes. Columns
    of no fixed width prove nothing, and no bound neither: then Spark chooses the join."""
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    if rows is None or not all(isinstance(f.dataType, fixed) for f in df.schema.fields):
        return False
    return Size(rows, rows * 16 * (1 + len(df.columns))).small


def row_bytes(df: DataFrame) -> Column:
    """Estimated width of a row: 8 per fixed-width column, real length of the others."""
    width: Column = F.lit(8).cast("bigint")
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(column), F.lit(0)) + 8
        elif isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            text = F.octet_length(F.to_json(column))
            width = width + F.coalesce(text, F.lit(0)) + 8
        else:
            width = width + 8
    return width


def measure(df: DataFrame) -> Size:
    """Rows and estimated bytes of ``df``: one distributed aggregate, one row back."""
    row = df.agg(F.count(F.lit(1)), F.sum(row_bytes(df))).first()
    return Size(rows=row[0], bytes=row[1] or 0)


def hint(df: DataFrame, small: bool) -> DataFrame:
    """``df`` marked for broadcast when its size was shown to be small."""
    return F.broadcast(df) if small else df


def unique_size(side: DataFrame, on: Sequence[str]) -> Size:
    """The size of a side whose key must be unique: one aggregate tells both."""
    row = side.agg(
        F.count(F.lit(1)), F.sum(row_bytes(side)), F.count_distinct(F.struct(*on))
    ).first()
    if row[0] != row[2]:
        raise ValueError(f"a key of {list(on)} occurs twice")
    return Size(row[0], row[1] or 0)


def join_by_key(big: DataFrame, side: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join on a key that is unique in ``side``, so no key of the output is hot."""
    return big.join(hint(side, unique_size(side, on).small), on, how)


def join_by_term(
    words: DataFrame, terms: DataFrame, small: bool, spread: list[str], how: str = "inner"
) -> DataFrame:
    """Equi-join on ``term``.

    ``terms`` (from queries) is broadcast when small. Otherwise a frequent word is
    a hot key of ``words``: its rows are spread over salts by the ``spread``
    columns and ``terms`` is repeated once per salt.
    """
    if small:
        return words.join(F.broadcast(terms), "term", how)
    salts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = words.withColumn("salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    repeated = terms.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, ["term", "salt"], how).drop("salt")


def dealt(df: DataFrame, rows: int, by: Sequence[str]) -> DataFrame:
    """``df`` dealt out by the columns ``by`` into as many tasks as ``rows``, a bound on its rows
    or on what becomes of them, asks for. A session's own number of partitions is fixed, and a
    join by word makes many rows of one; so a task would hold more as the corpus grows."""
    spark = df.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = min(least, spark.sparkContext.defaultParallelism)
    return df.repartition(max(least, -(-rows // DEALT_ROWS)), *by)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, so that losing an executor does
    not repeat what came before. The folder is the session's ``spark.checkpoint.dir``."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder:
            raise RuntimeError("spark.checkpoint.dir names no shared folder")
        context.setCheckpointDir(folder)
    return df.checkpoint()


def fan_in(df: DataFrame, k: int) -> int:
    """How many slices a per-group top-k is cut into before the final one.

    Each group-limited slice holds at most ``k`` rows per input partition, so the
    square root of the partition count balances both steps. Above Spark's limit
    for early group trimming every partition takes a slice of the sort.
    """
    conf = df.sparkSession.conf
    partitions = int(conf.get("spark.sql.shuffle.partitions"))
    threshold = int(conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > threshold:
        return partitions
    return 1 if partitions <= 16 else math.isqrt(partitions)
