"""Vector best-fit packing of documents into sequences.

A document is cut into pieces of at most ``max_tokens`` ids. Every piece asks for tokens,
one document place and an attention cost (its length squared), and a sequence has a capacity
of each. Pieces of one length ask for the same, so the choice needs only the number of
pieces of every length: at most ``max_tokens`` rows, whatever the corpus. An open sequence
takes, again and again, the length that fits under every capacity and is best by the weighted
residual norm it leaves or by the weighted dot product with the residual; the finished
pattern is repeated as often as the counts allow. Pieces find their sequence by their rank
within their length, which is counted per salted slice, so a length that a third of all
pieces share is not met in one task.

Rows: a null text is empty and holds the end id alone; repeated rows are packed each; a null
``doc_id`` is kept; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from wordloom.llm.common import stored, table
from wordloom.llm.token_ids import token_ids

PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32())]
    + [(name, pa.int64()) for name in ("start", "length", "ids_crc32")]
)
PIECE_COLUMNS = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Capacity:
    """What a sequence can hold, and how each residual counts in the choice."""

    tokens: int = 4096
    documents: int = 4096
    attention: int = 4096 * 4096
    weights: tuple[float, float, float] = (1.0, 0.1, 0.1)
    rule: str = "norm"

    def __post_init__(self) -> None:
        if self.rule not in ("norm", "dot"):
            raise ValueError(f"unknown rule {self.rule!r}: norm or dot")
        if self.attention < self.tokens**2 or self.documents < 1:
            raise ValueError("a sequence must hold any single piece")


@dataclass(frozen=True)
class Pattern:
    """``repeat`` sequences from ``first`` on, each with ``uses`` (length, count)."""

    first: int
    repeat: int
    uses: tuple[tuple[int, int], ...]


def plan(counts: dict[int, int], capacity: Capacity) -> list[Pattern]:
    """Patterns that hold ``counts`` pieces of every length."""
    lengths = np.array(sorted(counts), np.int64)
    left = np.array([counts[x] for x in lengths], np.int64)
    limits = np.array([capacity.tokens, capacity.documents, capacity.attention], np.float64)
    weights = np.array(capacity.weights)
    asks = np.stack([lengths, np.ones_like(lengths), lengths**2], axis=1)
    share = asks / limits
    patterns, first = [], 0
    top = len(lengths) - 1
    while top >= 0:
        if not left[top]:
            top -= 1
            continue
        uses = np.zeros(len(lengths), np.int64)
        rest = limits.copy()
        chosen = top
        while True:
            # As often as it fits with a margin for better ones: once for a long piece.
            uses[chosen] += 1
            rest -= asks[chosen]
            fits = np.searchsorted(lengths, rest[0], "right")
            open_ = (uses[:fits] < left[:fits]) & (asks[:fits] <= rest).all(axis=1)
            if not open_.any():
                break
            if capacity.rule == "norm":
                score = -((rest / limits - share[:fits]) ** 2 @ weights)
            else:
                score = share[:fits] @ (weights * rest / limits)
            score[~open_] = -np.inf
            # On ties the longest length.
            chosen = fits - 1 - int(np.argmax(score[::-1]))
        used = np.flatnonzero(uses)
        repeat = int((left[used] // uses[used]).min())
        left[used] -= uses[used] * repeat
        patterns.append(
            Pattern(first, repeat, tuple((int(lengths[i]), int(uses[i])) for i in used[::-1]))
        )
        first += repeat
    return patterns


def places(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """The plan by length and rank: rows (length, first rank) in order, with the first
    sequence, the number of sequences and the offset of the length's first piece."""
    rows, seen = [], {}
    for p in patterns:
        offset = 0
        for length, count in p.uses:
            rank = seen.get(length, 0)
            rows.append((length, rank, p.first, p.repeat, offset))
            seen[length] = rank + count * p.repeat
            offset += length * count
    rows = np.array(sorted(rows), np.int64).reshape(-1, 5)
    names = ("length", "rank", "first", "repeat", "offset")
    return dict(zip(names, rows.T))


def pieces(docs: DataFrame, vocabulary: str, end_id: int, max_tokens: int) -> DataFrame:
    """Token pieces of all documents, with the CRC-32 of their ids; no shuffle."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = token_ids(vocabulary), struct.pack("<I", end_id)
        step = 4 * max_tokens
        for batch in batches:
            rows: list[tuple] = []
            texts = batch.column("text").to_pylist()
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                ids = encode(text) + end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = zip(*rows) if rows else [[]] * 5
            yield table(PIECES, **dict(zip(PIECES.names, map(list, columns))))

    return docs.select("doc_id", "text").mapInArrow(cut, PIECE_COLUMNS)


def ranked(cut: DataFrame) -> DataFrame:
    """``cut`` with the rank of every piece within its length, from 0.

    A length is dealt over as many slices as there are shuffle partitions; a slice starts
    after the pieces of the slices before it. Pieces move once.
    """
    slices = int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(slices)).cast("int")
    cut = cut.withColumn("slice", salt)
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = cut.groupBy("length", "slice").count()
    starts = starts.select(
        "length", "slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")
    )
    within = Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "ids_crc32")
    numbered = cut.withColumn("place", F.row_number().over(within) - 1)
    rank = (F.col("before") + F.col("place")).alias("rank")
    return numbered.join(starts, ["length", "slice"]).select(*PIECES.names, rank)


def pack(
    docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: Capacity | None = None
) -> DataFrame:
    """Sequence and offset of every piece of every document.

    The pieces (a narrow row each) are stored once; lengths are counted, the plan is made
    from at most ``capacity.tokens`` counts, and every piece looks its place up in it.
    """
    capacity = capacity or Capacity()
    cut = stored(pieces(docs, vocabulary, end_id, capacity.tokens), "pieces")
    counts = dict(cut.groupBy("length").count().collect())
    where = places(plan(counts, capacity))
    shift = np.int64(1 << 44)  # ranks stay below, lengths above
    keys = where["length"] * shift + where["rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in ("length", "rank"))
            row = np.searchsorted(keys, length * shift + rank, "right") - 1
            nth = rank - where["rank"][row]
            repeat = where["repeat"][row]
            sequence = where["first"][row] + nth % repeat
            offset = where["offset"][row] + nth // repeat * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=[*PIECES.names, "sequence_id", "offset"],
            )

    return ranked(cut).mapInArrow(place, f"{PIECE_COLUMNS}, sequence_id long, offset long")
