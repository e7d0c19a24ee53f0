"""SimHash near-duplicates by anchor-point covering.

A fingerprint has 64 bits. The bits are cut into three blocks (``LAYOUT``), of which one
differs in at most a third of the ``distance`` when two fingerprints are linked. Within a
block the words of the perfect binary Golay code are the anchors: every block value lies
within 3 bits of exactly one, its home. A fingerprint goes to every anchor within 3 bits plus
the block's share, and at each anchor the residents are compared with all that came: a linked
pair meets at the home of either. Bits of a block beyond the code's 23 are part of the anchor
as they are, and are varied instead; so ``(32, 32)`` is a layout with many more anchors.

Equal fingerprints are compared once. A crowded anchor is cut into cells of bounded size,
residents by slices of visitors, and a cell returns a spanning forest of its links instead of
all pairs. Components of the forest's edges are those of all links.

Rows: a null or empty text has fingerprint zero, which is linked like any other; repeated
rows and ids are kept each; a null ``doc_id`` takes part, and a component of null ids alone
has a null id; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from wordloom.llm.common import runs, slices, stored, table, utf8
from wordloom.llm.components import components

LAYOUT = (21, 21, 22)
CELL = 2048
GOLAY_BITS, GOLAY_RADIUS = 23, 3
GOLAY_POLYNOMIAL = 0xAE3  # fixed value: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1

VISITS = pa.schema([("anchor", pa.int64()), ("print", pa.int64()), ("home", pa.bool_())])


def fingerprint(text: bytes, shingle: int, seed: int, step: int = 1 << 16) -> int:
    """A bit is set if it is set in over half the XXH64 values of the word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    total = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    counts = np.zeros(64, np.int64)
    for a, b in slices(total, step):
        parts = [line[s:e] for s, e in zip(starts[a:b].tolist(), last[a:b].tolist())]
        hashes = np.fromiter(
            map(xxhash.xxh64_intdigest, parts, repeat(seed)), np.uint64, b - a
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > total, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42) -> DataFrame:
    """``docs`` with ``print`` (the 64 bits as a signed number) for ``text``; no shuffle."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, shingle, seed) for t in utf8(batch.column("text"))]
            own = batch.drop_columns(["text"])
            yield own.append_column("print", pa.array(prints, pa.int64()))

    fields = [f for f in docs.schema.fields if f.name != "text"]
    schema = T.StructType([*fields, T.StructField("print", T.LongType())])
    return docs.select(*(f.name for f in fields), "text").mapInArrow(each, schema)


def _syndrome(values: np.ndarray) -> np.ndarray:
    """Remainder by the Golay polynomial: equal for values that differ by a code word."""
    left = values.astype(np.int64)
    for bit in range(GOLAY_BITS - 1, 10, -1):
        left ^= ((left >> bit) & 1) * (GOLAY_POLYNOMIAL << (bit - 11))
    return left


@lru_cache
def _errors(weight: int) -> tuple[np.ndarray, np.ndarray]:
    """All 23-bit patterns of up to ``weight`` bits, sorted by syndrome, and where each
    syndrome begins. A value less a pattern of its own syndrome is a code word."""
    masks = [
        sum(1 << i for i in bits)
        for n in range(weight + 1)
        for bits in combinations(range(GOLAY_BITS), n)
    ]
    masks = np.array(masks, np.int64)
    syndromes = _syndrome(masks)
    order = np.argsort(syndromes, kind="stable")
    return masks[order], np.searchsorted(syndromes[order], np.arange(2049))


def _anchors(values: np.ndarray, weight: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and code words within ``weight`` bits of every 23-bit value."""
    masks, bounds = _errors(weight)
    syndromes = _syndrome(values)
    low, count = bounds[syndromes], bounds[syndromes + 1] - bounds[syndromes]
    rows = np.repeat(np.arange(len(values)), count)
    within = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
    return rows, values[rows] ^ masks[low[rows] + within]


def visits(
    prints: np.ndarray, layout: tuple[int, ...], distance: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Anchor, print and whether the print is a resident there, block by block."""
    share, shift = distance // len(layout), 0
    for block, width in enumerate(layout):
        value = (prints >> np.uint64(shift)) & np.uint64((1 << width) - 1)
        value = value.astype(np.int64)
        shift += width
        code, rest = value & ((1 << GOLAY_BITS) - 1), value >> GOLAY_BITS
        spare = max(0, width - GOLAY_BITS)
        rows, words = _anchors(code, GOLAY_RADIUS)
        home = np.empty(len(code), np.int64)
        home[rows] = words
        for flips in range(min(share, spare) + 1):
            for bits in combinations(range(spare), flips):
                moved = rest ^ sum(1 << i for i in bits)
                rows, words = _anchors(code, GOLAY_RADIUS + share - flips)
                anchor = (moved[rows] << GOLAY_BITS | words) * len(layout) + block
                resident = (words == home[rows]) & (flips == 0)
                yield anchor, prints[rows], resident


def _forest(residents: np.ndarray, visitors: np.ndarray, distance: int) -> np.ndarray:
    """A spanning forest of the links between ``residents`` and ``visitors``: rows (a, b)."""
    nodes = np.unique(np.concatenate([residents, visitors]))
    label = np.arange(len(nodes))
    left, right = np.searchsorted(nodes, residents), np.searchsorted(nodes, visitors)
    for a, b in slices(len(residents), max(1, (1 << 21) // max(1, len(visitors)))):
        near = np.bitwise_count(residents[a:b, None] ^ visitors[None, :]) <= distance
        i, j = np.nonzero(near)
        i, j = left[a + i], right[j]
        while True:
            apart = label[i] != label[j]
            i, j = i[apart], j[apart]
            if not len(i):
                break
            least = np.minimum(label[i], label[j])
            np.minimum.at(label, label[i], least)
            np.minimum.at(label, label[j], least)
            while (label[label] != label).any():
                label = label[label]
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return np.stack([nodes[moved], nodes[label[moved]]], axis=1)


def links(prints: DataFrame, distance: int, layout: tuple[int, ...] = LAYOUT) -> DataFrame:
    """Edges ``a, b`` between distinct ``print`` values that connect all that differ in at
    most ``distance`` bits, directly or over others."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("print").to_numpy().view(np.uint64)
            for a, b in slices(len(own), 4096):
                for anchor, seen, home in visits(own[a:b], layout, distance):
                    yield table(VISITS, anchor=anchor, print=seen.view(np.int64), home=home)

    guests = stored(
        prints.mapInArrow(visit, "anchor long, print long, home boolean"), "anchors"
    )
    pieces = lambda n: F.ceil(n / F.lit(CELL)).cast("int")
    crowd = guests.groupBy("anchor").agg(
        pieces(F.count_if("home")).alias("rows"), pieces(F.count(F.lit(1))).alias("cols")
    )
    # An anchor without a resident, or with one print in all, has nothing to compare.
    met = guests.join(crowd.where("rows > 0"), "anchor")
    slot = F.xxhash64("print")
    others = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    residents = met.where("home").select(
        "anchor",
        "print",
        "home",
        F.pmod(slot, F.col("rows")).cast("int").alias("row"),
        F.explode(others("cols")).alias("col"),
    )
    visitors = met.select(
        "anchor",
        "print",
        F.lit(False).alias("home"),
        F.explode(others("rows")).alias("row"),
        F.pmod(slot, F.col("cols")).cast("int").alias("col"),
    )
    dealt = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4
    cells = residents.unionByName(visitors).select(
        F.pmod(F.xxhash64("anchor", "row", "col"), F.lit(dealt)).alias("deal"),
        F.xxhash64("anchor", "row", "col").alias("cell"),
        "print",
        "home",
    )

    def compare(data: pa.Table) -> pa.Table:
        cell, seen = data["cell"].to_numpy(), data["print"].to_numpy().view(np.uint64)
        home = data["home"].to_numpy(zero_copy_only=False)
        order = np.argsort(cell, kind="stable")
        cell, seen, home = cell[order], seen[order], home[order]
        found, bounds = [np.zeros((0, 2), np.uint64)], runs(cell)
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a > 2 and home[a:b].any():
                found.append(_forest(seen[a:b][home[a:b]], seen[a:b][~home[a:b]], distance))
        edges = np.unique(np.concatenate(found), axis=0).view(np.int64)
        return pa.table({"a": edges[:, 0].copy(), "b": edges[:, 1].copy()})

    return cells.groupBy("deal").applyInArrow(compare, "a long, b long")


def rooted_prints(
    docs: DataFrame,
    shingle: int = 4,
    distance: int = 4,
    seed: int = 42,
    layout: tuple[int, ...] = LAYOUT,
    carry: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """The documents' ``doc_id, print`` with the narrow columns ``carry``, and for each distinct
    print ``print, root, least``: linked prints share the ``root``, which alone names a
    component, and ``least`` is the smallest ``doc_id`` of the print."""
    if sum(layout) != 64:
        raise ValueError("the blocks of a layout hold 64 bits together")
    own = stored(fingerprints(docs.select("doc_id", *carry, "text"), shingle, seed), "prints")
    # Sides that many rows of one key meet are stored, so that Spark can split those rows.
    each = stored(own.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct-prints")
    hung = components(links(each.select("print"), distance, layout))
    rooted = each.join(hung, each["print"] == hung["node"], "left").select(
        "print", F.coalesce("root", "print").alias("root"), "least"
    )
    return own, stored(rooted, "rooted")


def near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """``doc_id, print, component_id``: documents whose fingerprints are linked, directly or
    over others, share the smallest ``doc_id``. ``settings`` are those of ``rooted_prints``."""
    own, rooted = rooted_prints(docs, **settings)
    groups = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "groups")
    named = stored(rooted.join(groups, "root").select("print", "component_id"), "named")
    return own.join(named, "print").select("doc_id", "print", "component_id")


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """One row of ``docs`` per component: the smallest ``doc_id``, then the smallest hash of
    the text; rows equal in both give one."""
    content = F.md5(F.coalesce("text", F.lit("")))
    texts = docs.withColumn("content", content)
    own, rooted = rooted_prints(texts, carry=("content",), **settings)
    # By the root: components of unrelated texts can share their smallest id, or have only nulls.
    groups = own.join(rooted.select("print", "root"), "print")
    best = groups.groupBy("root").agg(F.min(F.struct("doc_id", "content")).alias("b"))
    best = best.select(F.col("b.doc_id").alias("of_id"), F.col("b.content").alias("of_content"))
    # The row travels as one column, whatever names its own columns have.
    wide = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), content.alias("own"))
    same = wide["id"].eqNullSafe(best["of_id"]) & (wide["own"] == best["of_content"])
    return wide.join(best, same, "left_semi").dropDuplicates(["id", "own"]).select("row.*")
