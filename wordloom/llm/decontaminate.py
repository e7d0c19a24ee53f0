"""Benchmark decontamination on a distributed positional inverted index.

``index_documents`` cuts the corpus into shards of whole documents and stores one row per
shard: its documents, its terms and, per term, the sorted positions in the shard. Between two
documents one position stays empty, so nothing matches across them. The index is written once
and searched by any number of test sets; no posting is ever shuffled.

``search_index`` takes test items in blocks of bounded size against all shards. For every
window of an item the shard's own term counts give the order: the list of the rarest term,
moved back by the term's offset, is the list of candidate starts, and the lists of the other
terms are intersected with it from the next rarest on. With ``slack`` 0 a match is an exact
phrase; above 0 every other term may lie up to ``slack`` positions from its place.

Rows: a null or empty text has no words and no match; items without words have no window; an
item with fewer words than a window is one window; repeated documents and items count each;
a null ``item_id`` is reported as the empty string; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from wordloom.llm.common import runs, stored, table, utf8

WINDOW = 10
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 16 << 20

# ASCII letters in lower case, digits and every byte above 0x7F are word bytes.
_WORD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)

SHARDS = pa.schema(
    [
        ("shard", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("keys", pa.list_(pa.binary())),
        ("sizes", pa.list_(pa.int32())),
        ("terms", pa.binary()),
        ("counts", pa.binary()),
        ("postings", pa.binary()),
    ]
)
SHARD_COLUMNS = (
    "shard long, doc_ids array<long>, keys array<binary>, sizes array<int>, terms binary,"
    " counts binary, postings binary"
)
HITS = pa.schema(
    [
        ("shard", pa.int64()),
        ("place", pa.int64()),
        ("doc_id", pa.int64()),
        ("key", pa.binary()),
        ("n_words", pa.int64()),
        ("starts", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int64())),
        ("items", pa.list_(pa.string())),
    ]
)
HIT_COLUMNS = (
    "shard long, place long, doc_id long, key binary, n_words long, starts array<long>,"
    " ends array<long>, items array<string>"
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORD).split()


class Windows:
    """The windows of a block of items, as term numbers (-1 behind a short one)."""

    def __init__(self, items: list[tuple[str, bytes]], window: int) -> None:
        self.terms: dict[bytes, int] = {}
        rows, self.owner, self.items = [], [], []
        for item_id, text in items:
            ids = [self.terms.setdefault(w, len(self.terms)) for w in words(text)]
            if not ids:
                continue
            for at in range(max(1, len(ids) - window + 1)):
                part = ids[at : at + window]
                rows.append(part + [-1] * (window - len(part)))
                self.owner.append(len(self.items))
            self.items.append(item_id)
        self.rows = np.array(rows, np.int64).reshape(-1, window)
        self.sizes = (self.rows >= 0).sum(axis=1)


def _shard(
    number: int, docs: list[tuple[int | None, bytes]], wanted: dict[bytes, int] | None
) -> pa.RecordBatch:
    """One index row of whole documents; ``wanted`` restricts it to those terms."""
    texts = [words(text) for _, text in docs]
    sizes = np.array([len(t) for t in texts], np.int32)
    if wanted is None:
        found: dict[bytes, int] = {}
        ids = [found.setdefault(w, len(found)) for t in texts for w in t]
        names = list(found)
    else:
        ids = [i for t in texts for i in map(wanted.get, t, repeat(-1))]
        names = list(wanted)
    ids = np.array(ids, np.int32)
    # Document k begins k positions later than its words alone would put it.
    at = np.arange(len(ids)) + np.repeat(np.arange(len(texts)), sizes)
    at, ids = at[ids >= 0], ids[ids >= 0]
    order = np.argsort(ids.astype(np.int16) if len(names) < 32768 else ids, kind="stable")
    counts = np.bincount(ids, minlength=len(names))
    gaps = np.diff(at[order].astype(np.int32), prepend=np.int32(0))
    held = np.flatnonzero(counts)
    return table(
        SHARDS,
        shard=[number],
        doc_ids=[[doc_id for doc_id, _ in docs]],
        keys=[[hashlib.md5(text).digest() for _, text in docs]],
        sizes=[sizes],
        terms=[b" ".join(names[i] for i in held)],
        counts=[counts[held].astype("<i4").tobytes()],
        postings=[zstandard.ZstdCompressor(level=1).compress(gaps.astype("<i4").tobytes())],
    )


def index_documents(docs: DataFrame, terms: list[bytes] | None = None) -> DataFrame:
    """Store the positional index of ``doc_id, text``; ``terms`` (a bounded list) restricts
    it to postings that a known test set can ask for. A shard closes at ``SHARD_BYTES`` of
    text, or after one longer document."""
    wanted = None if terms is None else {t: i for i, t in enumerate(terms)}

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text"))):
                held.append((doc_id, text))
                size += len(text) + 64
                if size >= SHARD_BYTES:
                    yield _shard(number, held, wanted)
                    held, size, number = [], 0, number + 1
        if held:
            yield _shard(number, held, wanted)

    return stored(docs.select("doc_id", "text").mapInArrow(build, SHARD_COLUMNS), "postings")


class Shard:
    """An index row, with its postings as one sorted list of (term, position)."""

    def __init__(self, row: dict) -> None:
        self.number = row["shard"]
        self.doc_ids = row["doc_ids"]
        self.texts = row["keys"]
        self.sizes = np.array(row["sizes"], np.int64)
        self.bases = np.cumsum(self.sizes + 1) - self.sizes - 1
        self.width = int((self.sizes + 1).sum()) + 1
        names = row["terms"].split(b" ") if row["terms"] else []
        self.terms = {name: i for i, name in enumerate(names)}
        self.counts = np.frombuffer(row["counts"], "<i4").astype(np.int64)
        gaps = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["postings"]), "<i4")
        self.positions = np.cumsum(gaps, dtype=np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        self.keys = np.repeat(np.arange(len(names)), self.counts) * self.width + self.positions

    def holds(self, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether ``term`` has a posting from ``low`` to ``high``."""
        k = np.searchsorted(self.keys, term * self.width + low)
        k = np.minimum(k, len(self.keys) - 1)
        key = self.keys[k] - term * self.width
        return (key >= low) & (key <= high)

    def match(self, windows: Windows, slack: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window numbers, start positions and document rows of all matches."""
        none = np.zeros(0, np.int64)
        names = list(windows.terms)
        local = np.array([self.terms.get(name, -1) for name in names] + [-1], np.int64)
        if not len(self.keys) or not len(windows.rows):
            return none, none, none
        rows = local[windows.rows]
        inside = windows.rows >= 0
        live = np.flatnonzero(((rows >= 0) | ~inside).all(axis=1))
        rows, inside = rows[live], inside[live]
        cost = np.where(inside, self.counts[rows], np.iinfo(np.int64).max)
        order = np.argsort(cost, axis=1, kind="stable")
        rarest = order[:, 0]
        term = np.take_along_axis(rows, rarest[:, None], 1)[:, 0]
        count = self.counts[term]
        window = np.repeat(np.arange(len(live)), count)
        within = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
        anchor = self.positions[self.first[term][window] + within]
        doc = np.searchsorted(self.bases, anchor, "right") - 1
        start = anchor - rarest[window]
        for step in range(1, order.shape[1]):
            place = order[window, step]
            asked = inside[window, place]
            ok = ~asked
            at, base = (start + place)[asked], self.bases[doc][asked]
            ok[asked] = self.holds(
                rows[window, place][asked],
                np.maximum(at - slack, base),
                np.minimum(at + slack, base + self.sizes[doc][asked] - 1),
            )
            window, start, doc = window[ok], start[ok], doc[ok]
        return live[window], start, doc


def _hits(shard: Shard, windows: Windows, slack: int) -> dict:
    """Per document with a match: hit spans (word positions) and items."""
    window, start, doc = shard.match(windows, slack)
    start = start - shard.bases[doc]
    begin = np.maximum(start - slack, 0)
    end = np.minimum(start + windows.sizes[window] + slack, shard.sizes[doc])
    owner = np.array(windows.owner, np.int64)[window]
    order = np.lexsort((begin, doc))
    doc, begin, end, owner = doc[order], begin[order], end[order], owner[order]
    found = {}
    bounds = runs(doc)
    for a, b in zip(bounds[:-1], bounds[1:]):
        names = sorted({windows.items[i] for i in np.unique(owner[a:b])})
        found[int(doc[a])] = (*union(begin[a:b], end[a:b]), names)
    return found


def union(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of spans sorted by their begin, as separate spans."""
    if not len(begin):
        return begin, end
    reach = np.maximum.accumulate(end)
    fresh = np.r_[True, begin[1:] > reach[:-1]]
    last = np.r_[np.flatnonzero(fresh)[1:] - 1, len(begin) - 1]
    return begin[fresh], reach[last]


def blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> list[list[tuple[str, bytes]]]:
    """The test items in blocks of about ``block_bytes``, read one block at a time."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 16
    total = items.agg(F.sum(size.cast("long"))).first()[0] or 0
    n = -(-total // block_bytes)
    keyed = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), "text")
    block = F.pmod(F.xxhash64("text"), F.lit(max(1, n)))
    for k in range(n):
        rows = keyed.where(block == k).collect()
        yield [(i, (t or "").encode()) for i, t in rows]


def search_index(
    index: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    slack: int = 0,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per indexed document: its text's MD5, its words, the spans that test windows hit, and the
    items (as strings) with a matching window."""

    def searcher(windows: Windows):
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    shard = Shard(batch.slice(row, 1).to_pylist()[0])
                    found = _hits(shard, windows, slack)
                    empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), [])
                    each = [found.get(i, empty) for i in range(len(shard.doc_ids))]
                    yield table(
                        HITS,
                        shard=[shard.number] * len(each),
                        place=range(len(each)),
                        doc_id=shard.doc_ids,
                        key=shard.texts,
                        n_words=shard.sizes,
                        starts=[e[0] for e in each],
                        ends=[e[1] for e in each],
                        items=[e[2] for e in each],
                    )

        return search

    parts = [
        index.mapInArrow(searcher(Windows(block, window)), HIT_COLUMNS)
        for block in blocks(items, block_bytes)
    ] or [index.mapInArrow(searcher(Windows([], window)), HIT_COLUMNS)]
    if len(parts) == 1:
        return parts[0].drop("shard", "place")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    spans = F.flatten(F.collect_list(F.arrays_zip("starts", "ends")))
    return (
        every.groupBy("shard", "place", "doc_id", "key", "n_words")
        .agg(
            F.array_sort(spans).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
        .select(
            "doc_id",
            "key",
            "n_words",
            F.col("spans.starts").alias("starts"),
            F.col("spans.ends").alias("ends"),
            "items",
        )
    )


def covered(starts: str = "starts", ends: str = "ends") -> F.Column:
    """Words in the union of spans that are sorted by their start."""
    spans = F.arrays_zip(F.col(starts).alias("s"), F.col(ends).alias("e"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach"))

    def step(state, span):
        fresh = F.greatest(span["e"] - F.greatest(span["s"], state["reach"]), F.lit(0))
        return F.struct(
            (state["n"] + fresh).cast("long").alias("n"),
            F.greatest(state["reach"], span["e"]).cast("long").alias("reach"),
        )

    return F.aggregate(spans, zero, step, lambda state: state["n"])


def benchmark_terms(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> list[bytes] | None:
    """The items' terms when their texts fit in one block, else None (index every term)."""
    size = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")))
    if (size.first()[0] or 0) > block_bytes:
        return None
    return sorted({w for block in blocks(items, block_bytes) for _, t in block for w in words(t)})


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Exact phrase hits of the items' windows in every document: ``doc_id, key, n_words,
    n_hit, n_items, items, starts, ends, contaminated``; ``key``, the text's MD5, tells rows of
    one id apart."""
    index = index_documents(docs, benchmark_terms(items))
    hits = search_index(index, items, window)
    return hits.select(
        "doc_id",
        "key",
        "n_words",
        covered().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        "items",
        "starts",
        "ends",
        (F.size("starts") > 0).alias("contaminated"),
    )
