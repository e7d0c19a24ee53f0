"""Removal of every long string that occurs twice, with run-length indexes of what repeats.

A byte goes when a string of ``length`` bytes that covers it also starts anywhere else.

1. Every string of ``length`` bytes selects one of the ``GRAM``-byte grams in it, the one with
   the smallest rolling hash (the first on ties). Neighbouring strings that select the same
   gram form one stretch of at most ``2 * length - GRAM`` bytes. Equal strings select equal
   grams at equal places, so repeats are only looked for among stretches of one gram.
2. Stretches are counted by gram and by content. A content that occurs twice repeats whole.
   A gram with one content needs nothing more. Only contents of grams with several are left:
   one stretch of each is fetched from the texts, and all of one gram meet.
3. There the index is built: the suffixes are sorted, their Burrows-Wheeler transform is cut
   into runs, and the suffix and its predecessor's match are sampled at the run heads. The
   matching statistics of all other places follow from the sample before them, in one stream
   (the match shrinks by one and both places move by one). Places with a match of ``length``
   bytes or more, and the places that they match, are marked.

A gram with more than ``CROWD`` contents (a passage in very many surroundings) is not brought
together: its strings are counted by hash in a plain aggregate, which no group size bounds.

Rows: a null text is empty; texts shorter than ``length`` keep all; rows equal in id and text
are two documents that repeat each other; a null ``doc_id`` is kept; an empty table gives no
row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from wordloom.llm.common import runs, stored, table, utf8
from wordloom.llm.decontaminate import union

LENGTH = 400
GRAM = 200
CROWD = 1000
CHUNK = 1 << 19
BLOCK = 1 << 20
PACK = 7  # bytes in the first key of the suffix order, with their number in the eighth

STRETCHES = pa.schema(
    [(n, pa.int64()) for n in ("gram", "body", "doc_id", "doc")]
    + [("start", pa.int32()), ("size", pa.int32())]
)
STRETCH_COLUMNS = "gram long, body long, doc_id long, doc long, start int, size int"
SPANS = pa.schema([("gram", pa.int64()), ("body", pa.int64()), ("span", pa.binary())])
STRINGS = pa.schema(
    [("string", pa.binary()), ("gram", pa.int64()), ("body", pa.int64()), ("at", pa.int32())]
)
RESULT = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "n_bytes", "n_removed", "n_spans")]
    + [("kept_sha256", pa.string())]
)


@lru_cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random odd numbers per byte, and powers of an odd base and of its inverse."""
    base = 0x9E3779B97F4A7C15
    seeds = np.random.default_rng(9).integers(0, 1 << 63, 256, dtype=np.uint64)
    both = []
    for number in (base, pow(base, -1, 1 << 64)):
        power = np.full(size, number, np.uint64)
        power[0] = 1
        both.append(np.multiply.accumulate(power))
    return seeds * np.uint64(2) + np.uint64(1), *both


def rolling(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of every ``gram`` bytes of ``data``."""
    n = len(data)
    seeds, power, inverse = _powers(1 << (n - 1).bit_length())
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(seeds[data] * inverse[:n], out=total[1:])
    value = (total[gram:] - total[: n - gram + 1]) * power[: n - gram + 1]
    value ^= value >> np.uint64(32)
    value *= np.uint64(0xD6E8FEB86659FD93)
    value ^= value >> np.uint64(32)
    return value


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours."""
    full = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    full[: len(values)] = values
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def stretches(
    data: np.ndarray, bounds: np.ndarray, length: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gram, first string and number of strings of every stretch. ``bounds``: where the texts
    in ``data`` begin, and the end; each is at least ``length`` long."""
    low = np.uint64((1 << 24) - 1)
    hashes = rolling(data, gram)
    # The hash's high bits decide, then the place.
    keyed = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    place = (smallest(keyed, length - gram + 1) & low).astype(np.int64)
    inside = np.ones(len(place), bool)
    for cut in bounds[1:-1]:
        inside[cut - length + 1 : cut] = False
    fresh = np.r_[True, place[1:] != place[:-1]] | np.r_[True, ~inside[:-1]]
    first = np.flatnonzero(fresh & inside)
    ends = np.flatnonzero((np.r_[fresh[1:], True] | np.r_[~inside[1:], True]) & inside)
    return hashes[place[first]].view(np.int64), first, ends - first + 1


def _groups(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Texts in groups of about ``CHUNK`` bytes; a longer text is cut into parts that
    overlap so that no string is lost. Rows: number, offset, bytes."""
    held, size = [], 0
    for i, text in enumerate(texts):
        step = 8 * CHUNK
        for at in range(0, max(1, len(text) - length + 1), step):
            part = text[at : at + step + length - 1]
            if len(part) < length:
                continue
            held.append((i, at, part))
            size += len(part)
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


def find_stretches(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """All stretches of ``doc_id, doc, text``; no shuffle."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.array(batch.column("doc_id").to_pylist(), object)
            docs_ = batch.column("doc").to_numpy()
            for group in _groups(utf8(batch.column("text")), length):
                joined = b"".join(part for _, _, part in group)
                bounds = np.r_[0, np.cumsum([len(part) for _, _, part in group])]
                found, first, size = stretches(
                    np.frombuffer(joined, np.uint8), bounds, length, gram
                )
                ends = first + size + (length - 1)
                body = [
                    xxhash.xxh3_64_intdigest(joined[a:b])
                    for a, b in zip(first.tolist(), ends.tolist())
                ]
                row = np.searchsorted(bounds, first, "right") - 1
                number = np.array([i for i, _, _ in group])[row]
                offset = np.array([at for _, at, _ in group])[row] - bounds[row]
                yield table(
                    STRETCHES,
                    gram=found,
                    body=np.array(body, np.uint64).view(np.int64),
                    doc_id=ids[number].tolist(),
                    doc=docs_[number],
                    start=(first + offset).astype(np.int32),
                    size=size.astype(np.int32),
                )

    return docs.mapInArrow(each, STRETCH_COLUMNS)


class RunIndex:
    """Run-length index of some spans: suffix order, runs of the Burrows-Wheeler transform,
    and samples at the run heads."""

    def __init__(self, spans: list[bytes]) -> None:
        sizes = np.array([len(s) for s in spans], np.int64)
        self.text = np.frombuffer(b"".join(spans), np.uint8)
        self.begins = np.cumsum(sizes) - sizes
        n = len(self.text)
        self.left = np.repeat(self.begins + sizes, sizes) - np.arange(n)
        order = self._sort(int(sizes.max(initial=0)))
        # A span's first place has no byte before it and always heads a run.
        before = np.r_[self.text[-1:], self.text[:-1]][order].astype(np.int64)
        before[np.isin(order, self.begins)] = -1
        head = np.r_[True, (before[1:] != before[:-1]) | (before[1:] < 0)]
        heads = np.flatnonzero(head)
        self.runs = len(heads)
        at, previous = order[heads], order[np.maximum(heads - 1, 0)]
        match = self._match(at, previous)
        match[heads == 0] = 0
        by_place = np.argsort(at)
        self.sample, self.previous, self.match = at[by_place], previous[by_place], match[by_place]

    def _key(self, rank: np.ndarray, step: int) -> np.ndarray:
        n = len(rank)
        after = np.zeros(n, np.int64)
        longer = np.flatnonzero(self.left > step)
        after[longer] = rank[longer + step] + 1
        return rank * (n + 1) + after

    def _sort(self, longest: int) -> np.ndarray:
        """Places in the order of their suffixes (up to the span's end, then by place). The
        ranks of every doubling stay, to measure matches by them."""
        n = len(self.text)
        padded = np.r_[self.text, np.zeros(PACK, np.uint8)].astype(np.int64)
        key = np.zeros(n, np.int64)
        for i in range(PACK):
            key = key << 8 | np.where(self.left > i, padded[i : i + n], 0)
        # Seven bytes and their number fit 59 bits.
        key = key << 3 | np.minimum(self.left, PACK)
        self.levels, step = [], PACK
        while True:
            order = np.argsort(key, kind="stable")
            held = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.r_[False, held[1:] != held[:-1]])
            self.levels.append((step, rank.astype(np.int32)))
            if step >= longest or (n and rank[order[-1]] == n - 1):
                return order
            key = self._key(rank, step)
            step *= 2

    def _match(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at ``a`` and ``b``."""
        most = np.minimum(self.left[a], self.left[b])
        done = np.zeros(len(a), np.int64)
        for step, rank in reversed(self.levels):
            # A step counts when it lies inside both: equal ranks then mean equal bytes.
            for _ in range(2 if step == self.levels[-1][0] else 1):
                fits = np.flatnonzero(done + step <= most)
                same = rank[a[fits] + done[fits]] == rank[b[fits] + done[fits]]
                done[fits[same]] += step
        for _ in range(PACK):
            fits = np.flatnonzero(done < most)
            same = self.text[a[fits] + done[fits]] == self.text[b[fits] + done[fits]]
            done[fits[same]] += 1
        return done

    def statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """For every place the length of its match and the place that it matches."""
        at = np.arange(len(self.text))
        sample = np.searchsorted(self.sample, at, "right") - 1
        moved = at - self.sample[sample]
        return np.maximum(self.match[sample] - moved, 0), self.previous[sample] + moved

    def repeated(self, length: int) -> np.ndarray:
        """The places where a string of ``length`` bytes begins that also begins elsewhere."""
        match, other = self.statistics()
        long = np.flatnonzero(match >= length)
        return np.unique(np.concatenate([long, other[long]]))


def _mark(length: int):
    """For stretches of whole grams: the byte ranges of each that repeat."""

    def mark(data: pa.Table) -> pa.Table:
        gram, body = data["gram"].to_numpy(), data["body"].to_numpy()
        spans = data["span"].to_pylist()
        order = np.argsort(gram, kind="stable")
        found: list[tuple[int, int, list, list]] = []
        bounds = runs(gram[order])
        held: list[int] = []

        def flush() -> None:
            if not held:
                return
            index = RunIndex([spans[i] for i in held])
            place = index.repeated(length)
            owner = np.searchsorted(index.begins, place, "right") - 1
            cuts = runs(owner)
            for a, b in zip(cuts[:-1], cuts[1:]):
                at = place[a:b] - index.begins[owner[a]]
                low, high = union(at, at + length)
                i = held[owner[a]]
                found.append((gram[i], body[i], low.tolist(), high.tolist()))
            held.clear()

        size = 0
        for a, b in zip(bounds[:-1], bounds[1:]):
            held.extend(order[a:b].tolist())
            size += sum(len(spans[i]) for i in order[a:b])
            if size >= BLOCK:
                flush()
                size = 0
        flush()
        columns = list(zip(*found)) if found else [[], [], [], []]
        types = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        arrays = [pa.array(list(c), t) for c, t in zip(columns, types)]
        return pa.Table.from_arrays(arrays, names=["gram", "body", "low", "high"])

    return mark


def _strings(length: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gram, body, span in zip(*(c.to_pylist() for c in batch.columns)):
                n = len(span) - length + 1
                yield table(
                    STRINGS,
                    string=[xxhash.xxh3_128_digest(span[i : i + length]) for i in range(n)],
                    gram=[gram] * n,
                    body=[body] * n,
                    at=range(n),
                )

    return each


def _fetch(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the ``wanted`` stretches (``gram, body, doc_id, doc, start, size``)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, asked in zip(utf8(batch.column("text")), batch.column("asked").to_pylist()):
                for r in asked:
                    end = r["start"] + r["size"] + length - 1
                    rows.append((r["gram"], r["body"], text[r["start"] : end]))
            columns = zip(*rows) if rows else [[]] * 3
            yield table(SPANS, **dict(zip(SPANS.names, map(list, columns))))

    asked = wanted.groupBy("doc_id", "doc").agg(
        F.collect_list(F.struct("gram", "body", "start", "size")).alias("asked")
    )
    same = docs["doc_id"].eqNullSafe(asked["doc_id"]) & (docs["doc"] == asked["doc"])
    # Rows equal in id and text hold the same bytes: only one of a stretch's copies is used.
    met = docs.join(asked.hint("shuffle_hash"), same).select("text", "asked")
    spans = met.mapInArrow(cut, "gram long, body long, span binary")
    return spans.groupBy("gram", "body").agg(F.any_value("span").alias("span"))


def repeated_ranges(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD
) -> DataFrame:
    """``doc_id, doc, low, high``: byte ranges that repeat, in arrays per document. ``docs``:
    ``doc_id, doc, text``."""
    found = stored(find_stretches(docs, length, gram), "stretches")
    one = F.min(F.struct("doc_id", "doc", "start", "size")).alias("one")
    bodies = found.groupBy("gram", "body").agg(F.count(F.lit(1)).alias("n"), one)
    bodies = bodies.withColumnRenamed("gram", "g")
    heads = found.groupBy("gram", "body").agg(F.count(F.lit(1)).alias("n"))
    heads = heads.groupBy("gram").agg(
        F.count(F.lit(1)).alias("bodies"), F.sum("n").alias("places")
    )
    heads = heads.where("places > 1").select("gram", "bodies")
    known = bodies.join(heads, bodies["g"] == heads["gram"]).select(
        "gram", "body", "n", "one", "bodies"
    )
    known = stored(known, "repeated-grams")
    wanted = known.where("bodies > 1").select("gram", "body", "bodies", "one.*")
    spans = stored(_fetch(docs, wanted, length), "spans")
    crowded = known.where(F.col("bodies") > crowd).select("gram").distinct()

    few = spans.join(crowded, "gram", "left_anti")
    dealt = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4
    few = few.withColumn("deal", F.pmod(F.xxhash64("gram"), F.lit(dealt)))
    indexed = few.groupBy("deal").applyInArrow(
        _mark(length), "gram long, body long, low array<int>, high array<int>"
    )

    many = spans.join(crowded, "gram", "left_semi").select("gram", "body", "span")
    strings = many.mapInArrow(_strings(length), "string binary, gram long, body long, at int")
    twice = strings.groupBy("string").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counted = strings.join(twice, "string").groupBy("gram", "body").agg(
        F.sort_array(F.collect_list("at")).alias("low")
    )
    counted = counted.withColumn("high", F.transform("low", lambda i: i + length))

    whole = known.where("n > 1").select(
        "gram",
        "body",
        F.array(F.lit(0)).alias("low"),
        F.array((F.col("one.size") + (length - 1)).cast("int")).alias("high"),
    )
    # A content that repeats whole needs no other finding.
    name = ["gram", "body"]
    parts = indexed.unionByName(counted).join(whole.select(*name), name, "left_anti")
    ranges = stored(whole.unionByName(parts), "ranges")
    placed = found.join(ranges, ["gram", "body"]).select(
        "doc_id",
        "doc",
        F.transform("low", lambda x: x + F.col("start")).alias("low"),
        F.transform("high", lambda x: x + F.col("start")).alias("high"),
    )
    return placed.groupBy("doc_id", "doc").agg(
        F.flatten(F.collect_list("low")).alias("low"),
        F.flatten(F.collect_list("high")).alias("high"),
    )


def cut_repeats(text: bytes, low: list[int], high: list[int]) -> tuple[bytes, np.ndarray]:
    """``text`` without the ranges, and the separate ranges that went."""
    low, high = np.array(low, np.int64), np.array(high, np.int64)
    order = np.argsort(low, kind="stable")
    low, high = union(low[order], high[order])
    edges = np.r_[0, np.stack([low, high], axis=1).ravel(), len(text)]
    kept = b"".join(text[a:b] for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()))
    return kept, np.stack([low, high], axis=1)


def remove_repeats(docs: DataFrame, length: int = LENGTH, **settings) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the bytes that stay, which need not end
    at a character) for every document."""
    text = F.coalesce("text", F.lit(""))
    docs = docs.select("doc_id", F.xxhash64("doc_id", text).alias("doc"), text.alias("text"))
    ranges = repeated_ranges(docs, length, **settings)
    same = docs["doc_id"].eqNullSafe(ranges["doc_id"]) & (docs["doc"] == ranges["doc"])
    met = docs.join(ranges.hint("shuffle_hash"), same, "left").select(
        docs["doc_id"], "text", "low", "high"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, low, high in zip(
                batch.column("doc_id").to_pylist(),
                utf8(batch.column("text")),
                batch.column("low").to_pylist(),
                batch.column("high").to_pylist(),
            ):
                kept, gone = cut_repeats(text, low or [], high or [])
                digest = hashlib.sha256(kept).hexdigest()
                rows.append((doc_id, len(text), len(text) - len(kept), len(gone), digest, kept))
            columns = list(zip(*rows)) if rows else [[]] * 6
            body = table(RESULT, **dict(zip(RESULT.names, map(list, columns[:5]))))
            yield body.append_column("kept", pa.array(list(columns[5]), pa.binary()))

    return met.mapInArrow(
        cut,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
    )
