"""Byte-level BPE over a whole corpus: each distinct word is merged once.

Encoding: texts are cut into pre-tokens, each with its place (``blocks``: a word stands once in
the list of a block, its places stay together as numbers). The blocks' words are dealt by their
hash, so that the same word of all blocks meets in one part and goes through the merges once;
the ids are joined back to the blocks, and every text is put together from the ids of its words
in the order of its places. What is stored and moved is compressed: one number per place, and
the words of a block once.
Decoding joins ids with the vocabulary's table of token bytes.

Both work for any vocabulary of ranks and any split pattern. Null texts count as empty; empty
texts give no ids; rows are kept as they are, repeated or without an id; all columns but the key
and the text stay behind, so none can clash; an empty table gives an empty one. Texts of any
length are one row each. An id that the vocabulary does not have is refused.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wordloom.llm.blocks import Numbers, expand, of_row, opened, pack, spread, squeezed, unpack
from wordloom.llm.common import delete, new_folder, stored, table
from wordloom.sizing import BROADCAST_BYTES

_USES = pa.schema(
    [
        ("block", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("counts", pa.binary()),
        ("places", pa.binary()),
        ("part_of", pa.binary()),
        ("part", pa.int64()),
        ("words", pa.binary()),
    ]
)
_USES_SQL = (
    "block long, doc_ids array<long>, counts binary, places binary, part_of binary, "
    "part long, words binary"
)
_IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
BLOCK_BYTES = 12 << 20
LEAST_PARTS = 12
WORDS_AT_ONCE = 100_000
#: A letter, a digit and a sign, in place of characters that two Unicode versions see differently.
_STAND_INS = {"L": "x", "N": "0", "": "☃"}
DECODE_CHUNK = 4096


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a file of ranks: base64 and a number in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def _encoding(ranks: dict[bytes, int], pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def _differences() -> dict[int, str]:
    """Characters whose class differs between this process's pattern library and the
    tokenizer's, which follow different Unicode versions, with a stand-in of the tokenizer's
    class. Every character is asked of both."""
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    everything = "".join(map(chr, points))
    theirs: dict[str, str] = {}
    ours: dict[str, str] = {}
    for kind in "LN":
        single = {bytes([b]): b for b in range(256)}
        found = bytes(_encoding(single, rf"\p{{{kind}}}").encode_ordinary(everything)).decode()
        theirs.update(dict.fromkeys(found, kind))
        ours.update(dict.fromkeys(regex.findall(rf"\p{{{kind}}}", everything), kind))
    changed = {c for c in theirs.keys() | ours.keys() if theirs.get(c) != ours.get(c)}
    return {ord(c): _STAND_INS[theirs.get(c, "")] for c in changed}


def splitter(pattern: str, differences: dict[int, str]) -> Callable[[str], list[str]]:
    """Cuts a text into the matches that the tokenizer would find. Texts with characters that
    the two libraries class differently are matched on their stand-ins."""
    find = regex.compile(pattern)
    odd = {chr(c) for c in differences}
    far = regex.compile(f"[{min(odd)}-\U0010ffff]") if odd else None

    def cut(text: str) -> list[str]:
        if text.isascii() or not far or not far.search(text) or odd.isdisjoint(text):
            return [m for m in find.findall(text) if m]
        spans = (m.span() for m in find.finditer(text.translate(differences)))
        return [text[a:b] for a, b in spans if a < b]

    return cut


class _Block:
    """The texts of a block: their words as numbers in order, and the words."""

    def __init__(self) -> None:
        self.numbers, self.parts, self.doc_ids, self.counts = Numbers(), [], [], []

    def add(self, batch: pa.RecordBatch, cut: Callable[[str], list[str]]) -> None:
        words: list[str] = []
        for text in batch.column(1):
            found = cut(text.as_py() or "")
            self.counts.append(len(found))
            words += found
            if len(words) >= WORDS_AT_ONCE:
                self.parts.append(self.numbers.number(words, pa.string()))
                words = []
        self.doc_ids += batch.column(0).to_pylist()
        self.parts.append(self.numbers.number(words, pa.string()))

    def rows(self, block: int, parts: int) -> pa.RecordBatch:
        """One row of the texts, and one of the words of each part. Frequent words get small
        numbers, equally frequent ones in the order of their letters: both compress well."""
        places = np.concatenate(self.parts)
        names = pa.array(list(self.numbers.known), pa.string())
        self.numbers = self.parts = None
        uses = np.bincount(places, minlength=len(names))
        ranking = [("uses", "descending"), ("name", "ascending")]
        order = pc.sort_indices(pa.table({"name": names, "uses": uses}), sort_keys=ranking)
        new = np.empty(len(names), np.int64)
        new[order.to_numpy()] = np.arange(len(names))
        listed: dict[int, list[bytes]] = {}
        part_of = np.empty(len(names), np.int64)
        for number, word in enumerate(names.take(order).cast(pa.binary())):
            word = word.as_py()
            part = part_of[number] = xxhash.xxh64_intdigest(word) % parts
            listed.setdefault(part, []).append(word)
        first = {"doc_ids": self.doc_ids, "counts": squeezed(np.array(self.counts))}
        first |= {"places": squeezed(new[places]), "part_of": squeezed(part_of)}
        return table(
            _USES,
            block=[block] * (1 + len(listed)),
            part=[None, *listed],
            words=[None, *map(pack, listed.values())],
            **{name: [value] + [None] * len(listed) for name, value in first.items()},
        )


def _uses(docs: DataFrame, pattern: str, parts: int) -> DataFrame:
    """A row per block with its texts, and a row per block and part with its words."""
    differences = _differences()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, number = splitter(pattern, differences), TaskContext.get().partitionId() << 32
        block, used = _Block(), 0
        for batch in batches:
            block.add(batch, cut)
            used += batch.nbytes
            if used >= BLOCK_BYTES:
                yield block.rows(number, parts)
                block, used, number = _Block(), 0, number + 1
        if block.parts:
            yield block.rows(number, parts)

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(run, _USES_SQL)


def _merged(words: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """The words' ids. All blocks' words of one part meet, where each distinct one is merged
    once; their number, with that of the parts, does not grow with the corpus."""
    schema = pa.schema([("of", pa.int64()), ("part", pa.int64()), ("ids", pa.binary())])

    def run(found: pa.Table) -> pa.Table:
        encode, known, out = _encoding(ranks, pattern).encode_ordinary, {}, []
        for data in found["words"]:
            ids = []
            for word in unpack(data.as_py()):
                if word not in known:
                    known[word] = np.array(encode(word.decode()), "<u4").tobytes()
                ids.append(known[word])
            # Words in the order of their letters share beginnings, so their ids repeat.
            out.append(pack(ids))
        columns = [found["block"], found["part"], pa.array(out, pa.binary())]
        return pa.table(columns, schema=schema)

    return words.groupBy("part").applyInArrow(run, "of long, part long, ids binary")


def _together(texts: pa.Table, words: pa.Table) -> pa.Table:
    """The ids of a block's texts from the ids of its words."""
    if not len(texts):
        return _IDS.empty_table()
    row = texts.to_pylist()[0]
    part_of, places, counts = (spread(row[c]) for c in ("part_of", "places", "counts"))
    starts, lengths = np.zeros(len(part_of), np.int64), np.zeros(len(part_of), np.int64)
    pools, held = [], 0
    for part, data in zip(words["part"].to_pylist(), words["ids"].to_pylist()):
        mine, (sizes, ids) = np.flatnonzero(part_of == part), opened(data)
        sizes //= 4
        starts[mine], lengths[mine] = held + np.cumsum(sizes) - sizes, sizes
        pools.append(np.frombuffer(ids, "<u4"))
        held += len(pools[-1])
    pool = np.concatenate(pools) if pools else np.zeros(0, "<u4")
    out, end = [], 0
    for count in counts.tolist():
        mine = places[end : end + count]
        out.append(pool[expand(starts[mine], lengths[mine])].tobytes())
        end += count
    doc_ids = pa.array(row["doc_ids"], pa.int64())
    return pa.table([doc_ids, pa.array(out, pa.binary())], schema=_IDS)


def encode(docs: DataFrame, path: str, pattern: str, parts: int | None = None) -> DataFrame:
    """``doc_id`` and ``ids``, the text's ids as little-endian unsigned 32-bit integers, for
    every row of ``docs`` (``doc_id``, ``text``).

    Words are dealt to ``parts`` by their hash: unless named, as many as the input has
    partitions, so that a part's words stay as many at any size of the corpus.
    """
    ranks = read_ranks(path)
    parts = parts or max(LEAST_PARTS, docs.rdd.getNumPartitions())
    spark, path = docs.sparkSession, new_folder(docs.sparkSession, "words")
    kind = F.when(F.col("words").isNull(), "texts").otherwise("words")
    uses = _uses(docs, pattern, parts).withColumn("kind", kind)
    uses.write.partitionBy("kind").parquet(path)
    uses = spark.read.schema(uses.schema).parquet(path)
    words = uses.where(F.col("kind") == "words").select("block", "part", "words")
    texts = uses.where(F.col("kind") == "texts").drop("part", "words", "kind")
    ids = stored(_merged(words, ranks, pattern), "ids")
    # The words have done their work once their ids are stored.
    delete(spark, f"{path}/kind=words")
    together = texts.groupBy("block").cogroup(ids.groupBy("of"))
    return together.applyInArrow(_together, "doc_id long, ids binary")


def token_bytes(spark: SparkSession, path: str) -> DataFrame:
    """The vocabulary's table: ``id`` and ``bytes`` of every token."""
    rows = [(i, b) for b, i in read_ranks(path).items()]
    return spark.createDataFrame(rows, "id long, bytes binary")


def decode(tokens: DataFrame, vocabulary: DataFrame, small: bool | None = None) -> DataFrame:
    """``tokens`` (``doc_id``, ``ids``) with ``decoded``, the bytes of its ids.

    ``vocabulary`` (``id``, ``bytes``) is measured: below the broadcast bound every task has
    the whole table and joins in place; beyond it ids and table meet in a shuffle.
    """
    size = F.sum(F.octet_length("bytes") + F.lit(16))
    total, last = vocabulary.agg(size, F.max("id")).first()
    if small is None:
        small = (total or 0) <= BROADCAST_BYTES and (last or 0) * 8 <= BROADCAST_BYTES
    if not small:
        return _decode_by_shuffle(tokens, vocabulary)
    listed: list = [None] * ((-1 if last is None else last) + 1)
    for row in vocabulary.collect():
        listed[row["id"]] = bytes(row["bytes"])
    spread = tokens.sparkSession.sparkContext.broadcast(listed)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(spread.value, pa.large_binary())
        for batch in batches:
            ids = [of_row(x).view("<u4") for x in batch.column(1).to_pylist()]
            decoded = [_joined(known, x) for x in ids]
            yield table(schema, doc_id=batch.column(0), ids=batch.column(1), decoded=decoded)

    columns = "doc_id long, ids binary, decoded binary"
    return tokens.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, columns)


def _joined(known: pa.Array, ids: np.ndarray) -> bytes:
    if not len(ids):
        return b""
    if ids.max() >= len(known):
        raise ValueError(f"id {ids.max()} is not in the vocabulary")
    found = known.take(pa.array(ids))
    if found.null_count:
        raise ValueError("an id is not in the vocabulary")
    ends = np.frombuffer(found.buffers()[1], "<i8")[found.offset :]
    return found.buffers()[2][ends[0] : ends[len(found)]].to_pybytes()


def _decode_by_shuffle(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The same by a join of the exploded ids, in chunks of ``DECODE_CHUNK``: an id has one row
    per chunk at most, and what comes back meets by chunk, then by row."""
    schema = pa.schema(
        [
            ("row", pa.int64()),
            ("chunk", pa.int32()),
            ("id", pa.int64()),
            ("at", pa.list_(pa.int32())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = of_row(ids).view("<u4")
                for chunk, start in enumerate(range(0, len(ids), DECODE_CHUNK)):
                    part = ids[start : start + DECODE_CHUNK]
                    kinds, place, counts = np.unique(
                        part, return_inverse=True, return_counts=True
                    )
                    order = np.argsort(place, kind="stable").astype(np.int32)
                    yield table(
                        schema,
                        row=[row] * len(kinds),
                        chunk=[chunk] * len(kinds),
                        id=kinds.tolist(),
                        at=np.split(order, np.cumsum(counts)[:-1]),
                    )

    numbered = F.monotonically_increasing_id().alias("row")
    rows = stored(tokens.select(numbered, F.col("doc_id").cast("long"), "ids"), "ids")
    columns = "row long, chunk int, id long, at array<int>"
    pieces = rows.select("row", "ids").mapInArrow(run, columns)
    known = pieces.join(vocabulary.select("id", "bytes"), "id", "left")
    said = F.concat(F.lit("an id is not in the vocabulary: "), F.col("id").cast("string"))
    refused = F.when(F.col("bytes").isNull(), F.raise_error(said)).otherwise(F.col("bytes"))
    spots = known.select("row", "chunk", F.explode("at").alias("place"), refused.alias("bytes"))
    chunks = spots.groupBy("row", "chunk").agg(_in_order("place", "bytes"))
    texts = chunks.groupBy("row").agg(_in_order("chunk", "bytes"))
    decoded = F.coalesce("bytes", F.lit(b"")).alias("decoded")
    return rows.join(texts, "row", "left").select("doc_id", "ids", decoded)


def _in_order(place: str, column: str) -> Column:
    """The group's bytes, concatenated by place."""
    parts = F.array_sort(F.collect_list(F.struct(place, column)))
    return F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x[column])).alias(column)
