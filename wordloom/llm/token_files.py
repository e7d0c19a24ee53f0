"""Token-id files: independent zstandard frames, a seek table and a checksum per frame.

A file holds the ids of whole documents in ascending document order as little-endian
unsigned 32-bit numbers, in zstandard frames of about ``FRAME`` bytes that need no other
frame. Then follow two skippable frames that any zstandard reader passes over: the table of
documents (id, first id in the file, number of ids), and the public seekable format's seek
table, with compressed size, size and the low half of XXH64 for each frame. A reader fetches
both tables from the end and then only the frames that a document lies in.

Rows: a null text is empty, so the document holds the end id alone; a null document id is
kept as null and comes first; repeated ids are all kept, in the order of their texts' hashes; other
columns are ignored. An empty table gives no file and no row.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from wordloom.llm.common import new_folder, stored, table
from wordloom.llm.token_ids import token_ids

FRAME = 1 << 18

# Fixed values of the public zstandard seekable format.
SKIPPABLE_DOCUMENTS = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
FILES = pa.schema(
    [("file", pa.string()), ("part", pa.int32()), ("first_id", pa.int64())]
    + [(name, pa.int64()) for name in ("n_docs", "n_tokens", "n_bytes")]
)
RESULT = pa.schema([*DOCUMENTS, ("ids_crc32", pa.int64())])


class FileWriter:
    """Writes one file; frames end with a document, or where a long one fills them."""

    def __init__(self, out, level: int = 3, frame: int = FRAME) -> None:
        self.out, self.size = out, frame
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.pending, self.held, self.bytes = [], 0, 0
        self.frames: list[tuple[int, int, int]] = []
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        for start in range(0, len(ids), self.size):
            self.pending.append(ids[start : start + self.size])
            self.held += len(self.pending[-1])
            if self.held >= self.size:
                self._frame()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def _frame(self) -> None:
        if self.held:
            data = b"".join(self.pending)
            packed = self.compressor.compress(data)
            self._put(packed)
            check = xxhash.xxh64_intdigest(data) & 0xFFFFFFFF
            self.frames.append((len(packed), len(data), check))
            self.pending, self.held = [], 0

    def close(self) -> None:
        self._frame()
        counts = np.array(self.counts, np.int64)
        documents = table(
            DOCUMENTS, doc_id=self.doc_ids, start=np.cumsum(counts) - counts, n_tokens=counts
        )
        sink = io.BytesIO()
        with pa.ipc.new_stream(sink, DOCUMENTS) as stream:
            stream.write_batch(documents)
        index = self.compressor.compress(sink.getvalue())
        self._put(struct.pack("<II", SKIPPABLE_DOCUMENTS, len(index) + 4))
        self._put(index + struct.pack("<I", len(index)))
        entries = b"".join(struct.pack("<III", *frame) for frame in self.frames)
        footer = struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self._put(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(entries) + len(footer)))
        self._put(entries + footer)


class FileReader:
    """Reads the tables at the end of a file, then only the frames that are asked for."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        frames, flags, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("not a file of frames with checksums")
        at = size - 9 - 12 * frames
        entries = np.frombuffer(self._read(at, 12 * frames), "<u4").reshape(-1, 3)
        self.checks = entries[:, 2]
        self.packed = np.r_[0, np.cumsum(entries[:, 0], dtype=np.int64)]
        self.plain = np.r_[0, np.cumsum(entries[:, 1], dtype=np.int64)]
        at -= 8  # the seek table's own header
        (length,) = struct.unpack("<I", self._read(at - 4, 4))
        index = self._read(at - 4 - length, length)
        index = zstandard.ZstdDecompressor().decompressobj().decompress(index)
        self.documents = pa.ipc.open_stream(index).read_all()
        self.frames_read = 0
        self.last: tuple[int, bytes] = (-1, b"")

    def _read(self, at: int, length: int) -> bytes:
        self.source.seek(at)
        return self.source.read(length)

    def _frame(self, k: int) -> bytes:
        if self.last[0] != k:
            packed = self._read(int(self.packed[k]), int(self.packed[k + 1] - self.packed[k]))
            data = zstandard.ZstdDecompressor().decompress(
                packed, max_output_size=int(self.plain[k + 1] - self.plain[k])
            )
            if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.checks[k]:
                raise ValueError(f"frame {k} does not match its checksum")
            self.frames_read += 1
            self.last = (k, data)
        return self.last[1]

    def chunks(self, row: int) -> Iterator[bytes]:
        """The ids of the document in ``row`` of the table, frame by frame."""
        start = 4 * self.documents["start"][row].as_py()
        end = start + 4 * self.documents["n_tokens"][row].as_py()
        k = int(np.searchsorted(self.plain, start, "right")) - 1
        while start < end:
            base = int(self.plain[k])
            piece = self._frame(k)[start - base : end - base]
            yield piece
            start += len(piece)
            k += 1

    def ids(self, doc_id: int) -> list[np.ndarray]:
        """The ids of every row with this document id."""
        rows = [i for i, x in enumerate(self.documents["doc_id"].to_pylist()) if x == doc_id]
        return [np.frombuffer(b"".join(self.chunks(i)), "<u4") for i in rows]


def write_token_files(
    docs: DataFrame, vocabulary: str, end_id: int, folder: str | None = None
) -> DataFrame:
    """Write the ids of all documents, each with ``end_id`` after it, into files in
    ``folder``; gives one row per file. Texts are dealt out by ranges of ids and sorted, and
    every task writes one file by streaming, under a name of its own that becomes final when
    it is whole: a repeated task replaces its file by an equal one.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-files")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = token_ids(vocabulary), struct.pack("<I", end_id)
        part = TaskContext.get().partitionId()
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        path = f"{root}/part-{part:06d}.ids.zst"
        draft, out, writer = f"{path}.{uuid.uuid4().hex}.draft", None, None
        for batch in batches:
            if batch.num_rows and writer is None:
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(draft)
                writer = FileWriter(out)
            texts = batch.column("text").to_pylist()
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                writer.add(doc_id, encode(text) + end)
        if writer is not None:
            writer.close()
            out.close()
            fs.move(draft, path)
            yield table(
                FILES,
                file=[f"part-{part:06d}.ids.zst"],
                part=[part],
                first_id=writer.doc_ids[:1],
                n_docs=[len(writer.doc_ids)],
                n_tokens=[sum(writer.counts)],
                n_bytes=[writer.bytes],
            )

    # Ranges are sampled on the driver: the sample holds numbers, never texts.
    ordered = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    ordered = ordered.repartitionByRange("doc_id", "tie")
    ordered = ordered.sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    schema = "file string, part int, first_id long, n_docs long, n_tokens long, n_bytes long"
    return stored(ordered.mapInArrow(write, schema), "token-manifest")


def read_token_files(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """One row per document, read from the files: its id, the ids of all documents before
    it, how many it has, and their CRC-32. ``files`` has a row per written partition."""
    listed = sorted(files.select("part", "file", "n_tokens").collect())
    bases, total = [], 0
    for part, name, tokens in listed:
        bases.append((name, total))
        total += tokens

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, base in zip(*(c.to_pylist() for c in batch.columns)):
                with fs.open_input_file(f"{root}/{name}") as source:
                    reader = FileReader(source)
                    found = reader.documents.combine_chunks()
                    checks = []
                    for row in range(found.num_rows):
                        crc = 0
                        for piece in reader.chunks(row):
                            crc = zlib.crc32(piece, crc)
                        checks.append(crc)
                    yield table(
                        RESULT,
                        doc_id=found["doc_id"].to_pylist(),
                        start=found["start"].to_numpy() + base,
                        n_tokens=found["n_tokens"].to_numpy(),
                        ids_crc32=checks,
                    )

    names = spark.createDataFrame(bases, "file string, base long")
    names = names.repartition(max(1, len(bases)))
    return names.mapInArrow(scan, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, vocabulary: str, end_id: int = 2) -> DataFrame:
    """Write the token files of ``docs`` and read every document back from them."""
    folder = new_folder(docs.sparkSession, "token-files")
    files = write_token_files(docs, vocabulary, end_id, folder)
    return read_token_files(docs.sparkSession, folder, files)
