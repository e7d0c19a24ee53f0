"""Texts as numbered words, a block of documents at a time.

A block is a run of rows of one task. Its words are numbered, so a word stands once in what a
block sends on, however often it occurs there, and no word is a hot key. The numbers of a text
are kept as little-endian 32-bit integers or compressed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard


class Numbers:
    """Numbers words from 0 by their first use."""

    def __init__(self) -> None:
        self.known: dict[object, int] = {}
        self.fresh: list = []

    def number(self, words: list, kind: pa.DataType) -> np.ndarray:
        if not words:
            return np.zeros(0, np.int32)
        coded = pa.array(words, kind).dictionary_encode()
        places = np.empty(len(coded.dictionary), np.int32)
        for i, word in enumerate(coded.dictionary.to_pylist()):
            place = self.known.get(word)
            if place is None:
                place = self.known[word] = len(self.known)
                self.fresh.append(word)
            places[i] = place
        return places[coded.indices.to_numpy()]

    def news(self) -> tuple[int, list]:
        """The words that are new since the last call, and the number of the first of them."""
        words, self.fresh = self.fresh, []
        return len(self.known) - len(words), words


LEVEL = 9


def _planes(values: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=LEVEL).compress(planes.tobytes())


def squeezed(values: np.ndarray) -> bytes:
    """Numbers below 2^32, compressed: a byte for each, and apart from them, by planes of
    bytes, what the large ones have beyond it."""
    large = values >= 255
    low = np.where(large, 255, values).astype(np.uint8).tobytes()
    low = zstandard.ZstdCompressor(level=LEVEL).compress(low)
    return len(low).to_bytes(4, "little") + low + _planes(values[large] - 255)


def spread(data: bytes) -> np.ndarray:
    cut = 4 + int.from_bytes(data[:4], "little")
    unpacked = zstandard.ZstdDecompressor().decompress
    values = np.frombuffer(unpacked(data[4:cut]), np.uint8).astype("<u4")
    planes = np.frombuffer(unpacked(data[cut:]), np.uint8).reshape(4, -1)
    values[values == 255] += np.ascontiguousarray(planes.T).view("<u4").ravel()
    return values


def pack(values: list[bytes]) -> bytes:
    """A list of byte strings, compressed."""
    lengths = squeezed(np.fromiter(map(len, values), np.int64, len(values)))
    body = zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(values))
    return len(lengths).to_bytes(4, "little") + lengths + body


def opened(data: bytes) -> tuple[np.ndarray, bytes]:
    """The lengths of a packed list, and its byte strings joined."""
    cut = 4 + int.from_bytes(data[:4], "little")
    body = zstandard.ZstdDecompressor().decompress(data[cut:])
    return spread(data[4:cut]).astype(np.int64), body


def unpack(data: bytes) -> list[bytes]:
    lengths, body = opened(data)
    ends = np.cumsum(lengths).tolist()
    return [body[a:b] for a, b in zip([0, *ends], ends)]


def as_rows(parts: list[np.ndarray]) -> list[bytes]:
    return [np.ascontiguousarray(p, "<i4").tobytes() for p in parts]


def of_row(row: bytes | None) -> np.ndarray:
    return np.frombuffer(row or b"", "<i4")


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the ranges [start, start + length), one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
