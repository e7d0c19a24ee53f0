"""Token ids against the library, and token files as an exact round trip."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.fs
import pytest
import zstandard
from tokenizers import Tokenizer

from wordloom.llm.token_files import FileReader, FileWriter, read_token_files, write_token_files
from wordloom.llm.token_ids import VOCABULARY, TokenIds, token_ids

PATH = public_tokenizers.path(VOCABULARY)


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_of_odd_texts(whole):
    letters = "aA1'sStTéÉÈßÞþ×÷ÿÀ<|>!.,_-́\xa0 \x1c\x0b\x85 \n\tİıĳ東ªº²½😀"
    r = random.Random(1)
    encode = TokenIds(PATH)
    for _ in range(4000):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 14)))
        text += "<|endoftext|>" * (r.random() < 0.05)
        assert np.frombuffer(encode(text), "<u4").tolist() == whole(text), repr(text)


def test_memory_is_bounded(monkeypatch):
    encode = TokenIds(PATH)
    encode.word.most = encode.part.most = 5
    texts = [f"word{i} other{i}" for i in range(50)]
    fresh = TokenIds(PATH)
    assert [encode(t) for t in texts] == [fresh(t) for t in texts]
    assert len(encode.word) <= 5


def test_round_trip(spark, frame, odd, whole, tmp_path):
    folder = f"file://{tmp_path}/ids"
    files = write_token_files(frame(odd), PATH, 2, folder)
    got = read_token_files(spark, folder, files).collect()
    rows = sorted(odd, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [r[0] for r in rows]
    want = sorted(
        (d, len(i), zlib.crc32(np.array(i, "<u4").tobytes()))
        for d, i in ((r[0] or -1, [*whole(r[1]), 2]) for r in odd)
    )
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in got) == want
    ends = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(ends, ends[1:])) and ends[0][0] == 0


def test_empty(spark, frame, tmp_path):
    folder = f"file://{tmp_path}/none"
    files = write_token_files(frame([]), PATH, 2, folder)
    assert read_token_files(spark, folder, files).collect() == []


def test_reader_reads_only_what_it_needs(tmp_path):
    path = str(tmp_path / "one")
    docs = {i: np.arange(i * 100, i * 100 + 300 + i, dtype="<u4") for i in range(50)}
    with open(path, "wb") as out:
        writer = FileWriter(out, frame=4096)
        for i, ids in docs.items():
            writer.add(i, ids.tobytes())
        writer.close()
    fs = pyarrow.fs.LocalFileSystem()
    with fs.open_input_file(path) as source:
        reader = FileReader(source)
        for i in (0, 17, 49):
            assert reader.ids(i)[0].tolist() == docs[i].tolist()
        assert reader.ids(99) == []
        assert 0 < reader.frames_read <= 6 < len(reader.checks)
    # Any zstandard reader sees the ids alone.
    with open(path, "rb") as source:
        plain = zstandard.ZstdDecompressor().stream_reader(source, read_across_frames=True).read()
    assert plain == b"".join(x.tobytes() for x in docs.values())


def test_damage_is_noticed(tmp_path):
    path = tmp_path / "one"
    with open(path, "wb") as out:
        writer = FileWriter(out)
        writer.add(1, np.random.default_rng(1).integers(0, 1 << 31, 999).astype("<u4").tobytes())
        writer.close()
    data = bytearray(path.read_bytes())
    data[60] ^= 255
    path.write_bytes(bytes(data))
    with pyarrow.fs.LocalFileSystem().open_input_file(str(path)) as source:
        with pytest.raises((ValueError, zstandard.ZstdError)):
            FileReader(source).ids(1)


def test_one_tokenizer_per_worker():
    assert token_ids(PATH) is token_ids(PATH)
