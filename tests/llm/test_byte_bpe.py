import base64
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from wordloom.llm import byte_bpe
from wordloom.llm.blocks import pack, spread, squeezed, unpack

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
OTHER = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
KINDS = "͸\U000107bb\U00010940\U0001e4d0\U00011de0\U0003134a½²٣ǅʰªⅣ一​\x1c\x85　'’_"


def library(path):
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(row):
    return list(memoryview(bytes(row["ids"])).cast("I"))


def hostile(count):
    rng = random.Random(5)
    letters = "ab Zé'st\n\t 09!.😀" + KINDS
    return ["".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(count)]


@pytest.mark.parametrize("path", [PATH, OTHER])
def test_ids_and_bytes_as_the_library(spark, frame, odd, path):
    texts = odd + [(100 + i, t) for i, t in enumerate(hostile(300))]
    texts += [(1, "<|endoftext|> don't  stop"), (1, "a" * 20_000), (2, " \r\n x ")]
    encoding = library(path)
    coded = byte_bpe.encode(frame(texts), path, PATTERN)
    rows = byte_bpe.decode(coded, byte_bpe.token_bytes(spark, path)).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    mine = sorted(((r["doc_id"], ids_of(r)) for r in rows), key=key)
    assert mine == sorted(((i, encoding.encode_ordinary(t or "")) for i, t in texts), key=key)
    for r in rows:
        assert bytes(r["decoded"]) == encoding.decode_bytes(ids_of(r))


def test_stand_ins_have_the_class_the_tokenizer_sees():
    cut = byte_bpe.splitter(PATTERN, byte_bpe._differences())
    encoding = library(PATH)
    for text in hostile(2000):
        assert "".join(cut(text)) == text
        assert [i for w in cut(text) for i in encoding.encode_ordinary(w)] == encoding.encode_ordinary(text)


def test_each_distinct_word_is_merged_once(frame, monkeypatch):
    docs = frame([(i, "same words here " * (i + 1) + "é") for i in range(50)], 7)
    uses = byte_bpe._uses(docs, PATTERN, 5).where("words is not null").collect()
    parts = {}
    for row in uses:
        for word in unpack(row["words"]):
            parts.setdefault(word.decode(), []).append((row["part"], row["block"]))
    assert set(parts) == {w for w in regex.findall(PATTERN, "same words here same words here é")}
    for found in parts.values():
        assert len({part for part, _ in found}) == 1  # all uses of a word meet
        assert len(found) == len(set(found))  # once per block


@pytest.mark.parametrize("block_bytes, parts", [(1, 1), (1, 50), (16 << 20, 3)])
def test_blocks_and_parts_change_nothing(frame, odd, monkeypatch, block_bytes, parts):
    monkeypatch.setattr(byte_bpe, "BLOCK_BYTES", block_bytes)
    texts = odd + [(100 + i, t) for i, t in enumerate(hostile(60))]
    rows = byte_bpe.encode(frame(texts), PATH, PATTERN, parts).collect()
    assert sorted((r["doc_id"] or -1, ids_of(r)) for r in rows) == sorted(
        (i or -1, library(PATH).encode_ordinary(t or "")) for i, t in texts
    )


@given(st.lists(st.binary(max_size=9)), st.lists(st.integers(0, 2**32 - 1)))
def test_packing_goes_both_ways(values, numbers):
    assert unpack(pack(values)) == values
    assert spread(squeezed(np.array(numbers, np.int64))).tolist() == numbers


def test_decoding_by_shuffle_equals_decoding_in_place(spark, frame, odd):
    docs = frame(odd + [(50, "the same " * 6000)])
    coded = byte_bpe.encode(docs, PATH, PATTERN)
    table = byte_bpe.token_bytes(spark, PATH)
    near = byte_bpe.decode(coded, table).collect()
    far = byte_bpe.decode(coded, table, small=False).collect()
    assert sorted(near, key=repr) == sorted(far, key=repr)


def test_unknown_ids_are_refused(spark):
    tokens = spark.createDataFrame([(1, bytearray(b"\xff\xff\xff\x00"))], "doc_id long, ids binary")
    table = byte_bpe.token_bytes(spark, PATH)
    for small in (True, False):
        with pytest.raises(Exception, match="not in the vocabulary"):
            byte_bpe.decode(tokens, table, small).collect()


def test_empty_table_and_clashing_columns(spark, frame):
    empty = frame([(1, "x")]).where("false")
    coded = byte_bpe.encode(empty, PATH, PATTERN)
    assert byte_bpe.decode(coded, byte_bpe.token_bytes(spark, PATH)).count() == 0
    docs = frame([(1, "some words")])
    for name in ("block", "places", "words", "part", "of", "ids", "decoded", "row", "id", "bytes"):
        docs = docs.withColumn(name, F.lit("clash"))
    assert ids_of(byte_bpe.encode(docs, PATH, PATTERN).first()) == library(PATH).encode_ordinary("some words")
