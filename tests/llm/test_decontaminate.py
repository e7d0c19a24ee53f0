"""Phrase and proximity matches of the positional index against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from wordloom.llm import decontaminate as dc

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORDS.findall((text or "").translate(LOW))


def slow(rows, items, window=10):
    wins = []
    for item_id, text in items:
        own = words(text)
        for k in range(max(1, len(own) - window + 1)) if own else ():
            wins.append((str(item_id) if item_id is not None else "", own[k : k + window]))
    found = []
    for doc_id, text in rows:
        own, hit, names = words(text), set(), set()
        for name, part in wins:
            for k in range(len(own) - len(part) + 1):
                if own[k : k + len(part)] == part:
                    hit.update(range(k, k + len(part)))
                    names.add(name)
        found.append((doc_id, len(own), len(hit), len(names), sorted(names), bool(hit)))
    return sorted(found, key=repr)


def rows_of(df):
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items", "contaminated"]
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def cases(odd):
    r = random.Random(6)
    vocabulary = [f"t{i}" for i in range(60)]
    items = [(i, " ".join(r.choices(vocabulary, k=r.randint(8, 30)))) for i in range(25)]
    items += [(90, "Short one!"), (91, ""), (92, None), (None, "été œuvre un"), (93, "a-b.c d e f")]
    rows = list(odd)
    for i in range(60):
        parts = [" ".join(r.choices(vocabulary, k=r.randint(0, 40)))]
        for _ in range(r.randint(0, 2)):
            own = r.choice(items)[1] or ""
            own = own.split()
            a = r.randint(0, max(0, len(own) - 11))
            parts += [", ".join(own[a : a + 14]).upper(), "short, ONE"][: r.randint(1, 2)]
        rows.append((100 + i, " ".join(parts)))
    return rows, items


@pytest.mark.parametrize("limit", [1 << 24, 200])
def test_exact(spark, frame, cases, monkeypatch, limit):
    """In one block of items, and in many with every term indexed."""
    rows, items = cases
    monkeypatch.setattr(dc, "SHARD_BYTES", 3000)
    docs = frame(rows)
    tests = spark.createDataFrame(items, "item_id long, text string")
    index = dc.index_documents(docs, dc.benchmark_terms(tests, limit))
    hits = dc.search_index(index, tests, block_bytes=limit)
    hits = hits.select(
        "doc_id",
        "n_words",
        dc.covered().alias("n_hit"),
        F.size("items").alias("n_items"),
        "items",
        (F.size("starts") > 0).alias("contaminated"),
    )
    assert rows_of(hits) == slow(rows, items)


def test_operator(spark, frame, cases):
    rows, items = cases
    tests = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(dc.decontaminate(frame(rows), tests)) == slow(rows, items)


def test_never_across_documents(spark, frame):
    tests = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    got = dc.decontaminate(frame([(1, "x a b"), (2, "c y"), (3, "z a b c")], 1), tests)
    assert {r.doc_id for r in got.collect() if r.contaminated} == {3}


def test_proximity(spark, frame):
    tests = spark.createDataFrame([(1, "red fox jumps")], "item_id long, text string")
    rows = [(1, "red fox jumps"), (2, "a red big fox jumps"), (3, "red x x x x fox jumps"), (4, "red fox")]
    rows += [(5, "jumps")]
    index = dc.index_documents(frame(rows, 1))
    near = dc.search_index(index, tests, slack=1)
    assert {r.doc_id for r in near.collect() if r["items"]} == {1, 2}
    exact = dc.search_index(index, tests)
    assert {r.doc_id: r.starts for r in exact.collect() if r["items"]} == {1: [0]}


def test_empty(spark, frame):
    none = spark.createDataFrame([], "item_id long, text string")
    got = dc.decontaminate(frame([(1, "a b"), (2, None)]), none).collect()
    assert [(r.doc_id, r.n_hit, r.contaminated) for r in sorted(got)] == [(1, 0, False), (2, 0, False)]
    assert dc.decontaminate(frame([]), none).collect() == []
