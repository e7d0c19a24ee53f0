"""Removal of repeated strings against brute force, and the index by itself."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from conftest import SF

from wordloom.llm import repeats


def slow(rows, length):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(x[i : i + length] for _, x in texts for i in range(len(x) - length + 1))
    out = []
    for doc_id, x in texts:
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - length + 1):
            if seen[x[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(x, gone) if not g)
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((doc_id, len(x), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def rows(odd):
    r = random.Random(21)
    letters = "abcdé \n"
    text = lambda n: "".join(r.choices(letters, k=n))
    passages = [text(r.randint(30, 200)) for _ in range(8)]
    rows = [x for x in odd if x[0] != 8] + [(8, "ab" * 300), (9, "x" * 500), (9, "x" * 45)]
    for i in range(80):
        parts = [text(r.randint(0, 120))]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randint(0, 20)
            parts += [p[a : len(p) - r.randint(0, 20)], text(r.randint(0, 50))]
        rows.append((100 + i, "".join(parts)))
    return rows + [(300 + i, rows[-1][1]) for i in range(4)]


@pytest.mark.parametrize("crowd,block", [(1000, 1 << 20), (1, 1 << 20), (3, 2000)])
def test_documents(frame, rows, monkeypatch, crowd, block):
    """All by indexes, all by counting, and a mixture in small blocks."""
    monkeypatch.setattr(repeats, "BLOCK", block)
    monkeypatch.setattr(repeats, "CHUNK", 700)
    got = repeats.remove_repeats(frame(rows), length=40, gram=20, crowd=crowd)
    assert rows_of(got) == slow(rows, 40)


def test_empty(frame):
    assert repeats.remove_repeats(frame([])).collect() == []
    got = repeats.remove_repeats(frame([(1, None), (2, "short")]))
    assert [(r.n_bytes, r.n_removed) for r in sorted(got.collect())] == [(0, 0), (5, 0)]


@pytest.mark.parametrize("seed", range(6))
def test_matching_statistics(seed):
    r = random.Random(seed)
    spans = []
    for _ in range(12):
        base = bytes(r.choices(b"ab\x00c"[: 2 + seed % 3], k=r.randint(1, 60)))
        spans += [base, base[r.randint(0, len(base)) :] + b"a", base][: r.randint(1, 3)]
    index = repeats.RunIndex(spans)
    match, other = index.statistics()
    suffixes = [(s[i:], k) for k, s in enumerate(spans) for i in range(len(s))]
    order = sorted(range(len(suffixes)), key=lambda i: (suffixes[i][0], i))
    for above, at in zip([None, *order], order):
        if above is None:
            assert match[at] == 0
            continue
        a, b = suffixes[above][0], suffixes[at][0]
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert match[at] == n
        assert n == 0 or other[at] == above
    assert index.runs <= len(suffixes)


def test_runs_are_fewer_in_repetitive_texts():
    r = random.Random(3)
    base = bytes(r.choices(b"abcdefgh", k=500))
    index = repeats.RunIndex([base] * 40)
    assert index.runs < 40 * 500 / 10


def test_stretches_share_their_gram():
    data = np.frombuffer(bytes(random.Random(5).choices(b"abc", k=3000)), np.uint8)
    gram, first, size = repeats.stretches(data, np.array([0, 1000, 3000]), 40, 20)
    covered = np.concatenate([np.arange(a, a + n) for a, n in zip(first, size)])
    want = np.r_[np.arange(961), np.arange(1000, 2961)]
    assert covered.tolist() == want.tolist()
    assert size.max() <= 21


def test_passages_of_over_fifty_words(spark, frame):
    """Passages that two documents share go if they have 400 bytes, else they stay."""
    r = random.Random(21)
    found = spark.read.parquet(f"{SF}/documents.parquet").where("text is not null").limit(60)
    words = sorted({w for x in found.collect() for w in x["text"].split()})
    some = lambda n: " ".join(r.choices(words, k=n))
    rows, shared = [], {}
    for n in range(50, 91):
        passage = some(n)
        texts = [f"{some(12)} <{n}a> {passage} <{n}c>", f"{some(9)} <{n}b> {passage} <{n}d>"]
        rows += [(2 * n, texts[0]), (2 * n + 1, texts[1])]
        shared[n] = len(f"> {passage} <{n}".encode())
    cut = repeats.remove_repeats(frame(rows), length=400).collect()
    got = {x["doc_id"]: x["n_removed"] for x in cut}
    long = {n for n, size in shared.items() if size >= 400}
    assert long and len(long) < len(shared)
    for n, size in shared.items():
        assert got[2 * n] == got[2 * n + 1] == (size if n in long else 0)
