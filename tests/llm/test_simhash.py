"""SimHash near-duplicates against brute force, small cells and other layouts."""

import random

import numpy as np
import pytest
import xxhash

from wordloom.llm import simhash
from wordloom.llm.components import components


def slow_print(text, shingle=4, seed=42):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    counts = [0] * 64
    for part in parts:
        h = xxhash.xxh64_intdigest(part, seed)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(parts))


def slow_groups(rows, distance=4):
    prints = [slow_print(t) for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (prints[i] ^ prints[j]).bit_count() <= distance and label[j] < label[i]:
                    label[i] = label[j]
                    changed = True
    best = {}
    for k, (doc_id, _) in zip(label, rows):
        if doc_id is not None:
            best[k] = min(best.get(k, doc_id), doc_id)
    return sorted(
        ((d, p, best.get(k)) for (d, _), p, k in zip(rows, prints, label)), key=repr
    )


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def rows_of(df):
    return sorted(((r[0], r[1] % (1 << 64), r[2]) for r in df.collect()), key=repr)


def test_every_code_word_neighbourhood():
    values = np.random.default_rng(1).integers(0, 1 << 23, 500)
    rows, words = simhash._anchors(values, 3)
    assert (np.bincount(rows) == 1).all()  # the code is perfect
    assert (np.bitwise_count(words ^ values[rows]) <= 3).all()
    assert (simhash._syndrome(words) == 0).all()


@pytest.mark.parametrize("layout", [(21, 21, 22), (32, 32), (64,)])
def test_all_links_found(spark, monkeypatch, layout):
    distance = 4 if len(layout) > 1 else 1
    monkeypatch.setattr(simhash, "CELL", 7)
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(30)]
    prints = set(base)
    for b in base[:10]:
        for _ in range(15):
            for bit in r.sample(range(64), r.randint(1, distance)):
                b ^= 1 << bit
            prints.add(b)
    prints = sorted(prints)
    df = spark.createDataFrame([(signed(p),) for p in prints], "print long")
    edges = simhash.links(df, distance, layout)
    hung = {r.node: r.root for r in components(edges).collect()}
    label = {p: hung.get(signed(p), signed(p)) for p in prints}
    want = {p: p for p in prints}
    changed = True
    while changed:
        changed = False
        for p in prints:
            for q in prints:
                if (p ^ q).bit_count() <= distance and signed(want[q]) < signed(want[p]):
                    want[p], changed = want[q], True
    assert label == {p: signed(w) for p, w in want.items()}


def test_documents(frame, odd):
    r = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    rows = list(odd)
    for k in range(12):
        text = r.choices(words, k=200)
        rows.append((100 + k, " ".join(text)))
        for copy in range(r.randint(0, 4)):
            near = list(text)
            near[r.randrange(200)] = "changed"
            rows.append((200 + 10 * k + copy, " ".join(near)))
    assert rows_of(simhash.near_duplicates(frame(rows))) == slow_groups(rows)


def test_keep_one(frame):
    rows = [(3, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (9, "z y x w v"), (5, None), (4, "")]
    kept = simhash.keep_one(frame(rows))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [
        (1, "a b c d e"), (4, ""), (9, "z y x w v")
    ]
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_keep_one_of_each_component(frame):
    """Unrelated texts under one id, or under none, all stay."""
    r = random.Random(31)
    text = lambda: " ".join("".join(r.choices("abcdefgh", k=6)) for _ in range(30))
    rows = [(1, text()), (1, text()), (1, text()), (None, text()), (None, text())]
    kept = simhash.keep_one(frame([*rows, rows[0], rows[3], (2, rows[1][1])]))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(rows, key=repr)


def test_empty(frame):
    assert simhash.near_duplicates(frame([])).collect() == []


def test_components_of_a_path(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(1, 41)}, 101: 100}
