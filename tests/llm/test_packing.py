"""Packing: every piece placed once, every capacity kept, few sequences."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from wordloom.llm.packing import Capacity, pack, places, plan
from wordloom.llm.token_ids import VOCABULARY, token_ids

PATH = public_tokenizers.path(VOCABULARY)


def sequences(patterns):
    found = {}
    for p in patterns:
        for s in range(p.first, p.first + p.repeat):
            found[s] = [length for length, n in p.uses for _ in range(n)]
    return found


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("documents,attention", [(4096, 4096**2), (5, 64**2 + 100)])
def test_plan_keeps_every_capacity(rule, documents, attention):
    r = random.Random(3)
    capacity = Capacity(64, documents, attention, rule=rule)
    counts = {n: r.randint(1, 50) for n in r.sample(range(1, 65), 40)}
    held = sequences(plan(counts, capacity))
    for lengths in held.values():
        assert sum(lengths) <= 64 and len(lengths) <= documents
        assert sum(x * x for x in lengths) <= attention
    placed = defaultdict(int)
    for lengths in held.values():
        for x in lengths:
            placed[x] += 1
    assert placed == counts
    assert sorted(held) == list(range(len(held)))


def test_plan_is_near_the_bound():
    r = random.Random(4)
    counts = defaultdict(int)
    for _ in range(20000):
        counts[min(4096, int(r.lognormvariate(5.5, 1.2)) + 1)] += 1
    used = sum(p.repeat for p in plan(counts, Capacity()))
    least = -(-sum(k * n for k, n in counts.items()) // 4096)
    assert used <= least * 1.005 + 1


def test_ranks_cover_the_plan():
    counts = {5: 7, 3: 4, 1: 9}
    where = places(plan(counts, Capacity(8)))
    for length, n in counts.items():
        mine = where["length"] == length
        assert where["rank"][mine][0] == 0 and (np.diff(where["rank"][mine]) > 0).all()


def test_refused():
    with pytest.raises(ValueError):
        Capacity(64, 4, 64)
    with pytest.raises(ValueError):
        Capacity(rule="best")


def test_documents(frame, odd):
    encode = token_ids(PATH)
    rows = [(r[0] if r[0] is not None else -1, r[1]) for r in odd if r[0] != 6]
    rows += [(50 + i, f"w{i} " * (i * 37 % 700)) for i in range(60)]
    got = pack(frame(rows), PATH, 1, Capacity(256, 256, 256**2)).collect()
    texts = {}
    for doc_id, text in rows:
        texts.setdefault(doc_id, []).append(encode(text) + (1).to_bytes(4, "little"))
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
    for doc_id, own in texts.items():
        want = sorted(
            (k, 256 * k, len(part) // 4, zlib.crc32(part))
            for ids in own
            for k, part in enumerate(ids[i : i + 1024] for i in range(0, len(ids), 1024))
        )
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in pieces[doc_id]) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for spans in bins.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][0] + spans[-1][1] <= 256
        assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))


def test_empty(frame):
    assert pack(frame([]), PATH).collect() == []
