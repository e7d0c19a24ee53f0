import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wordloom.llm import ranked_search
from wordloom.llm.common import stored

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
TERM = "[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"


def terms(text):
    return re.findall(TERM, (text or "").translate(LOWER))


def brute(docs, items, k=50):
    """Every document scored for every item by the rule."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    some = [c for _, c in counted if c]
    n_docs, n_words = len(some), sum(c.total() for c in some)
    df = Counter(t for c in some for t in c)
    out = []
    for item_id, text in items:
        asked = {
            t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            for t in set(terms(text)) if df[t]
        }
        found = []
        for doc_id, c in counted:
            if not c:
                continue
            m = 100 - 50 + (50 * c.total() * n_docs) // n_words
            score = sum(
                w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t, w in asked.items() if c[t]
            )
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(found)[:k], 1):
            out.append((item_id, rank, doc_id, -score))
    return sorted(out, key=repr)


def corpus(seed, count=300):
    rng = random.Random(seed)
    words = ["the", "a", "of", "Fox", "été", "x1", "😀", "dog", "É", "zz"] + [f"w{i}" for i in range(60)]
    weights = [40, 30, 20, 8, 5, 3, 2, 2, 2, 1] + [1] * 60
    docs = [
        (i, " ".join(rng.choices(words, weights, k=rng.choice([1, 2, 3, 5, 20, 60]))) + rng.choice([".", " _ ", ""]))
        for i in range(count)
    ]
    docs += [(i + 5000, "the same short text") for i in range(150)]  # one stratum holds a third
    docs += docs[:20] + [(None, "fox without id"), (None, None), (1, None), (2, ""), (3, " \n-"), (9, "Fox " * 9000)]
    items = [(f"q{i}", " ".join(rng.choices(words, weights, k=rng.randrange(1, 25)))) for i in range(12)]
    items += [("none", None), ("empty", ""), ("unknown", "neverseen"), ("q0", items[0][1]), (None, "fox"), ("same", "Same text")]
    return docs, items


@pytest.fixture()
def item_table(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id string, text string")


def found(df):
    rows = [(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()]
    return sorted(rows, key=repr)


@pytest.mark.parametrize("shard, cells, k", [(8 << 20, 4 << 20, 50), (3000, 400, 5), (1, 1, 50)])
def test_as_every_document_scored(frame, item_table, monkeypatch, shard, cells, k):
    monkeypatch.setattr(ranked_search, "SHARD_BYTES", shard)
    monkeypatch.setattr(ranked_search, "CELLS", cells)
    docs, items = corpus(k)
    if shard == 1:
        docs = docs[:60] + docs[-10:]
    index = ranked_search.index_documents(frame(docs, 5))
    assert found(ranked_search.search(index, item_table(items), k)) == brute(docs, items, k)


def test_blocks_of_items_and_a_saved_index(spark, frame, item_table, monkeypatch, tmp_path):
    monkeypatch.setattr(ranked_search, "ITEM_BYTES", 2000)
    docs, items = corpus(3, 80)
    ranked_search.index_documents(frame(docs), str(tmp_path / "index"))
    index = ranked_search.load_index(spark, str(tmp_path / "index"))
    assert ranked_search._asked(item_table(items))[2] > 2
    assert found(ranked_search.search(index, item_table(items), 7)) == brute(docs, items, 7)


def test_bounds_hold_and_spare_strata(frame, item_table):
    docs = [(i, "rare " * (i % 40) + "filler " * (i % 90)) for i in range(900)]
    items = [("q", "rare")]
    index = ranked_search.index_documents(frame(docs, 4))
    numbered, asked, _ = ranked_search._asked(item_table(items))
    limits = stored(ranked_search.bounds(ranked_search._found(index, asked.drop("block"))), "b")
    scores = {d: s for _, _, d, s in brute(docs, items, 10_000)}
    best = {(r["shard"], r["m"]): r["bound"] for r in limits.collect()}
    lists = index.entries.where("term is null").select("shard", "ids", "lengths").collect()
    for row in lists:
        for doc_id, m in zip(row["ids"], row["lengths"]):
            assert scores.get(doc_id, 0) <= best.get((row["shard"], m), 0)
    tenth = sorted(scores.values())[-10]
    assert 1 <= sum(b >= tenth for b in best.values()) < len(best) / 2


def test_a_large_stratum_is_sliced(frame, monkeypatch):
    monkeypatch.setattr(ranked_search, "SHARD_BYTES", 2000)
    index = ranked_search.index_documents(frame([(i, "all alike here") for i in range(400)], 4))
    sizes = [len(r["ids"]) for r in index.entries.where("term is null").select("ids").collect()]
    assert sum(sizes) == 400 and max(sizes) < 100


def test_entries_by_tf_within_strata(frame):
    docs, _ = corpus(8)
    for row in ranked_search.index_documents(frame(docs)).entries.where("term is not null").collect():
        assert len(row["strata"]) == len(set(row["strata"])) == len(row["peaks"])
        assert row["strata"] == sorted(row["strata"]) and max(row["tfs"]) == max(row["peaks"])


def test_empty_tables_and_clashing_columns(frame, item_table):
    docs, items = corpus(4, 30)
    none = ranked_search.index_documents(frame(docs).where("false"))
    assert ranked_search.search(none, item_table(items)).count() == 0
    wide, asked = frame(docs), item_table(items)
    for name in ("row", "term", "terms", "shard", "m", "n", "item", "rank", "score", "unit", "w"):
        wide, asked = wide.withColumn(name, F.lit("clash")), asked.withColumn(name, F.lit("clash"))
    index = ranked_search.index_documents(wide)
    assert ranked_search.search(index, asked.where("false")).count() == 0
    assert found(ranked_search.search(index, asked)) == brute(docs, items)
