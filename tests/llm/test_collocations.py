import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from wordloom.llm import collocations

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, longest=3, least=10, share=50, top=2000):
    """The rule, counted phrase by phrase."""
    uses, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, longest + 1):
                uses[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in uses.items():
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            if any(
                100 * f[q] >= share * a
                for q in f
                if len(q) > len(p) and f[q] >= least
                and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ):
                continue
            score, _, l, r = min(
                (1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                for k in range(1, len(p))
            )
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def corpus(seed, count=160):
    rng = random.Random(seed)
    words = ["a", "B", "c", "É", "d'e", "\x00", "f", "GG", "😀"]
    ends = [" ", "  ", "\t", ". ", ",", "\n", "\x0b", "\r\n", " ? "]
    rows = []
    for i in range(count):
        text = "".join(
            rng.choice(words) + rng.choices(ends, [30, 2, 2] + [1] * 6)[0]
            for _ in range(rng.randrange(60))
        )
        text = rng.choice([text, text + "new york city new york"])
        rows.append((text, rng.choice(["en", "en", "en", "fr", None, "und"])))
    return rows + [(None, "en"), ("", None), (" \t\n", "xx"), ("x " * 400, "de")] + rows[:20]


@pytest.fixture()
def table(spark):
    return lambda rows: spark.createDataFrame(rows, "text string, lang string").repartition(5)


def mined(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("block_words", [1, 500, 3_000_000])
def test_as_counted_phrase_by_phrase(spark, table, frame, monkeypatch, block_words):
    monkeypatch.setattr(collocations, "BLOCK_WORDS", block_words)
    rows = corpus(block_words)
    assert mined(collocations.collocations(table(rows))) == brute(rows)


@pytest.mark.parametrize("longest, least, share, top", [(2, 3, 50, 5), (4, 4, 90, 2000), (3, 1, 100, 7)])
def test_other_bounds(spark, table, frame, longest, least, share, top):
    rows = corpus(longest, 60)
    mine = collocations.collocations(table(rows), longest, least, share, top)
    assert mined(mine) == brute(rows, longest, least, share, top)


def test_products_beyond_64_bits(spark):
    rows = [(4_000_000_000_000, [5_000_000_000_000], [6_000_000_000_000])]
    found = spark.createDataFrame(rows, "total long, heads array<long>, tails array<long>")
    cut = collocations._scored(found, 2).first()["cut"]
    assert cut["score"] == 1_000_000 * rows[0][0] ** 2 // (rows[0][1][0] * rows[0][2][0])


def test_a_block_sends_each_phrase_once(spark, table, frame):
    found = collocations._occurrences(table(corpus(9)))
    words = found.where(F.col("word").isNotNull())
    assert words.groupBy("block", "word").count().where("count > 1").count() == 0
    assert words.groupBy("block").agg(F.count_distinct("lang").alias("k")).where("k > 1").count() == 0


def test_empty_table_and_clashing_columns(table, frame):
    assert collocations.collocations(table(corpus(1)).where("false")).count() == 0
    rows = corpus(2, 40)
    docs = table(rows)
    for name in ("block", "word", "number", "uses", "id", "first", "second", "total", "n", "rank"):
        docs = docs.withColumn(name, F.lit("clash"))
    assert mined(collocations.collocations(docs)) == brute(rows)
