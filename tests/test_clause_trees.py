"""Nested clauses against a recursive evaluation of each document."""

import random

import pytest
from conftest import SF

from registry import queries as rq
from wordloom import corpus, search
from wordloom.operators import clauses as cl
from wordloom.operators.clauses import clause_batch, match_boolean, match_extended, ranking_batch

COLUMNS = "query_id long, clause int, parent int, kind string, op string, n int, text string"
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]


def holds(words, row, rows):
    """Whether a row of a tree holds for a list of words."""
    if row["op"] == "group":
        members = [holds(words, r, rows) for r in rows if r["parent"] == row["clause"]]
        return {"must": all(members), "any": any(members), "not": not any(members)}[row["kind"]]
    asked = set(row["text"].split())
    if row["op"] == "quorum":
        found = len(asked & set(words)) >= row["n"]
    elif row["op"] == "phrase":
        found = f" {row['text']} " in f" {' '.join(words)} "
    elif row["kind"] == "must":
        found = asked <= set(words)
    else:
        found = bool(asked & set(words))
    return found != (row["kind"] == "not")


def random_tree(rng, query, depth, ops):
    rows = []

    def add(parent, level):
        clause = len(rows) + 1
        kind = rng.choice(["must", "any", "not"])
        row = {"query_id": query, "clause": clause, "parent": parent, "kind": kind, "n": None}
        rows.append(row)
        if level and rng.random() < 0.7:
            row |= {"op": "group", "text": None}
            for _ in range(rng.randrange(1, 4)):
                add(clause, level - 1)
        else:
            op = rng.choice(ops)
            text = " ".join(rng.choices("abcdefg", k=rng.randrange(1, 4)))
            row |= {"op": op, "text": text, "n": 2 if op == "quorum" else None}

    for _ in range(rng.randrange(1, 3)):
        add(None, depth)
    return rows


@pytest.fixture(scope="module")
def letters(spark):
    rng = random.Random(2)
    texts = [(i, " ".join(rng.choices("abcdefgh", k=rng.randrange(9)))) for i in range(150)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    return dict(texts), corpus(df, "doc_id", ["text"])


def expected(texts, rows):
    queries = {r["query_id"] for r in rows}
    out = set()
    for query in queries:
        mine = [r for r in rows if r["query_id"] == query]
        tops = [r for r in mine if r["parent"] is None]
        for doc_id, text in texts.items():
            if all(holds(text.split(), r, mine) for r in tops):
                out.add((query, doc_id))
    return out


@pytest.mark.parametrize("bits", [62, 0])
@pytest.mark.parametrize("mode", ["boolean", "extended"])
def test_random_trees(spark, letters, pairs, monkeypatch, mode, bits):
    monkeypatch.setattr(cl, "MASK_BITS", bits)
    rng = random.Random(bits)
    ops = ["words", "quorum"] if mode == "boolean" else ["words", "quorum", "phrase"]
    rows = [r for q in range(40) for r in random_tree(rng, q, 3, ops)]
    listed = [[r[name] for name in NAMES] for r in rows]
    batch = clause_batch(spark.createDataFrame(listed, COLUMNS))
    assert batch.trees.bits == bool(bits)
    match = match_boolean if mode == "boolean" else match_extended
    texts, docs = letters
    assert pairs(match(docs, batch)) == expected(texts, rows)


def test_a_tree_of_more_than_62_nodes(spark, letters, pairs):
    texts, docs = letters
    rows = [(1, 1, None, "any", "group", None, None)]
    for i in range(40):
        rows += [(1, 2 + 2 * i, 1, "must", "group", None, None)]
        rows += [(1, 3 + 2 * i, 2 + 2 * i, "must", "words", None, "abcdefg"[i % 7] + " " + "gfedcba"[i % 5])]
    named = [dict(zip(NAMES, r)) for r in rows]
    batch = clause_batch(spark.createDataFrame(rows, COLUMNS))
    assert not batch.trees.bits
    assert pairs(match_boolean(docs, batch)) == expected(texts, named)


def tree(spark, *rows):
    return clause_batch(spark.createDataFrame([(1, *r) for r in rows], COLUMNS))


def test_words_under_a_negation_do_not_rank(spark, letters):
    batch = tree(
        spark,
        (1, None, "must", "words", None, "a"),
        (2, None, "not", "group", None, None),
        (3, 2, "any", "group", None, None),
        (4, 3, "must", "words", None, "b"),
        (5, None, "any", "group", None, None),
        (6, 5, "must", "words", None, "c"),
        (7, 5, "not", "words", None, "d"),
    )
    assert {r["term"] for r in ranking_batch(batch).terms.collect()} == {"a", "c"}
    found = search(letters[1], batch, "boolean", "bm25").matches
    assert found.count() > 0


def test_bad_trees_are_refused(spark):
    leaf = (2, 1, "must", "words", None, "a")
    with pytest.raises(ValueError, match="no group"):
        tree(spark, leaf)
    with pytest.raises(ValueError, match="below"):
        tree(spark, (3, None, "any", "group", None, None), (2, 3, "must", "words", None, "a"))
    with pytest.raises(ValueError, match="no members"):
        tree(spark, (1, None, "any", "group", None, None), (2, None, "must", "words", None, "a"))
    with pytest.raises(ValueError, match="no words"):
        tree(spark, (1, None, "any", "group", None, None), (2, 1, "must", "words", None, " "))


def test_flat_rows_with_a_parent_column_are_flat(spark, pairs):
    docs = rq.documents(spark, SF)
    flat = rq._clauses(spark, rq.BOOLEAN)
    nested = flat.selectExpr("*", "cast(null as int) as parent")
    assert pairs(match_boolean(docs, clause_batch(nested))) == pairs(match_boolean(docs, clause_batch(flat)))
