import pytest
from conftest import DOCS
from brute_force import bm25, longest_run, words

from wordloom import sizing
from wordloom.operators import ranking as rk
from wordloom.operators.clauses import clause_batch, match_boolean, match_extended
from wordloom.operators.matching import match_all, match_any, match_phrase

TEXTS = ["red fox", "the red the red fox", "fox", "été 2024", "no such words", "the fox the"]
FIELDS = {row[0]: [words(row[1]), words(row[2])] for row in DOCS}


def expected(test):
    return {
        (i + 1, doc)
        for i, text in enumerate(TEXTS)
        for doc, fields in FIELDS.items()
        if test(words(text), fields)
    }


def test_modes_against_brute_force(docs, batch, pairs):
    queries = batch(*TEXTS)
    found_all, found_any = pairs(match_all(docs, queries)), pairs(match_any(docs, queries))
    found_phrase = pairs(match_phrase(docs, queries))
    assert found_all == expected(lambda q, f: set(q) <= set(f[0] + f[1]))
    assert found_any == expected(lambda q, f: set(q) & set(f[0] + f[1]))
    assert found_phrase == expected(lambda q, f: any(longest_run(q, t) == len(q) for t in f))
    assert found_phrase <= found_all <= found_any


@pytest.mark.parametrize("weights", [None, {"title": 3}, [2, 5]])
def test_rankers_against_brute_force(docs, batch, weights):
    queries = batch(*TEXTS)
    factor = {None: [1, 1]}.get(weights) if weights is None else None
    factor = factor or ([3, 1] if isinstance(weights, dict) else weights)

    def table(df):
        return {(r["query_id"], r["doc_id"]): r["weight"] for r in df.collect()}

    def wanted(weight):
        return {
            (i, d): weight(words(TEXTS[i - 1]), FIELDS[d])
            for i, d in expected(lambda q, f: set(q) & set(f[0] + f[1]))
        }

    def total(per_field):
        return lambda q, f: sum(w * per_field(q, t) for w, t in zip(factor, f))

    def hits(q, t):
        return sum(x in q for x in t)

    def boost(q, t):
        run = 4 * longest_run(q, t)
        return run + 2 * (bool(t) and t[0] == q[0]) + (t == q)

    everything = [f[0] + f[1] for f in FIELDS.values()]

    def score(q, f):
        return bm25(q, f[0] + f[1], everything)

    assert table(rk.rank_wordcount(docs, queries, weights)) == wanted(total(hits))
    assert table(rk.rank_proximity(docs, queries, weights)) == wanted(total(longest_run))
    assert table(rk.rank_bm25(docs, queries)) == wanted(score)
    assert table(rk.rank_matchany(docs, queries, weights)) == wanted(
        total(lambda q, t: longest_run(q, t) * len(q) + len(set(q) & set(t)))
    )
    assert table(rk.rank_proximity_bm25(docs, queries, weights)) == wanted(
        lambda q, f: (total(longest_run)(q, f) << 32) + score(q, f)
    )
    assert table(rk.rank_boosted(docs, queries, weights)) == wanted(
        lambda q, f: (total(boost)(q, f) << 32) + score(q, f)
    )
    assert table(rk.rank_fieldmask(docs, queries)) == wanted(
        lambda q, f: bool(set(q) & set(f[0])) + 2 * bool(set(q) & set(f[1]))
    )


def test_queries_longer_than_a_bit_mask(spark, docs, batch, pairs):
    """Beyond 62 words the positions are kept as a list; results must agree."""
    filler = " ".join(f"w{i}" for i in range(70))
    long = batch(f"the red fox {filler}", f"{filler} red fox", f"red {filler} fox")
    assert not long.fits_mask
    rows = rk.rank_proximity(docs, long).collect()
    texts = [f"the red fox {filler}", f"{filler} red fox", f"red {filler} fox"]
    for row in rows:
        query = words(texts[row["query_id"] - 1])
        fields = FIELDS[row["doc_id"]]
        assert row["weight"] == sum(longest_run(query, f) for f in fields)
    counts = {(r["query_id"], r["doc_id"]): r["weight"] for r in rk.rank_wordcount(docs, long).collect()}
    assert len(counts) == len(rows)
    for (query_id, doc), weight in counts.items():
        query = set(words(texts[query_id - 1]))
        assert weight == sum(word in query for field in FIELDS[doc] for word in field)


def test_large_query_tables_take_the_salted_join(docs, batch, pairs, monkeypatch):
    queries = batch(*TEXTS)
    small = [
        sorted(map(tuple, f(docs, queries).collect()))
        for f in (match_all, match_phrase, rk.rank_bm25, rk.rank_proximity_bm25, rk.rank_wordcount)
    ]
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", -1)
    queries = batch(*TEXTS)
    assert not queries.small
    large = [
        sorted(map(tuple, f(docs, queries).collect()))
        for f in (match_all, match_phrase, rk.rank_bm25, rk.rank_proximity_bm25, rk.rank_wordcount)
    ]
    assert small == large


def test_partitions_do_not_change_results(docs, batch):
    from dataclasses import replace

    queries = batch(*TEXTS)
    one = sorted(map(tuple, rk.rank_proximity_bm25(docs, queries).collect()))
    spread = replace(docs, df=docs.df.repartition(7, "title"))
    assert one == sorted(map(tuple, rk.rank_proximity_bm25(spread, queries).collect()))


def clauses(spark, rows):
    schema = "query_id long, clause int, kind string, op string, n int, field string, text string"
    return clause_batch(spark.createDataFrame(rows, schema))


def test_boolean_clauses(spark, docs, pairs):
    rows = [
        (1, 1, "must", "words", None, None, "red"),
        (1, 2, "not", "words", None, None, "dog été"),
        (2, 1, "any", "words", None, None, "dog 2024"),
        (3, 1, "not", "words", None, None, "red"),
        (4, 1, "must", "quorum", 2, None, "red dog 2024"),
    ]
    batch = clauses(spark, rows)
    want = {(1, 3), (2, 4), (2, 5), (2, 6), (3, 1), (3, 2), (4, 4), (4, 5), (4, 6)}
    assert pairs(match_boolean(docs, batch)) == want
    assert pairs(match_extended(docs, batch)) == want


def test_extended_clauses(spark, docs, pairs):
    rows = [
        (1, 1, "must", "phrase", None, "body", "red fox"),
        (2, 1, "must", "start", None, None, "the fox"),
        (3, 1, "must", "end", None, "body", "fox"),
        (4, 1, "must", "near", 3, "body", "dog red and"),
        (5, 1, "must", "near", 2, "body", "dog fox"),
        (6, 1, "must", "words", None, "title", "fox"),
        (6, 2, "not", "phrase", None, None, "the red fox"),
        (7, 1, "must", "phrase", None, None, "fox the fox"),
        (8, 1, "must", "start", None, "title", "fox"),
        (9, 1, "not", "phrase", None, None, "red fox"),
    ]
    want = {(1, 3), (1, 4), (2, 4), (3, 3), (3, 4), (4, 4), (6, 3), (7, 4)}
    want |= {(9, 1), (9, 2), (9, 5), (9, 6)}
    assert pairs(match_extended(docs, clauses(spark, rows))) == want


def test_bad_clauses_are_refused(spark, docs):
    with pytest.raises(ValueError):
        clauses(spark, [(1, 1, "perhaps", "words", None, None, "red")])
    with pytest.raises(ValueError):
        clauses(spark, [(1, 1, "must", "near", None, None, "red fox")])
    with pytest.raises(ValueError):
        match_boolean(docs, clauses(spark, [(1, 1, "must", "phrase", None, None, "red fox")]))


def test_unknown_field_weights_are_refused(docs, batch):
    with pytest.raises(ValueError):
        rk.rank_wordcount(docs, batch("red"), {"nothing": 2})
    with pytest.raises(ValueError):
        rk.rank_wordcount(docs, batch("red"), [1, 2, 3])
    with pytest.raises(ValueError):
        rk.ranked(docs, batch("red"), 9)
