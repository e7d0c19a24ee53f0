"""The stored index gives what the texts give."""

import pytest
from conftest import SF
from pyspark.sql import functions as F
from test_plans import plan

from registry import queries as rq
from wordloom import corpora, corpus, search
from wordloom.operators import filters as fl
from wordloom.operators import ordering as od
from wordloom.operators import ranking as rk
from wordloom.operators.best_blocks import best_bm25, block_bounds
from wordloom.operators.clauses import clause_batch
from wordloom.operators.factors import _document_counts, with_idf
from wordloom.plans.search import Group
from wordloom.sources import (
    corpus_status,
    doc_terms,
    load_index,
    query_batch,
    save_index,
    tokens,
)
from wordloom.sources import term_index as ti


def rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    """Several fields, a union of two indexes with the same ids, odd texts."""
    full = rq.documents(spark, SF).df.select("doc_id", "text", "lang", "n_chars")
    first = full.where("doc_id % 2 = 0").select(
        "doc_id", F.substring("text", 1, 40).alias("head"), "text", "lang", "n_chars"
    )
    odd = spark.createDataFrame(
        [
            (900_001, None, None, "xx", 1),
            (900_002, "", " .,", "xx", None),
            (900_003, "the the", "the", None, 3),
        ],
        "doc_id long, head string, text string, lang string, n_chars long",
    )
    second = full.where("doc_id % 3 = 0").withColumn("head", F.lit("of the and"))
    a = corpus(first.unionByName(odd), "doc_id", ["head", "text"], ["lang", "n_chars"])
    b = corpus(second, "doc_id", ["head", "text"], ["lang", "n_chars"])
    return corpora({"a": a, "b": b})


@pytest.fixture(scope="module")
def index(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "words")
    save_index(docs, path, 16)
    return load_index(spark, path, docs, 16)


@pytest.fixture(scope="module")
def batch(spark):
    texts = [(1, "the of the and"), (2, "of the"), (3, "de la"), (4, "unknownword the")]
    texts += [(5, ""), (6, None)]
    return query_batch(spark.createDataFrame(texts, "query_id long, text string"))


def test_the_word_tables(docs, index):
    assert rows(tokens(index)) == rows(tokens(docs))
    assert rows(doc_terms(index).where("term is not null")) == rows(
        doc_terms(docs).where("term is not null")
    )
    assert rows(corpus_status(index)) == rows(corpus_status(docs))


RANKERS = ["proximity_bm25", "bm25", "none", "wordcount", "proximity", "matchany"]
RANKERS += ["fieldmask", "boosted", "expr"]


@pytest.mark.parametrize("ranker", RANKERS)
@pytest.mark.parametrize("mode", ["all", "any", "phrase"])
def test_every_mode_and_ranker(docs, index, batch, mode, ranker):
    expr = "bm25 + sum_lcs * 1000 + hit_count" if ranker == "expr" else None
    on_texts, on_index = (search(c, batch, mode, ranker, expr) for c in (docs, index))
    assert rows(on_index.matches) == rows(on_texts.matches)
    if ranker == "bm25":
        assert rows(on_index.summary) == rows(on_texts.summary)
        assert rows(on_index.word_stats) == rows(on_texts.word_stats)


@pytest.mark.parametrize("ranker", ["none", "bm25"])
@pytest.mark.parametrize("mode", ["boolean", "extended"])
def test_clauses(spark, docs, index, mode, ranker):
    kinds = rq.BOOLEAN if mode == "boolean" else rq.EXTENDED
    clauses = clause_batch(rq._clauses(spark, kinds))
    on_texts, on_index = (search(c, clauses, mode, ranker) for c in (docs, index))
    assert rows(on_index.matches) == rows(on_texts.matches)


def test_filters_groups_sorts_and_scans(spark, docs, index, batch):
    settings = [
        dict(filters=[fl.between("n_chars", 200, 2000)]),
        dict(id_range=(10, 150), sort=od.attribute("n_chars"), carry=["n_chars"]),
        dict(group=Group("lang", "attr")),
        dict(cutoff_at=7, index_weights={"b": 3}),
    ]
    for setting in settings:
        on_texts, on_index = (search(c, batch, "any", "bm25", **setting) for c in (docs, index))
        assert rows(on_index.matches) == rows(on_texts.matches)
    scans = [search(c, None, "fullscan").matches for c in (docs, index)]
    assert rows(scans[0]) == rows(scans[1])


def test_a_search_opens_its_buckets_only(spark, index):
    few = query_batch(spark.createDataFrame([(1, "of the")], "query_id long, text string"))
    text = plan(search(index, few, "any", "bm25").matches)
    filters = [x for x in text.splitlines() if "PartitionFilters" in x]
    assert len(filters) >= 2 and all("bucket" in x for x in filters if "slots" in x)
    opened = index.opened(few.terms).postings.select("bucket").distinct().collect()
    assert 1 <= len(opened) <= 3


def test_places_are_read_only_where_they_are_needed(index, batch):
    schema = [x for x in plan(doc_terms(index)).splitlines() if "ReadSchema" in x]
    assert schema and "slots" not in "".join(schema)
    schema = plan(rk.rank_wordcount(index, batch))
    assert "previous" not in "".join(x for x in schema.splitlines() if "ReadSchema" in x)


def test_an_empty_corpus(spark, docs, batch, tmp_path):
    save_index(docs.where(F.lit(False)), str(tmp_path / "none"), 4)
    none = load_index(spark, str(tmp_path / "none"), docs, 4)
    assert search(none, batch, "any", "bm25").matches.count() == 0
    assert best_bm25(none, batch).matches.count() == 0


@pytest.mark.parametrize("k", [1, 7, 50, 5000])
def test_best_blocks_equal_full_scoring(docs, index, batch, monkeypatch, k):
    found = best_bm25(index, batch, k)
    assert rows(found.matches) == rows(od.page(rk.rank_bm25(docs, batch), 0, k, keys=docs.keys))


def test_bounds_hold_and_blocks_are_spared(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(ti, "BLOCK_DOCUMENTS", 8)
    data = [(i, "rare " * (i % 9) + "word " * (i % 50)) for i in range(1200)]
    docs = corpus(spark.createDataFrame(data, "doc_id long, text string"), "doc_id", ["text"])
    save_index(docs, str(tmp_path / "blocks"))
    index = load_index(spark, str(tmp_path / "blocks"), docs)
    texts = [(1, "rare"), (2, "word rare"), (3, "none")]
    batch = query_batch(spark.createDataFrame(texts, "query_id long, text string"))
    found = best_bm25(index, batch, 5)
    assert rows(found.matches) == rows(od.page(rk.rank_bm25(docs, batch), 0, 5))
    effort = {r["query_id"]: r for r in found.effort.collect()}
    assert set(effort) == {1, 2} and effort[1]["scored"] < effort[1]["blocks"] / 2
    terms = with_idf(batch, _document_counts(index, batch))
    limits = block_bounds(index, terms, True).collect()
    limits = {(r["query_id"], r["block"]): r["bound"] for r in limits}
    scores = rk.rank_bm25(docs, batch).join(index.df.select("doc_id", "block"), "doc_id").collect()
    assert scores and all(r["weight"] <= limits[r["query_id"], r["block"]] for r in scores)
