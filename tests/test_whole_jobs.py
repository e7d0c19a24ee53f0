"""Jobs that must stay whole, and tasks that must not grow with the tables."""

import re

import pytest
from conftest import SF
from pyspark.sql import functions as F
from test_plans import plan

from registry import queries as rq
from wordloom import sizing
from wordloom.operators import best_blocks
from wordloom.operators import ranking as rk
from wordloom.operators.factors import _document_counts, with_idf
from wordloom.operators.matching import match_any
from wordloom.sources import load_index, save_index, term_index
from wordloom.sources.tokens import field_counts, positions


def test_every_match_of_a_benchmark_text_has_its_score(spark):
    docs, items = rq.documents(spark, SF), rq.benchmark_queries(spark, SF)
    scored = rq.bm25_benchmark(spark, SF)
    assert scored.columns == ["query_id", "doc_id", "weight"]
    most = scored.groupBy("query_id").count().agg(F.max("count")).first()[0]
    assert most > 100
    mine = {tuple(r) for r in scored.select("query_id", "doc_id").collect()}
    assert mine == {tuple(r) for r in match_any(docs, items).collect()}


def dealt_by(df):
    """The numbers of tasks that rows are dealt to by key."""
    return [int(n) for n in re.findall(r"hashpartitioning\([^()]*, (\d+)\), REPARTITION", plan(df))]


JOBS = {
    "j5_settings_summary": rq.settings_summary,
    "j1_index_filtered": rq.index_filtered,
    "j1_settings_per_query": rq.settings_per_query,
    "d2_bm25_benchmark": rq.bm25_benchmark,
    "j1_batch_search": rq.batch_search,
    "c3_phrase_benchmark": rq.phrase_benchmark,
    "j5_search_status": rq.search_status,
}


@pytest.mark.parametrize("name", JOBS)
def test_more_documents_make_more_tasks_and_the_same_rows(spark, monkeypatch, name):
    few = JOBS[name](spark, SF)
    assert set(dealt_by(few)) == {4}
    monkeypatch.setattr(sizing, "DEALT_ROWS", 3000)
    many = JOBS[name](spark, SF)
    # 200 documents, each with 40 queries or more.
    assert min(dealt_by(many)) >= 5
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect()))


def test_words_are_counted_per_field(docs):
    mine = field_counts(docs, marker=True).where("term is not null")
    words = positions(docs, marker=True).where("term is not null")
    keys = [*docs.keys, "doc_len", "field_no", "term"]
    theirs = words.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    rows = {tuple(r) for r in mine.select(*keys, "n").collect()}
    assert rows == {tuple(r) for r in theirs.collect()} and len(rows) == mine.count()


def test_many_queries_of_runs_are_dealt_too(spark, docs, batch, monkeypatch):
    texts = [f"red fox {w}" for w in "the and a red fox dog no body title empty of".split()] * 2
    many = batch(*texts)
    before = rk.rank_proximity(docs, many).collect()
    monkeypatch.setattr(sizing, "DEALT_ROWS", 20)
    after = rk.rank_proximity(docs, many)
    assert min(dealt_by(after)) > 4
    assert sorted(map(tuple, before)) == sorted(map(tuple, after.collect()))


def test_an_index_reads_its_postings_once_for_its_counts(spark, docs, tmp_path, monkeypatch):
    """Blocks' rows carry the counts, postings hold arrays beside each other."""
    path = str(tmp_path / "index")
    save_index(docs, path, 4)
    index = load_index(spark, path, docs, 4)
    assert {"docs", "hits"} <= set(spark.read.parquet(f"{path}/peaks").columns)
    assert index.postings.schema["slots"].dataType.simpleString() == "array<int>"
    known = index.statistics.where("term <> ''").select("term", "docs", "hits").collect()
    words = positions(docs).where("term is not null").groupBy("term")
    counted = words.agg(F.count_distinct("doc_id").alias("docs"), F.count(F.lit(1)).alias("hits"))
    assert sorted(map(tuple, known)) == sorted(map(tuple, counted.collect()))
    kept = ["doc_id", "field_no", "field_len", "pos", "term", "previous"]
    mine, theirs = (positions(c, previous=True).where("term is not null").select(kept) for c in (index, docs))
    order = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert order(mine) == order(theirs)


def test_an_index_keeps_each_posting_once_and_no_words(spark, docs, tmp_path):
    """Its folders, one row per word and block, and the session's settings as they were."""
    before = spark.conf.get("spark.sql.execution.useObjectHashAggregateExec")
    path = tmp_path / "index"
    save_index(docs, str(path), 4)
    assert sorted(p.name for p in path.iterdir()) == ["documents", "peaks", "statistics"]
    assert spark.conf.get("spark.sql.execution.useObjectHashAggregateExec") == before
    blocks = spark.read.parquet(f"{path}/peaks")
    assert blocks.select("term", "block").distinct().count() == blocks.count()
    words = positions(docs).where("term is not null")
    assert blocks.agg(F.sum(F.size("slots"))).first()[0] == words.select("doc_id", "term").distinct().count()
    assert blocks.agg(F.sum(F.size(F.flatten("slots")))).first()[0] == words.count()


def test_more_words_make_more_tasks_of_the_build(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(term_index, "LEAST_WORDS", 1)
    assert [term_index._tasks(spark, n) for n in (0, 3, 100)] == [1, 3, 4]
    assert term_index._tasks(spark, 9 * term_index.TASK_WORDS + 1) == 10
    for name, least in (("one", 1000), ("more", 1)):
        monkeypatch.setattr(term_index, "LEAST_WORDS", least)
        save_index(docs, str(tmp_path / name), 4)
    one, more = (load_index(spark, str(tmp_path / n), docs, 4).postings for n in ("one", "more"))
    assert sorted(map(repr, one.collect())) == sorted(map(repr, more.collect()))


def test_the_best_of_an_index_move_no_posting_of_a_query(spark, tmp_path):
    """Words and blocks are dealt once for all queries; scores are summed where a block is."""
    docs, items = rq.documents(spark, SF), rq.benchmark_queries(spark, SF)
    save_index(docs, str(tmp_path / "index"))
    index = load_index(spark, str(tmp_path / "index"), docs).opened(items.terms)
    terms = with_idf(items, _document_counts(index, items))
    terms = terms.where("qpos = first_qpos").select("query_id", "term", "idf", "avg_len").localCheckpoint()
    visits = best_blocks.block_bounds(index, terms, True).select("query_id", "block").localCheckpoint()
    scored = best_blocks._scored(index, items, terms, visits)
    moved = [x for x in plan(scored).splitlines() if "Exchange hashpartitioning" in x]
    assert moved and not [x for x in moved if "query_id" in x]
    everything = rk.rank_bm25(docs, items).select("query_id", "doc_id", "weight")
    assert sorted(map(tuple, scored.select(everything.columns).collect())) == sorted(map(tuple, everything.collect()))
