"""What the physical plans must and must not contain."""

import pytest
from conftest import SF

from registry import queries as rq
from wordloom import corpus, search
from wordloom.operators import filters as fl
from wordloom.operators import ordering as od
from wordloom.operators import ranking as rk
from wordloom.operators.clauses import clause_batch
from wordloom.operators.excerpts import excerpts
from wordloom.operators.grouping import group_best
from wordloom.operators.matching import match_phrase


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df)


@pytest.mark.parametrize("name", sorted(rq.QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(rq.QUERIES[name](spark, SF))
    for node in ("EvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "NestedLoopJoin"):
        assert node not in text


def test_default_search(spark):
    text = plan(rq.default_search(spark, SF))
    assert "WindowGroupLimit" in text
    assert "BroadcastHashJoin [term" in text
    assert "SortMergeJoin" not in text


SCORED = ["d1_proximity_bm25", "d2_bm25", "d2_bm25_benchmark", "d8_boosted_proximity"]
SCORED += ["d9_expr", "e1_relevance", "j1_batch_search", "j1_default_search"]


@pytest.mark.parametrize("name", SCORED)
def test_scoring_splits_the_texts_once(spark, name):
    """Statistics and ranking share one shuffle of counted words."""
    text = final_plan(rq.QUERIES[name](spark, SF))
    final = text[: text.index("== Initial Plan ==")]
    counted = [line for line in final.splitlines() if "hashpartitioning(doc_id" in line]
    assert len([line for line in counted if "ReusedExchange" not in line]) == 1
    assert len([line for line in counted if "ReusedExchange" in line]) == 1


def test_filters_reach_the_scan(spark):
    df = spark.read.parquet(f"{SF}/customer.parquet")
    assert "In(c_nationkey" in plan(fl.filter_values(df, "c_nationkey", [1, 5]))
    assert "GreaterThanOrEqual(c_nationkey,3)" in plan(fl.filter_range(df, "c_nationkey", 3, 4))
    assert "GreaterThanOrEqual(c_acctbal" in plan(fl.filter_float_range(df, "c_acctbal", 3.0, 4.0))


def test_search_reads_only_what_it_needs(spark):
    docs = rq.documents(spark, SF)
    text = plan(search(docs, rq.batch(spark), filters=[fl.between("n_chars", 0, 900)]).matches)
    assert "LessThanOrEqual(n_chars,900)" in text
    schemas = [line for line in text.split("ReadSchema: ")[1:] if "text:string" in line[:200]]
    assert schemas
    for schema in schemas:
        columns = schema[: schema.index(">")]
        assert "lang" not in columns and "source" not in columns


def test_grouping_combines_before_its_only_shuffle(spark):
    text = plan(rq.group_month(spark, SF))
    shuffles = [line for line in text.splitlines() if "hashpartitioning(" in line]
    assert shuffles and not any("weight" in line for line in shuffles)
    assert "partial_count" in text


def test_grouped_best_splits_texts_once(spark):
    docs = corpus(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id", ["text"], ["lang", "n_chars"])
    rows = rk.ranked(docs, rq.batch(spark), "wordcount", carry=["lang", "n_chars"])
    text = plan(group_best(rows, "lang", "attr", od.attribute("n_chars")))
    assert text.count("FileScan parquet") == 1


def test_phrase_moves_linked_words_only(spark):
    text = plan(match_phrase(rq.documents(spark, SF), rq.batch(spark)))
    body = text[: text.index("FileScan parquet")]
    assert body.count("hashpartitioning(query_id") == 1


def test_excerpts_split_the_page_only(spark):
    docs = corpus(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id", ["text"])
    page = spark.createDataFrame([(1, 3)], "query_id long, doc_id long")
    text = plan(excerpts(docs, rq.batch(spark), page, rows=1))
    assert text.index("regexp_extract_all") < text.index("BroadcastHashJoin [doc_id")


def test_clauses_without_ranker_split_texts_once(spark):
    docs = corpus(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id", ["text"])
    clauses = clause_batch(rq._clauses(spark, rq.EXTENDED))
    found = search(docs, clauses, "extended", "none")
    assert plan(found.matches).count("text:string") == 1
