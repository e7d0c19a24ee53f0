from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wordloom import search, sizing
from wordloom.codes import MATCH_MODES, code_name
from wordloom.functions import escape_text
from wordloom.operators import filters as fl
from wordloom.operators import ordering as od
from wordloom.operators.attributes import override
from wordloom.operators.clauses import clause_batch, match_extended
from wordloom.operators.excerpts import excerpts, keywords
from wordloom.operators.grouping import group_best, group_by, page_groups
from wordloom.plans.search import Group
from wordloom.sources import corpora, query_batch, validate_queries

ROWS = [
    (1, 1, 5, "a", datetime(2024, 1, 1, 5), [1, 2]),
    (1, 2, 9, "a", datetime(2024, 1, 7, 23), [2]),
    (1, 3, 9, "b", datetime(2024, 1, 8, 0), []),
    (1, 4, 1, "a", datetime(2023, 12, 31, 1), None),
    (2, 1, 7, "b", datetime(2024, 1, 1, 5), [2, 2]),
]


@pytest.fixture(scope="module")
def matches(spark):
    return spark.createDataFrame(
        ROWS, "query_id long, doc_id long, weight long, kind string, ts timestamp_ntz, tags array<long>"
    )


def listed(df):
    return [r["doc_id"] for r in df.where("query_id = 1").orderBy("rank").collect()]


def test_orders_end_with_the_id(matches):
    assert listed(od.page(matches)) == [2, 3, 1, 4]
    assert listed(od.page(matches, order=od.attribute("kind"))) == [3, 1, 2, 4]
    assert listed(od.page(matches, order=od.attribute("kind", desc=False))) == [1, 2, 4, 3]
    assert listed(od.page(matches, order=od.extended([("@weight", "asc"), ("@id", "desc")]))) == [4, 1, 3, 2]
    assert listed(od.page(matches, order=od.expression("-weight"))) == [4, 1, 2, 3]
    with pytest.raises(ValueError):
        od.extended([("weight", "up")])


def test_time_segments(matches):
    order = od.time_segments(matches, "ts", datetime(2024, 1, 8, 0, 30))
    assert listed(od.page(matches, order=order)) == [3, 2, 1, 4]


def test_whole_sort(matches):
    rows = od.sort_matches(matches, od.relevance()).collect()
    assert [(r["query_id"], r["doc_id"]) for r in rows] == [(1, 2), (1, 3), (1, 1), (1, 4), (2, 1)]


@pytest.mark.parametrize("slices", [1, 5])
def test_pages_and_bounds(matches, slices, monkeypatch):
    monkeypatch.setattr(od, "fan_in", lambda df, k: slices)
    assert listed(od.page(matches, 1, 2)) == [3, 1]
    assert [r["rank"] for r in od.page(matches, 1, 2).where("query_id = 1").orderBy("rank").collect()] == [2, 3]
    assert listed(od.page(matches, 1, 20, bound=2)) == [3]
    assert listed(od.page(matches, 5, 20, bound=2)) == []
    assert od.max_matches(matches, 2).count() == 3
    assert od.max_matches(matches, 0).count() == 5
    assert sorted(r["doc_id"] for r in od.cutoff(matches, 2).where("query_id = 1").collect()) == [1, 2]
    assert od.cutoff(matches, 0).count() == 5
    for offset, limit in ((-1, 5), (16777216, 5), (0, 0), (0, 16777216)):
        with pytest.raises(ValueError):
            od.page(matches, offset, limit)


def test_groups(matches):
    days = {(r["query_id"], r["group_key"]): r["count"] for r in group_by(matches, "ts", "day").collect()}
    assert days[(1, date(2024, 1, 1))] == 1 and len(days) == 5
    weeks = {r["group_key"]: r["count"] for r in group_by(matches, "ts", "week").where("query_id = 1").collect()}
    assert weeks == {date(2024, 1, 1): 2, date(2024, 1, 8): 1, date(2023, 12, 25): 1}
    years = group_by(matches, "ts", 3).where("query_id = 1").collect()
    assert {r["group_key"] for r in years} == {date(2023, 1, 1), date(2024, 1, 1)}
    kinds = {
        (r["query_id"], r["group_key"]): (r["count"], r["best_doc_id"], r["best_weight"])
        for r in group_by(matches, "kind", "attr").collect()
    }
    assert kinds == {(1, "a"): (3, 2, 9), (1, "b"): (1, 3, 9), (2, "b"): (1, 1, 7)}
    tags = {(r["query_id"], r["group_key"]): r["count"] for r in group_by(matches, "tags", "attr").collect()}
    assert tags == {(1, 1): 1, (1, 2): 2, (2, 2): 1}


def test_distinct_and_ties(matches):
    for approximate in (False, True):
        rows = group_by(matches, "ts", "year", distinct="kind", approximate=approximate).collect()
        got = {(r["query_id"], r["group_key"].year): (r["distinct"], r["best_doc_id"]) for r in rows}
        assert got == {(1, 2023): (1, 4), (1, 2024): (2, 2), (2, 2024): (1, 1)}


def test_group_best_by_another_order(matches):
    rows = group_best(matches, "kind", "attr", od.attribute("ts", desc=False)).collect()
    got = {(r["query_id"], r["group_key"]): (r["count"], r["doc_id"]) for r in rows}
    assert got == {(1, "a"): (3, 4), (1, "b"): (1, 3), (2, "b"): (1, 1)}


def test_group_pages(matches):
    groups = group_by(matches, "kind", "attr")
    first = page_groups(groups, limit=1).where("query_id = 1").first()
    assert first["group_key"] == "b"
    by_count = page_groups(groups, [("@count", "desc")], limit=1).where("query_id = 1").first()
    assert by_count["group_key"] == "a"


def test_search_results(docs, batch):
    result = search(docs, batch("red fox", "no such words", "the"))
    rows = {(r["query_id"], r["rank"]): r for r in result.matches.collect()}
    assert {k for k in rows} == {(1, 1), (1, 2), (3, 1)}
    assert result.matches.columns == ["query_id", "rank", "doc_id", "weight", "group_id"]
    assert rows[(3, 1)]["doc_id"] == 4 and rows[(3, 1)]["group_id"] == 20
    totals = {r["query_id"]: (r["total"], r["total_found"]) for r in result.summary.collect()}
    assert totals == {1: (2, 2), 2: (0, 0), 3: (1, 1)}
    words = {(r["query_id"], r["word"]): (r["docs"], r["hits"]) for r in result.word_stats.collect()}
    assert words[(1, "red")] == (4, 6) and words[(2, "such")] == (0, 0) and words[(3, "the")] == (1, 5)


def test_search_keeps_statistics_of_the_whole_corpus(docs, batch):
    whole = {r["doc_id"]: r["weight"] for r in search(docs, batch("red"), "any", "bm25").matches.collect()}
    some = search(docs, batch("red"), "any", "bm25", filters=[fl.values("group_id", [20])])
    part = {r["doc_id"]: r["weight"] for r in some.matches.collect()}
    assert part == {d: whole[d] for d in (3, 4)}


def test_search_bounds_total(docs, batch):
    result = search(docs, batch("red"), "any", "none", max_matches=3, limit=2)
    assert [r["total"] for r in result.summary.collect()] == [3]
    assert [r["total_found"] for r in result.summary.collect()] == [4]
    assert result.matches.count() == 2


def test_kept_search_reads_its_checkpoint(docs, batch):
    result = search(docs, batch("red fox"), keep=True)
    plan = result.summary._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract_all(lower(coalesce(body" not in plan
    assert result.matches.count() == 2


def test_clause_search_with_nothing_to_rank_by(spark, docs):
    clauses = spark.createDataFrame(
        [(1, 1, "not", "red"), (2, 1, "must", "dog")], "query_id long, clause int, kind string, text string"
    )
    result = search(docs, clause_batch(clauses), "boolean", "wordcount", carry=["group_id"])
    got = {(r["query_id"], r["doc_id"]): (r["weight"], r["group_id"]) for r in result.matches.collect()}
    assert got == {(1, 1): (1, 10), (1, 2): (1, 10), (2, 4): (1, 20)}
    assert {r["query_id"]: r["total"] for r in result.summary.collect()} == {1: 2, 2: 1}


def test_fullscan_search(docs):
    result = search(docs, None, "fullscan", sort=od.attribute("group_id"), carry=["group_id"], limit=2)
    assert [r["doc_id"] for r in result.matches.orderBy("rank").collect()] == [5, 3]
    assert result.summary.first()["total_found"] == 6 and result.word_stats is None


def test_grouped_search(docs, batch):
    result = search(docs, batch("red"), "any", "none", group=Group("group_id", "attr"))
    got = [(r["group_key"], r["count"]) for r in result.matches.orderBy("rank").collect()]
    assert got == [(30, 1), (20, 2), (None, 1)]
    assert result.summary.first()["total_found"] == 3


def test_search_over_several_corpora(docs, batch):
    both = corpora({"a": docs, "b": docs})
    result = search(both, batch("red fox"), index_weights={"b": 10})
    rows = result.matches.orderBy("rank").collect()
    assert [r["index_name"] for r in rows] == ["b", "b", "a", "a"]
    assert result.matches.columns == ["query_id", "rank", "index_name", "doc_id", "weight", "group_id"]


def test_mode_and_batch_must_fit(docs, batch):
    for mode in ("boolean", "fullscan"):
        with pytest.raises(ValueError):
            search(docs, batch("red"), mode)
    with pytest.raises(ValueError):
        search(docs, None, "all")
    with pytest.raises(ValueError):
        code_name(MATCH_MODES, 7)
    assert code_name(MATCH_MODES, 6) == code_name(MATCH_MODES, "extended2")


def test_validation(spark):
    rows = [
        (1, "red", 0, 20, 0),
        (2, "red", 16777216, 20, 0),
        (3, "red", 0, 0, 0),
        (4, "red", 0, 20, 7),
        (5, "!!", 0, 20, 0),
        (6, None, 0, 20, 0),
        (7, "!!", -1, 20, 0),
    ]
    df = spark.createDataFrame(rows, "query_id long, text string, offset long, limit long, mode int")
    got = {r["query_id"]: (r["status"], r["message"]) for r in validate_queries(df).collect()}
    assert got == {
        1: ("ok", ""),
        2: ("error", "offset out of range"),
        3: ("error", "limit out of range"),
        4: ("error", "unknown match mode"),
        5: ("warning", "query has no words"),
        6: ("error", "query text is missing"),
        7: ("error", "offset out of range"),
    }


@pytest.mark.parametrize("bound", [2_000_000, -1])
def test_excerpts_and_keywords(docs, batch, bound, monkeypatch):
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", bound)
    queries = batch("dog red", "école")
    best = search(docs, queries, "any", "wordcount").matches
    got = {(r["query_id"], r["doc_id"]): (r["field"], r["pos"], r["excerpt"]) for r in excerpts(docs, queries, best, 1).collect()}
    assert got[(1, 3)] == ("title", 0, "red fox")
    assert got[(1, 4)] == ("body", 5, "the red dog")
    assert got[(2, 6)] == ("body", 3, "l école 2024")
    words = {(r["query_id"], r["qpos"]): (r["term"], r["docs"], r["hits"]) for r in keywords(docs, queries).collect()}
    assert words == {(1, 0): ("dog", 1, 1), (1, 1): ("red", 4, 6), (2, 0): ("école", 2, 2)}


def test_escape(spark):
    special = '=()|-!@~"&/\\^$'
    df = spark.createDataFrame([(special + "a b",)], "t string")
    got = df.select(escape_text("t").alias("e")).first()["e"]
    assert got == "".join("\\" + c for c in special) + "a b"
    assert df.select(escape_text(F.lit(None).cast("string")).alias("e")).first()["e"] is None


def test_pages_are_never_cut_silently(spark, docs, batch):
    rows = spark.range(2500).select(
        F.lit(1).alias("query_id"), F.col("id").alias("doc_id"), F.col("id").alias("weight")
    )
    assert od.page(rows, 1500, 900).count() == 900
    assert od.page(rows, 990, 20, bound=1000).count() == 10
    with pytest.raises(ValueError):
        search(docs, batch("red"), offset=990, limit=20)
    assert search(docs, batch("red"), max_matches=5, limit=5).matches.count() > 0


def test_packed_weights_order_beyond_their_bits(spark, docs, batch):
    """BM25 beyond 32 bits: the packed numbers tie, the exact scores decide."""
    rows = spark.createDataFrame(
        [(1, 1, 2**32 - 1, 5 * 10**9), (1, 2, 2**32 - 1, 6 * 10**9), (1, 3, 2**33, 1)],
        "query_id long, doc_id long, weight long, bm25 long",
    )
    best = od.page(rows, order=od.relevance(rows)).collect()
    assert [r.doc_id for r in sorted(best, key=lambda r: r["rank"])] == [3, 2, 1]
    with pytest.raises(ValueError):
        search(docs, batch("red fox"), field_weights=[2**30, 1])


def test_repeated_and_broken_input_is_refused(spark, docs):
    twice = spark.createDataFrame([(1, "the of"), (1, "and in")], "query_id long, text string")
    with pytest.raises(ValueError):
        query_batch(twice)
    values = spark.createDataFrame([(1, 1, 5), (1, 1, 6)], "query_id long, doc_id long, value long")
    rows = spark.createDataFrame([(1, 1, 2)], "query_id long, doc_id long, group_id long")
    with pytest.raises(ValueError):
        override(rows, "group_id", values)
    clauses = "query_id long, clause int, kind string, text string, field string"
    for bad in (
        [(1, 1, "must", "the", None), (1, 2, "must", "!!!", None)],
        [(1, 1, "must", "the", None), (1, 1, "any", "red", None)],
    ):
        with pytest.raises(ValueError):
            clause_batch(spark.createDataFrame(bad, clauses))
    field = clause_batch(spark.createDataFrame([(1, 1, "must", "the", "nowhere")], clauses))
    with pytest.raises(ValueError):
        match_extended(docs, field)


def test_status_of_each_query(spark, docs):
    rows = [(1, None), (2, "!!!"), (3, "red")]
    batch = query_batch(spark.createDataFrame(rows, "query_id long, text string"))
    got = {r.query_id: (r.status, r.total_found > 0) for r in search(docs, batch).summary.collect()}
    assert got == {1: ("error", False), 2: ("warning", False), 3: ("ok", True)}


def test_grouped_search_honours_the_sort(spark, docs, batch):
    found = search(
        docs, batch("red"), "any", "none", carry=["group_id"], sort=od.attribute("doc_id"),
        items=["group_id"], group=Group("group_id", "attr"),
    ).matches
    got = {r.group_key: (r.doc_id, r["count"]) for r in found.collect()}
    assert got == {20: (4, 2), 30: (5, 1), None: (6, 1)}
