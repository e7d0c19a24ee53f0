"""A batch with settings per query against one search per query."""

import pytest
from conftest import SF
from pyspark.sql import functions as F
from test_plans import final_plan

from registry import queries as rq
from wordloom import search
from wordloom.codes import MATCH_MODES, RANKERS, SORT_MODES
from wordloom.operators import filters as fl
from wordloom.operators import ordering as od
from wordloom.plans.each import search_each
from wordloom.sources import load_index, query_batch, save_index

NAMES = ["mode", "ranker", "sort", "sort_by", "offset", "limit", "max_matches", "cutoff"]
NAMES += ["min_id", "max_id", "field_weights"]
TYPES = "query_id long, text string, mode int, ranker int, sort int, sort_by string, offset int, "
TYPES += "`limit` int, max_matches int, cutoff int, min_id long, max_id long, "
TYPES += "field_weights map<string,int>"
GOOD = [
    ("red widget", dict(mode="any", ranker="bm25")),
    ("red widget brand", dict()),
    ("brand 4", dict(mode="phrase", ranker="boosted", field_weights={"p_brand": 5})),
    ("blue bolt", dict(mode="any", ranker="wordcount", sort="attr_desc", sort_by="p_size")),
    ("blue bolt", dict(mode="any", ranker="matchany", sort="attr_asc", sort_by="p_retailprice", limit=7)),
    ("small ring", dict(mode="any", ranker="fieldmask", offset=5, limit=9)),
    ("small", dict(ranker="none", cutoff=12, max_matches=30)),
    ("large ring", dict(mode="any", ranker="proximity", min_id=40, max_id=160)),
    ("red bolt", dict(mode="any", ranker="proximity_bm25", field_weights={"p_name": 3, "p_type": 0})),
    ("red bolt", dict(mode="any", ranker="bm25")),
    ("nothingatall", dict()),
    ("...", dict(mode="any")),
]
BAD = [
    (None, dict(), "query text is missing"),
    ("red", dict(mode="boolean"), "this mode takes a batch of its own"),
    ("red", dict(ranker="expr"), "a rank expression takes a batch of its own"),
    ("red", dict(sort="attr_desc", sort_by="nope"), "unknown sort attribute"),
    ("red", dict(sort="attr_asc"), "unknown sort attribute"),
    ("red", dict(offset=990, limit=20), "page beyond max_matches"),
    ("red", dict(field_weights={"nope": 1}), "unknown field"),
    ("red", dict(field_weights={"p_name": 2**30}), "field weights too large"),
    ("red", dict(min_id=9, max_id=3), "id range is reversed"),
]
FILTERS = [
    (1, "p_size", 5.0, 30.0, False),
    (1, "p_retailprice", 0.0, 950.0, True),
    (10, "p_size", 1.0, 9.0, True),
]
FILTER_TYPES = "query_id long, attr string, lo double, hi double, exclude boolean"


def table(spark, rows):
    codes = {"mode": MATCH_MODES, "ranker": RANKERS, "sort": SORT_MODES}
    listed = []
    for i, row in enumerate(rows, 1):
        values = [codes[n].get(row[1].get(n)) if n in codes else row[1].get(n) for n in NAMES]
        listed.append((i, row[0], *values))
    return spark.createDataFrame(listed, TYPES)


def pages(result):
    rows = result.matches.collect()
    return sorted((r["query_id"], r["rank"], r["doc_id"], r["weight"], r["p_size"]) for r in rows)


def one_by_one(spark, docs):
    found, totals = [], {}
    for i, (text, given) in enumerate(GOOD, 1):
        given = dict(given)
        sort, by = given.pop("sort", None), given.pop("sort_by", None)
        given["id_range"] = (given.pop("min_id", 0), given.pop("max_id", 0))
        given["cutoff_at"] = given.pop("cutoff", 0)
        filters = [fl.float_between(a, lo, hi, ex) for q, a, lo, hi, ex in FILTERS if q == i]
        if sort:
            given |= {"sort": od.attribute(by, sort == "attr_desc"), "carry": [by]}
        batch = query_batch(spark.createDataFrame([(i, text)], "query_id long, text string"))
        result = search(docs, batch, filters=filters, **given)
        found += pages(result)
        totals[i] = result.summary.first()["total_found"]
    return sorted(found), totals


@pytest.fixture(scope="module")
def filters(spark):
    return spark.createDataFrame(FILTERS, FILTER_TYPES)


@pytest.mark.parametrize("indexed", [False, True])
def test_as_one_search_per_query(spark, filters, tmp_path, indexed):
    docs = rq.parts(spark, SF)
    expected, totals = one_by_one(spark, docs)
    if indexed:
        save_index(docs, str(tmp_path / "index"))
        docs = load_index(spark, str(tmp_path / "index"), docs)
    result = search_each(docs, table(spark, [*GOOD, *BAD]), filters)
    assert pages(result) == expected
    summary = {r["query_id"]: r for r in result.summary.collect()}
    assert len(summary) == len(GOOD) + len(BAD)
    assert {i: summary[i]["total_found"] for i in totals} == totals
    for i, (_, _, message) in enumerate(BAD, len(GOOD) + 1):
        row = summary[i]
        assert (row["status"], row["message"], row["total_found"]) == ("error", message, 0)
    assert {r["query_id"] for r in result.word_stats.collect()} <= set(totals)


def test_one_pass_over_the_texts(spark):
    text = final_plan(search_each(rq.parts(spark, SF), table(spark, GOOD)).matches)
    text = text.split("== Initial Plan ==")[0]
    splits = [x for x in text.splitlines() if "Project" in x and "regexp_extract_all(lower(coalesce(p_name" in x]
    assert len(splits) == 1


def test_defaults_and_unknown_filters(spark):
    docs = rq.documents(spark, SF)
    plain = spark.createDataFrame([(1, "the of and"), (2, "de la")], "query_id long, text string")
    one = search_each(docs, plain).matches.collect()
    assert sorted(one) == sorted(search(docs, query_batch(plain)).matches.select(*one[0].__fields__).collect())
    bad = spark.createDataFrame([(1, "nope", 1.0, 2.0, False)], FILTER_TYPES)
    with pytest.raises(ValueError, match="no such"):
        search_each(docs, plain, bad)
