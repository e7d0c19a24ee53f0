from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wordloom import sizing
from wordloom.operators import filters as fl
from wordloom.operators.attributes import override, select, typed, update_attributes, updated_count
from wordloom.sources import corpora, corpus, corpus_status, describe_corpus, load_prepared, save_prepared
from wordloom.sources import tokens

TYPES = """id long, a_int long, a_ts long, a_bool long, a_float double, a_big long, a_str string,
a_mva array<long>"""
ROWS = [
    (1, 2**32 - 1, 1000000000, 1, 0.1, -(2**63), "", [1, 2]),
    (2, 0, 0, 0, 16777217.0, 2**63 - 1, "x", []),
    (3, None, None, None, None, None, None, None),
]


@pytest.fixture(scope="module")
def typed_rows(spark):
    return spark.createDataFrame(ROWS, TYPES)


def ids(df, name="id"):
    return sorted(r[name] for r in df.collect())


def test_types(typed_rows):
    kinds = {"a_ts": "timestamp", "a_bool": "bool", "a_float": "float", "a_int": "integer"}
    rows = {r["id"]: r for r in typed(typed_rows, kinds).collect()}
    assert rows[1]["a_ts"] == datetime(2001, 9, 9, 1, 46, 40)
    assert rows[1]["a_bool"] is True and rows[1]["a_int"] == 2**32 - 1
    assert rows[2]["a_float"] == 16777216.0 and rows[3]["a_ts"] is None
    with pytest.raises(ValueError):
        typed(typed_rows, {"a_int": "decimal"})


@pytest.mark.parametrize("attr", ["a_int", "a_mva"])
def test_filter_and_exclusion_part_the_rows(typed_rows, attr):
    for one in (fl.values(attr, [0, 1, 5]), fl.between(attr, 0, 1)):
        kept = ids(one(typed_rows))
        assert 3 not in kept
    left = ids(fl.filter_values(typed_rows, attr, [0, 1, 5]))
    right = ids(fl.filter_values(typed_rows, attr, [0, 1, 5], exclude=True))
    assert sorted(left + right) == [1, 2, 3] and 3 in right
    left = ids(fl.filter_range(typed_rows, attr, 0, 1))
    right = ids(fl.filter_range(typed_rows, attr, 0, 1, exclude=True))
    assert sorted(left + right) == [1, 2, 3] and 3 in right


@pytest.mark.parametrize("bound", [2_000_000, -1])
@pytest.mark.parametrize("attr", ["a_int", "a_mva"])
def test_value_tables_equal_value_lists(spark, typed_rows, attr, bound, monkeypatch):
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", bound)
    listed = [0, 1, 5]
    table = spark.createDataFrame([(v,) for v in [*listed, None, 1]], "v long")
    for exclude in (False, True):
        assert ids(fl.filter_values(typed_rows, attr, table, exclude)) == ids(
            fl.filter_values(typed_rows, attr, listed, exclude)
        )


def test_float_bounds_are_32_bit(typed_rows):
    assert ids(fl.filter_float_range(typed_rows, "a_float", 0.1, 0.1)) == [1]
    assert ids(fl.filter_float_range(typed_rows, "a_float", 16777216.0, 16777216.0)) == [2]
    assert ids(fl.filter_float_range(typed_rows, "a_float", 0.1, 0.1, exclude=True)) == [2, 3]


def test_id_range(typed_rows):
    assert ids(fl.filter_id_range(typed_rows, 2, 0, "id")) == [2, 3]
    assert ids(fl.filter_id_range(typed_rows, 0, 2, "id")) == [1, 2]
    assert ids(fl.filter_id_range(typed_rows, 0, 0, "id")) == [1, 2, 3]


def test_reversed_ranges_are_refused(typed_rows):
    for call in (fl.filter_range, fl.filter_float_range):
        with pytest.raises(ValueError):
            call(typed_rows, "a_int", 2, 1)
    with pytest.raises(ValueError):
        fl.filter_id_range(typed_rows, 2, 1, "id")


def test_updates(spark, docs):
    schema = "doc_id long, group_id long"
    updates = spark.createDataFrame([(2, 123), (4, 456), (99, 1)], schema)
    done = update_attributes(docs, updates, ["group_id"])
    got = {r["doc_id"]: r["group_id"] for r in done.documents.collect()}
    assert got == {1: 10, 2: 123, 3: 20, 4: 456, 5: 30, 6: None}
    assert updated_count(docs, updates).first()["updated"] == 2
    twice = spark.createDataFrame([(2, 123), (2, 456)], schema)
    with pytest.raises(ValueError):
        update_attributes(docs, twice, ["group_id"])
    with pytest.raises(ValueError):
        updated_count(docs, twice)
    with pytest.raises(ValueError):
        update_attributes(docs, updates, ["group_id"], mva=True)


def test_multi_value_update(spark, typed_rows):
    lists = corpus(typed_rows, "id", [], ["a_mva"])
    updates = spark.createDataFrame([(1, []), (3, [7, 8])], "doc_id long, a_mva array<long>")
    done = update_attributes(lists, updates, ["a_mva"], mva=True)
    got = {r["doc_id"]: r["a_mva"] for r in done.documents.collect()}
    assert got == {1: [], 2: [], 3: [7, 8]}


def test_override_is_per_query(spark):
    rows = spark.createDataFrame(
        [(1, 1, 5), (1, 2, 5), (2, 1, 5)], "query_id long, doc_id long, size long"
    )
    values = spark.createDataFrame([(1, 1, 9), (1, 77, 9)], "query_id long, doc_id long, value int")
    got = {(r["query_id"], r["doc_id"]): r["size"] for r in override(rows, "size", values).collect()}
    assert got == {(1, 1): 9, (1, 2): 5, (2, 1): 5}


def test_select_list(typed_rows):
    assert select(typed_rows, ["id", "a_int + 1 AS more"]).columns == ["id", "more"]
    assert select(typed_rows).columns == typed_rows.columns


def test_tokens_and_status(docs):
    rows = [tuple(r) for r in tokens(docs).where("doc_id <= 3").orderBy("doc_id", "field", "pos").collect()]
    assert rows == [
        (1, "title", 0, "empty"),
        (2, "title", 0, "no"),
        (2, "title", 1, "body"),
        (3, "body", 0, "red"),
        (3, "body", 1, "fox"),
        (3, "title", 0, "red"),
        (3, "title", 1, "fox"),
    ]
    accented = tokens(docs).where("doc_id = 5 AND field = 'body'").orderBy("pos")
    assert [r["term"] for r in accented.collect()] == ["été", "à", "l", "école", "2024", "red"]
    status = {r["key"]: r["value"] for r in corpus_status(docs).collect()}
    assert status["documents"] == "6"
    assert int(status["tokens"]) == tokens(docs).count()
    assert int(status["distinct_terms"]) == tokens(docs).select("term").distinct().count()


def test_empty_corpus(spark, docs):
    empty = docs.where(F.lit(False))
    status = {r["key"]: r["value"] for r in corpus_status(empty).collect()}
    assert status == {
        "documents": "0",
        "tokens": "0",
        "distinct_terms": "0",
        "avg_length_milli": "0",
    }


def test_description(docs):
    rows = [tuple(r) for r in describe_corpus(docs).orderBy("position").collect()]
    assert rows == [
        (0, "field", "title", "string", 6),
        (1, "field", "body", "string", 5),
        (2, "attribute", "group_id", "bigint", 5),
    ]


def test_union_keeps_ids_apart(spark, docs):
    other = corpus(spark.createDataFrame([(3, "red")], "id long, body string"), "id", ["body"])
    both = corpora({"a": docs, "b": other})
    assert both.keys == ("index_name", "doc_id")
    assert both.df.count() == 7
    names = {r["index_name"] for r in tokens(both).where("term = 'red'").collect()}
    assert names == {"a", "b"}


def test_prepared_corpus_gives_the_same(spark, docs, batch, tmp_path):
    from wordloom.operators.ranking import rank_proximity_bm25

    save_prepared(docs, str(tmp_path / "lists"))
    again = load_prepared(spark, str(tmp_path / "lists"), docs)
    queries = batch("the red fox", "été")
    one = sorted(map(tuple, rank_proximity_bm25(docs, queries).collect()))
    assert one == sorted(map(tuple, rank_proximity_bm25(again, queries).collect()))


@pytest.mark.parametrize("kind", ["double", "float", "int", "bigint", "array<double>", "array<int>"])
@pytest.mark.parametrize("exclude", [False, True])
def test_lists_and_tables_of_values_agree(spark, monkeypatch, kind, exclude):
    plain = [None, 2, 3, 0, -5] + ([2.5, -0.5] if "double" in kind or "float" in kind else [])
    rows = [(i, [v] if "array" in kind and v is not None else v) for i, v in enumerate(plain)]
    cast = [(i, v) if v is None or "int" in kind else
            (i, [float(x) for x in v] if isinstance(v, list) else float(v)) for i, v in rows]
    df = spark.createDataFrame(cast, f"id long, a {kind}")
    wanted = [2, 0, 7, 2**40, None]
    table = spark.createDataFrame([(v,) for v in wanted], "v bigint")
    listed = [v for v in wanted if v is not None]
    ids = lambda found: sorted(r.id for r in found.collect())
    by_list = ids(fl.filter_values(df, "a", listed, exclude))
    assert ids(fl.filter_values(df, "a", table, exclude)) == by_list
    monkeypatch.setattr(fl, "LISTED", 1)
    assert ids(fl.filter_values(df, "a", listed, exclude)) == by_list
    hits = {i for i, v in enumerate(plain) if v in (2, 0)}
    assert by_list == sorted(hits if not exclude else set(range(len(plain))) - hits)
