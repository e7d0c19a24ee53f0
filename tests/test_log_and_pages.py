"""The log of updates, deep pages, and the exact order behind packed weights."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wordloom import corpus
from wordloom.codes import WEIGHT_BOUND
from wordloom.operators import ordering as od
from wordloom.operators.attributes import update_attributes, updated_count
from wordloom.operators.grouping import group_by
from wordloom.operators.update_log import UpdateLog


@pytest.fixture()
def things(spark):
    rows = [(i, "t", i * 10, f"n{i}", [i]) for i in range(20)]
    schema = "doc_id long, text string, size long, name string, tags array<long>"
    return corpus(spark.createDataFrame(rows, schema), "doc_id", ["text"], ["size", "name", "tags"])


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_log_equals_its_batches_one_by_one(spark, things, tmp_path):
    rng = random.Random(3)
    log, now, counts = UpdateLog(str(tmp_path / "log"), things), things, {}
    for batch in range(6):
        attrs = rng.choice([["size"], ["size", "name"], ["tags"]])
        ids = rng.sample(range(26), rng.randrange(0, 9))
        made = [
            (i, rng.choice([None, batch * 100 + i]), rng.choice([None, f"b{batch}"]), [batch, i])
            for i in ids
        ]
        updates = spark.createDataFrame(made, "doc_id long, size int, name string, tags array<int>")
        log.append(batch, updates, attrs)
        now = update_attributes(now, updates, attrs, mva=attrs == ["tags"])
        counts[batch] = updated_count(things, updates).first()["updated"]
        assert rows(log.overlaid().df) == rows(now.df)
        if batch == 2:
            third = rows(now.df)
    assert rows(log.overlaid(upto=2).df) == third
    found = {r["batch"]: r["updated"] for r in log.updated_counts().collect()}
    assert found == {b: n for b, n in counts.items() if b in found}
    assert all(n == 0 for b, n in counts.items() if b not in found)


def test_bad_batches_are_refused(spark, things, tmp_path):
    log = UpdateLog(str(tmp_path / "log"), things)
    twice = spark.createDataFrame([(1, 1), (1, 2)], "doc_id long, size long")
    with pytest.raises(ValueError, match="twice"):
        log.append(1, twice, ["size"])
    once = twice.limit(1)
    log.append(1, once, ["size"])
    with pytest.raises(Exception, match="(?i)exist"):
        log.append(1, once, ["size"])
    with pytest.raises(ValueError, match="no such"):
        log.append(2, once, ["nope"])
    with pytest.raises(ValueError, match="lists"):
        log.append(2, once.withColumnRenamed("size", "tags"), ["tags"])


@pytest.mark.parametrize("offset, limit", [(0, 5), (17, 40), (990, 30), (1200, 3), (300, 5000)])
def test_deep_pages(spark, offset, limit):
    rng = random.Random(offset)
    data = [(1, i, rng.randrange(6)) for i in range(1000)] + [(2, i, i % 3) for i in range(350)]
    data += [(i, 5, 1) for i in range(3, 40)]
    df = spark.createDataFrame(data, "query_id long, doc_id long, weight long").repartition(7)
    mine = od.deep_page(df, offset, limit)
    assert mine.columns == od.page(df, offset, limit).columns
    assert rows(mine) == rows(od.page(df, offset, limit))
    by = od.extended([("weight", "asc"), ("@id", "desc")])
    assert rows(od.deep_page(df, offset, limit, by)) == rows(od.page(df, offset, limit, by))


def test_a_range_is_all_a_task_ranks(spark):
    df = spark.range(4000).selectExpr("1L as query_id", "id as doc_id", "1L as weight")
    spread = od.deep_page(df, 2000, 10)
    sizes = spread.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ranked = [r["doc_id"] for r in spread.orderBy("rank").collect()]
    assert ranked == list(range(2000, 2010)) and int(sizes) > 1


def test_the_exact_score_decides_behind_a_clamped_weight(spark):
    over = WEIGHT_BOUND
    data = [(1, 1, over, over + 5, "a"), (1, 2, over, over + 9, "a"), (1, 3, over, over + 7, "b")]
    df = spark.createDataFrame(data, "query_id long, doc_id long, weight long, bm25 long, kind string")
    df = df.withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    best = {r["group_key"]: r["best_doc_id"] for r in group_by(df, "kind", "attr").collect()}
    assert best == {"a": 2, "b": 3}
    distinct = group_by(df, "kind", "attr", distinct="ts").collect()
    assert {r["group_key"]: r["best_doc_id"] for r in distinct} == best
    in_order = lambda x: [r["doc_id"] for r in x.orderBy("rank").collect()]
    assert in_order(od.page(df)) == [2, 3, 1] == in_order(od.max_matches(df, 3))


    segments = od.time_segments(df, "ts", datetime(2024, 1, 2))
    assert in_order(od.page(df, order=segments)) == [2, 3, 1]
