"""Ordinal regression: recovery of planted weights, gradients, held-out accuracy."""

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from wordloom.llm import grades


def test_ordered_thresholds_and_order_of_grades():
    r = np.random.default_rng(1)
    n, m = 3000, 40
    true = r.normal(size=m)
    rows = [np.sort(r.choice(m, 8, replace=False)) for _ in range(n)]
    score = np.array([true[x].sum() for x in rows]) + r.logistic(size=n) * 0.5
    y = np.digitize(score, [-1.5, 0.5, 2.0])
    flat = np.concatenate(rows).astype(np.int32)
    model = grades.fit(y, np.full(n, 8), flat, np.ones(len(flat), np.float32), 4, rounds=400)
    assert (np.diff(model.thresholds) > 0).all()
    assert np.corrcoef(model.weights[:m], true)[0, 1] > 0.97
    expected, tail = model.grades(np.array([model.weights[x].sum() for x in rows]), 2)
    assert np.corrcoef(expected, y)[0, 1] > 0.8
    assert ((tail >= 0.5) == (y >= 2)).mean() > 0.85
    assert (expected >= 0).all() and (expected <= 3).all()


def test_features():
    bins, values = grades.features("Word word. WORD!! 12 a,b\nWord")
    assert len(set(bins)) == len(bins) == len(values) and (values > 0).all()
    assert len(grades.features(None)[0]) == len(grades.features("")[0]) == 3


def test_held_out(spark, frame):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select(
        "doc_id", grades.grade().alias("grade")
    )
    fold = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4))
    model = grades.train(docs, labels.where(fold != 0), 3)
    held = labels.where(fold == 0).join(docs, "doc_id")
    got = grades.score(held, model, 2).join(labels, "doc_id").toPandas()
    right = (got.selected == (got.grade == 2)).mean()
    assert right > 0.94
    assert got[got.grade == 2].selected.mean() > 0.97
    assert got[got.grade == 0].selected.mean() < 0.25
    by_grade = got.groupby("grade").expected_grade.mean()
    assert by_grade[0] < by_grade[1] < by_grade[2]


def test_sample_bound(spark, frame):
    docs = frame([(i, f"text {i}") for i in range(50)])
    rated = spark.createDataFrame([(i, i % 3) for i in range(50)], "doc_id long, grade int")
    model = grades.train(docs, rated, 3, max_rows=10, min_rows=1, rounds=2)
    assert 0 < np.count_nonzero(model.weights) < 200


def test_odd_rows(spark, frame, odd):
    docs = frame(odd)
    none = spark.createDataFrame([(1, None), (None, 1), (77, 2)], "doc_id long, grade int")
    model = grades.train(docs, none, 3)
    got = grades.score(docs, model, 2).collect()
    assert sorted(repr(r.doc_id) for r in got) == sorted(repr(d) for d, _ in odd)
    assert all(r.expected_grade == pytest.approx(1) for r in got)
    assert grades.score(frame([]), model, 2).collect() == []


def test_grade(spark):
    rows = [(1, 0, 1), (0, 0, 2), (1, 1, 0), (0, 1, 3), (None, 0, 4), (1, None, 5)]
    df = spark.createDataFrame(rows, "quality int, toxic int, n int")
    got = {r.n: r.g for r in df.select("n", grades.grade().alias("g")).collect()}
    assert got == {1: 2, 2: 1, 0: 0, 3: 0, 4: None, 5: 2}


def test_smallest_tables(spark, frame):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = grades.train(docs, labels.select("doc_id", grades.grade().alias("grade")), 3)
    assert grades.score(docs, model, 2).count() == docs.count()


def test_the_bound_holds_with_repeated_ids(spark, frame, monkeypatch):
    docs = frame([(1, f"text {i}") for i in range(500)] + [(2, "b"), (3, "c"), (4, "d")])
    ratings = spark.createDataFrame([(1, 0), (1, 0), (2, 1), (3, 2), (4, 1)], "doc_id long, grade int")
    seen = []
    monkeypatch.setattr(grades, "fit", lambda got, *rest, **more: seen.append(len(got)))
    grades.train(docs, ratings, levels=3, max_rows=3)
    assert seen and seen[0] <= 3
