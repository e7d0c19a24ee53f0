"""The pipeline's stages, and every registered query of the package against its SQL."""

from pathlib import Path

import duckdb
import pytest
from compare import rows_of
from conftest import SF
from pyspark.sql import functions as F

import corpus_pipeline
from wordloom.llm.common import stored
from wordloom.llm.entries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, frame, name):
    df = QUERIES[name](spark, SF)
    mine = rows_of(df.columns, df.collect())
    assert mine
    if name in ORACLE:
        db = duckdb.connect()
        for path in Path(SF).glob("*.parquet"):
            db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
        cursor = db.execute(ORACLE[name])
        columns = [d[0] for d in cursor.description]
        assert sorted(columns) == sorted(df.columns)
        assert mine == rows_of(columns, cursor.fetchall())


def test_stages(spark, frame):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, before, SF), name)
        assert after.columns == docs.columns
        ids = [r.doc_id for r in after.select("doc_id").collect()]
        assert ids and len(set(ids)) == len(ids)
        assert set(ids) <= {r.doc_id for r in before.select("doc_id").collect()}
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF).collect()
    assert {r.doc_id for r in packed} == set(ids)
    whole = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.piece, r.length) for r in whole) == sorted(
        (r.doc_id, r.piece, r.length) for r in packed
    )


def test_planted(spark, frame, tmp_path):
    """Near copies leave one, contaminated and poor documents go, clean ones stay."""
    words = lambda k, n: " ".join(f"w{k}x{i}" for i in range(n))
    item = "the quick brown fox jumps over one lazy dog and then sleeps"
    rows = [(i, words(i, 60)) for i in range(20)]
    rows += [(100 + i, words(3, 200) + (" end" if i else "")) for i in range(3)]
    rows += [(200, words(50, 40) + " " + item.upper()), (300, "few words"), (301, None), (302, "")]
    rows += [(400, "\n".join(words(60 + i, 9) for i in range(6)))]
    rows += [(401, "\n".join(words(60 + i, 9) for i in range(6)))]
    frame(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    kept = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert kept == {*range(20), 100, 400}


def test_decontamination_by_text(spark, frame, tmp_path):
    """A clean text that shares its id, or a null, with a contaminated one stays."""
    item = "the quick brown fox jumps over one lazy dog and then sleeps"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    rows = [(1, "clean a"), (1, f"x {item}"), (None, "clean b"), (None, f"y {item}"), (2, None)]
    kept = corpus_pipeline.decontamination(spark, frame(rows), str(tmp_path))
    assert kept.columns == frame(rows).columns
    assert {(r.doc_id, r.text) for r in kept.collect()} == {(1, "clean a"), (None, "clean b"), (2, None)}


def test_empty(spark, frame, tmp_path):
    frame([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_odd_rows(spark, frame, odd):
    """Each stage by itself on nulls, empty texts and repeated rows."""
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame(odd), SF).columns
        stage(spark, frame(odd), SF).collect()


CLASHES = ["n_deleted", "_key", "_host", "_own", "_id", "_cut", "_spans", "_content", "key", "host"]
CLASHES += ["id", "own", "row", "cut", "spans", "content", "count", "line", "root", "print", "of_id"]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_clashing_columns_are_kept(spark, frame, name, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(80)
    plain = {r["doc_id"]: r["text"] for r in stage(spark, docs, SF).collect()}
    wide = docs
    for clash in CLASHES:
        wide = wide.withColumn(clash, F.concat(F.lit(clash), F.col("doc_id").cast("string")))
    kept = stage(spark, wide, SF)
    assert kept.columns == wide.columns
    rows = kept.collect()
    assert {r["doc_id"]: r["text"] for r in rows} == plain and rows
    for r in rows:
        assert all(r[clash] == f"{clash}{r['doc_id']}" for clash in CLASHES)
