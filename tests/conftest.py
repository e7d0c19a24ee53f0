import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from wordloom.session import session  # noqa: E402
from wordloom.sources import corpus, query_batch  # noqa: E402

SF = "/root/testdata/sf0.001"

# doc_id, title, body, group_id: an empty body, a null body, a text equal to a query, a
# repeated word, two equal documents, accents.
DOCS = [
    (1, "Empty", "", 10),
    (2, "No body", None, 10),
    (3, "red fox", "red fox", 20),
    (4, "The fox", "The fox, the FOX; the red dog and the red fox", 20),
    (5, "Équipe", "été à l'école 2024 red", 30),
    (6, "Équipe", "été à l'école 2024 red", None),
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def docs(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, title string, body string, group_id long")
    return corpus(df, "doc_id", ["title", "body"], ["group_id"])


@pytest.fixture()
def batch(spark):
    def make(*texts):
        rows = [(i + 1, text) for i, text in enumerate(texts)]
        return query_batch(spark.createDataFrame(rows, "query_id long, text string"))

    return make


@pytest.fixture()
def pairs():
    """Rows of a DataFrame as a set of (query_id, doc_id)."""

    def collect(df):
        rows = [(r["query_id"], r["doc_id"]) for r in df.collect()]
        assert len(rows) == len(set(rows))
        return set(rows)

    return collect
