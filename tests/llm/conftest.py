import pytest

from wordloom.llm.common import small_batches

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def frame(spark):
    """Builds documents from (id, text[, source]) rows, with extra columns that clash."""
    small_batches(spark, 3)

    def build(rows, parts=3):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows
        ]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return build


@pytest.fixture(scope="session")
def odd(frame):
    """Nulls, empty and blank texts, repeated rows and ids, a long text, accents."""
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "one"),
        (5, "A b C d e F"),
        (6, "a B c D E f"),
        (6, "a B c D E f"),
        (6, "same id, other text"),
        (None, "no id at all"),
        (None, None),
        (7, "été \x00 œuvre 😀 | # " * 40),
        (8, "long " * 30000),
    ]
