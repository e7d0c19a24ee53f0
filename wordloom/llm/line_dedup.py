"""Removal of repeated runs of lines, by winnowing over line hashes.

A document is the sequence of its lines that are not blank, hashed without the blanks around
them. Every ``GRAM`` neighbouring hashes give a gram; of every window that spans ``min_run``
lines the smallest gram is selected. A run of ``min_run`` lines that occurs twice selects the
same gram in both places, so every such run is found from the selected grams alone. Only
grams selected twice or more are followed up: their positions are joined, and each is extended
to the runs on either side that it was selected for. With ``min_words`` a repeated run of fewer
lines counts too if it holds that many words: every such run is its own gram. Of equal runs the first one stays (by
``doc_id``, then text, then line); every later one is deleted, and runs that overlap or touch
are one longer deleted run. A blank line between two deleted lines goes with them.

A line that a third of the corpus shares is only ever a hot key of counts, which are combined
before the shuffle, or of a join whose other side holds one row, which Spark can split.

Rows: a null text stays null and has no lines; rows equal in id and text are one document and
share its result; a null ``doc_id`` is first in the order; an empty table gives no row; other
columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from wordloom.llm.common import stored, table, utf8

MIN_RUN = 3
GRAM = 2

LINES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("key", pa.binary()),
        ("gram", pa.int64()),
        ("lines", pa.int32()),
        ("starts", pa.list_(pa.int32())),
        ("runs", pa.list_(pa.binary())),
    ]
)


def key(text: str = "text") -> F.Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def select(hashes: np.ndarray, min_run: int) -> Iterator[tuple[int, np.ndarray]]:
    """Selected grams, and for each the starts of the runs that selected it."""
    width = min(GRAM, min_run)
    starts = len(hashes) - min_run + 1
    if starts <= 0:
        return
    grams = [
        xxhash.xxh3_64_intdigest(hashes[i : i + width].tobytes())
        for i in range(len(hashes) - width + 1)
    ]
    grams = np.array(grams, np.uint64)
    windows = np.lib.stride_tricks.sliding_window_view(grams, min_run - width + 1)
    chosen = np.arange(starts) + windows.argmin(axis=1)
    for place in np.unique(chosen):
        yield int(grams[place].view(np.int64)), np.flatnonzero(chosen == place)


def wordy(
    hashes: np.ndarray, words: np.ndarray, min_run: int, min_words: int
) -> Iterator[tuple[int, int, np.ndarray]]:
    """Runs of fewer than ``min_run`` lines with ``min_words`` words or more: a gram of their
    own, their lines and their start."""
    reach = np.r_[0, np.cumsum(words)]
    for width in range(1, min(min_run - 1, len(hashes)) + 1):
        for start in np.flatnonzero(reach[width:] - reach[:-width] >= min_words):
            gram = xxhash.xxh3_64_intdigest(hashes[start : start + width].tobytes(), seed=width)
            yield int(np.uint64(gram).view(np.int64)), width, np.array([start])


def fingerprints(docs: DataFrame, min_run: int, min_words: int | None = None) -> DataFrame:
    """A row per document and selected gram, with the runs it was selected for and how many
    lines they have."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, name, text in zip(
                batch.column("doc_id").to_pylist(),
                batch.column("key").to_pylist(),
                utf8(batch.column("text")),
            ):
                lines = [x for x in map(bytes.strip, text.split(b"\n")) if x]
                hashes = np.array([xxhash.xxh3_64_intdigest(x) for x in lines], np.uint64)
                found = [(gram, min_run, starts) for gram, starts in select(hashes, min_run)]
                if min_words is not None:
                    words = np.array([len(x.split()) for x in lines], np.int64)
                    found += wordy(hashes, words, min_run, min_words)
                for gram, n, starts in found:
                    runs = [xxhash.xxh3_128_digest(hashes[s : s + n].tobytes()) for s in starts]
                    rows.append((doc_id, name, gram, n, starts, runs))
            columns = zip(*rows) if rows else [[]] * len(LINES)
            yield table(LINES, **dict(zip(LINES.names, map(list, columns))))

    return docs.select("doc_id", key().alias("key"), "text").mapInArrow(
        each,
        "doc_id long, key binary, gram long, lines int, starts array<int>, runs array<binary>",
    )


def repeated_runs(
    docs: DataFrame, min_run: int = MIN_RUN, min_words: int | None = None
) -> DataFrame:
    """``doc_id, key, spans``: where later copies of runs begin and how many lines they have,
    by lines that are not blank, for the documents that have any."""
    every = stored(fingerprints(docs, min_run, min_words), "line-grams")
    often = every.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    # A gram selected twice in one text gives a row each, so n counts places.
    followed = every.join(often, "gram").select(
        "doc_id", "key", "lines", F.explode(F.arrays_zip("starts", "runs")).alias("r")
    )
    # Rows equal in id and text are one document.
    placed = followed.select(
        F.col("r.runs").alias("run"), "doc_id", "key", F.col("r.starts").alias("start"), "lines"
    ).distinct()
    first = placed.groupBy("run").agg(
        F.min(F.struct("doc_id", "key", "start")).alias("first"), F.count(F.lit(1)).alias("n")
    )
    first = first.where("n > 1").select("run", "first")
    own = F.struct("doc_id", "key", "start")
    later = placed.join(first, "run").where(~own.eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "key").agg(
        F.collect_set(F.struct("start", "lines")).alias("spans")
    )


def without(text: str, spans: list[dict]) -> tuple[str, int]:
    """``text`` without the runs at ``spans``, and how many lines went."""
    lines = text.split("\n")
    full = [i for i, x in enumerate(lines) if x.encode().strip()]
    gone = np.zeros(len(full), bool)
    for span in spans:
        gone[span["start"] : span["start"] + span["lines"]] = True
    drop = {full[i] for i in np.flatnonzero(gone)}
    for i in np.flatnonzero(gone[1:] & gone[:-1]):
        drop.update(range(full[i], full[i + 1]))
    return "\n".join(x for i, x in enumerate(lines) if i not in drop), int(gone.sum())


def dedup_lines(
    docs: DataFrame,
    min_run: int = MIN_RUN,
    min_words: int | None = None,
    count: str = "n_deleted",
) -> DataFrame:
    """``docs`` with later repeated runs taken out of ``text``, and the number of deleted lines
    that were not blank as ``count``, in place of a column of that name. A run has ``min_run``
    lines, or fewer that hold ``min_words`` words together."""

    @F.arrow_udf("text string, n long")
    def shorten(text: pa.Array, spans: pa.Array) -> pa.Array:
        rows = [
            (t, 0) if s is None or t is None else without(t, s)
            for t, s in zip(text.to_pylist(), spans.to_pylist())
        ]
        texts, counts = zip(*rows) if rows else ([], [])
        return pa.StructArray.from_arrays(
            [pa.array(texts, pa.string()), pa.array(counts, pa.int64())], ["text", "n"]
        )

    later = repeated_runs(docs, min_run, min_words).withColumnsRenamed(
        {"doc_id": "of_id", "key": "of_key"}
    )
    # The row travels as one column, whatever names its own columns have.
    row = F.struct("*").alias("row")
    wide = docs.select(row, F.col("doc_id").alias("id"), key(docs["text"]).alias("key"))
    same = wide["id"].eqNullSafe(later["of_id"]) & (wide["key"] == later["of_key"])
    met = wide.join(later, same, "left").withColumn("cut", shorten("row.text", "spans"))
    columns = [
        F.col("cut.text").alias("text") if c == "text" else F.col(f"row.`{c}`")
        for c in docs.columns
        if c != count
    ]
    return met.select(*columns, F.col("cut.n").alias(count))


#: The digest of ``dedup_lines`` by lines alone in DuckDB SQL, over documents with unique ids.
ORACLE = r"""
WITH raw AS (
  SELECT doc_id, i, lines[i] AS line,
    regexp_replace(lines[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS body
  FROM (
    SELECT doc_id, string_split(text, chr(10)) AS lines,
      unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
    FROM documents
  )
), full_lines AS (
  SELECT doc_id, i, body, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
  FROM raw WHERE body <> ''
), runs AS (
  SELECT doc_id, k, body AS a, lead(body, 1) OVER w AS b, lead(body, 2) OVER w AS c
  FROM full_lines WINDOW w AS (PARTITION BY doc_id ORDER BY k)
), later AS (
  SELECT doc_id, k FROM runs WHERE c IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, k) > 1
), gone AS (
  SELECT DISTINCT doc_id, k + unnest([0, 1, 2]) AS k FROM later
), marked AS (
  SELECT raw.doc_id, raw.i, raw.line,
    CASE WHEN f.k IS NOT NULL THEN g.k IS NOT NULL END AS dropped
  FROM raw LEFT JOIN full_lines f ON f.doc_id = raw.doc_id AND f.i = raw.i
    LEFT JOIN gone g ON g.doc_id = f.doc_id AND g.k = f.k
), settled AS (
  SELECT doc_id, i, line, dropped, coalesce(dropped,
    last_value(dropped IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i)
    AND first_value(dropped IGNORE NULLS) OVER (
      PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
    false) AS away
  FROM marked
)
SELECT doc_id, count(*) FILTER (WHERE dropped)::BIGINT AS n_deleted,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT away), '')) AS kept_sha256
FROM settled GROUP BY doc_id
"""
