"""Quality rules with cross-document line frequency, in DataFrame functions only.

Base figures of a document come from its own text. Then every line is normalised (blanks to
one space, trimmed, lower case) and hashed, and the distinct documents of a host that hold it
are counted. Copies of a text on a host are one document. A line in more than ``max_documents`` documents and in more than
``max_share`` of the documents of its host is boilerplate. A document is rejected when it
fails a base rule, or when fewer than ``min_left`` of its words stand outside boilerplate.

Copies are combined before lines are counted, so that what moves are the distinct texts'
line hashes; a frequent line is combined before each shuffle.

Rows: a null text has no words and fails; a null host is one host, like the empty name;
repeated rows get a verdict each; an empty table gives no row; ``key`` ties rows of one
content, so a null ``doc_id`` does no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wordloom.llm.common import stored

BLANK = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"
WINDOW = 8

FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    parts = F.split(text, BLANK + "+")
    return F.filter(parts, lambda part: part != "")


def repeated_words(word: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words that the list holds twice or more.

    Window hashes are sorted with their places; those equal to a neighbour give the places of
    repeated windows, and each place covers words up to the next place at most.
    """

    def count(places: Column) -> Column:
        reach = F.transform(
            places,
            lambda at, i: F.least(
                F.coalesce(F.get(places, i + 1) - at, F.lit(window)), F.lit(window)
            ),
        )
        return F.aggregate(reach, F.lit(0), lambda total, n: total + n)

    def places(hashes: Column) -> Column:
        rows = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(
            rows,
            lambda s: F.filter(
                s,
                lambda x, i: (x["h"] == F.get(s, i - 1)["h"])
                | (x["h"] == F.get(s, i + 1)["h"]),
            ),
        )
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def from_hashes(hashes: Column) -> Column:
        # Most texts repeat no window: a hash set tells, and nothing is sorted.
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(
            let(places(hashes), count)
        )

    starts = F.sequence(F.lit(1), F.size(word) - (window - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(word, i, window)))
    return F.when(F.size(word) <= window, 0).otherwise(let(hashes, from_hashes)).cast("long")


def normalised(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, BLANK + "+", " ")))


def figures(docs: DataFrame) -> DataFrame:
    """One narrow row per document: its base figures, and per line a hash and its words."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    plain = F.regexp_replace(text, BLANK + "+", "")

    def of_lines(own: Column) -> Column:
        distinct = F.size(F.array_distinct(own))
        normal = F.transform(own, normalised)
        each = lambda n: F.transform(
            n,
            lambda x: F.struct(
                F.xxhash64(x).alias("line"),
                (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("words"),
            ),
        )
        return let(
            normal,
            lambda n: F.struct(
                (F.size(n) - distinct).cast("long").alias("n_dup_lines"),
                each(n).alias("lines"),
            ),
        )

    def of_words(own: Column) -> Column:
        return F.struct(
            F.size(own).cast("long").alias("n_words"),
            repeated_words(own).alias("n_repeat_words"),
        )

    rows = docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("host"),
        F.unhex(F.md5(text)).alias("key"),
        let(words(text), of_words).alias("w"),
        let(lines, of_lines).alias("l"),
        F.length(plain).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
    )
    return rows.select(
        "doc_id", "host", "key", "w.*", "l.*", "word_chars", "n_symbols"
    )


def boilerplate(rows: DataFrame, max_documents: int, max_share: float) -> DataFrame:
    """``host, line`` of lines above both limits. ``rows``: one per distinct text."""
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("documents"))
    lines = F.array_distinct("lines.line")
    held = rows.select("host", F.explode(lines).alias("line"))
    seen = held.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    often = seen.where(F.col("n") > max_documents)
    return often.join(hosts, "host").where(
        F.col("n") > F.col("documents") * F.lit(max_share)
    ).select("host", "line")


def quality(
    docs: DataFrame,
    min_words: int = 20,
    max_repeat: int = 30,
    max_documents: int = 10,
    max_share: float = 0.005,
    min_left: float = 0.3,
) -> DataFrame:
    """``doc_id, host, key``, the base figures, ``n_left`` (words outside boilerplate),
    ``base_failed`` and ``kept`` for every document."""
    rows = stored(figures(docs), "figures")
    texts = rows.groupBy("host", "key").agg(F.any_value("lines").alias("lines"))
    texts = stored(texts, "line-hashes")
    often = boilerplate(texts, max_documents, max_share)
    each = texts.select("host", "key", F.inline("lines"))
    removed = each.join(often, ["host", "line"]).groupBy("host", "key").agg(
        F.sum("words").alias("removed")
    )
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat * F.col("n_words")
    )
    left = F.col("n_words") - F.coalesce("removed", F.lit(0))
    return rows.join(removed, ["host", "key"], "left").select(
        "doc_id",
        "host",
        "key",
        *FIGURES,
        left.cast("long").alias("n_left"),
        failed.alias("base_failed"),
        (~failed & (left >= F.col("n_words") * F.lit(min_left))).alias("kept"),
    )


def screen(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with their own columns."""
    verdict = quality(docs, **limits)
    gone = verdict.where(~F.col("kept")).select("host", "key").distinct()
    # The row travels as one column, whatever names its own columns have.
    wide = docs.select(
        F.struct("*").alias("row"),
        F.coalesce("source", F.lit("")).alias("host"),
        F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("key"),
    )
    return wide.join(gone, ["host", "key"], "left_anti").select("row.*")


#: ``quality`` with its default limits in DuckDB SQL, over documents with unique ids.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), windows AS (
  SELECT doc_id, p, array_to_string(w[p:p + 7], ' ') AS body
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS p FROM d)
), twice AS (
  SELECT doc_id, p FROM windows
  QUALIFY count(*) OVER (PARTITION BY doc_id, body) > 1
), spans AS (
  SELECT doc_id, least(8, coalesce(lead(p) OVER (PARTITION BY doc_id ORDER BY p) - p, 8)) AS n
  FROM twice
), repeats AS (
  SELECT doc_id, sum(n)::BIGINT AS n_repeat_words FROM spans GROUP BY doc_id
), raw_lines AS (
  SELECT doc_id, host, md5(text) AS copy, unnest(string_split(text, chr(10))) AS raw FROM d
), lines AS (
  SELECT doc_id, host, copy, raw,
    lower(trim(regexp_replace(raw, '[\x20\x09-\x0D]+', ' ', 'g'))) AS line
  FROM raw_lines WHERE regexp_matches(raw, '[^\x20\x09-\x0D]')
), dups AS (
  SELECT doc_id, count(*) - count(DISTINCT raw) AS n_dup_lines FROM lines GROUP BY doc_id
), hosts AS (
  SELECT host, count(DISTINCT text) AS documents FROM d GROUP BY host
), often AS (
  SELECT lines.host, line FROM lines JOIN hosts ON hosts.host = lines.host
  GROUP BY lines.host, line, documents
  HAVING count(DISTINCT copy) > 10 AND count(DISTINCT copy) > documents * 0.005
), removed AS (
  SELECT doc_id, sum(len(regexp_extract_all(line, '[^ ]+')))::BIGINT AS removed
  FROM lines JOIN often USING (host, line) GROUP BY doc_id
), figures AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    (len(w) - coalesce(removed, 0))::BIGINT AS n_left
  FROM d LEFT JOIN dups USING (doc_id) LEFT JOIN repeats USING (doc_id)
    LEFT JOIN removed USING (doc_id)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM figures
)
SELECT *, NOT base_failed AND n_left >= n_words * 0.3 AS kept FROM judged
"""
