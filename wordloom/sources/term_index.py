"""A stored index of words: which documents hold a word, and where.

Three tables under one folder:

* ``documents``: keys, attributes, ``doc_len``, the length of each field, and the document's
  ``block`` (below), one row per document;
* ``peaks``: one row per word and block that holds it: its documents, its occurrences, the largest
  BM25 share it gives to any of them and, as arrays beside each other, its postings there: keys and
  length of each document, the word's places (``slots``), the word before each and, in a corpus of
  several fields, their fields; in folders by ``bucket`` of the word. A search opens the buckets of
  its words only, and reads of the arrays what it needs;
* ``statistics``: documents and occurrences of each word, and of the whole corpus under the
  marker word, in the same buckets, so that BM25 and word statistics read no postings.

A block is a slice of documents of about the same length. Documents are dealt by block before
their words are listed, so that only their words, once, are moved: a task makes all rows of its
blocks and writes them, bucket after bucket.

A ``TermIndex`` is a corpus without texts: every match mode and ranker takes it in place of one
and gives the same rows. ``postings`` has one row per word and document, ``peaks`` serves
``operators.best_blocks``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wordloom.sources.corpus import MARKER, Corpus, prepare
from wordloom.storage import deleted, with_settings

BUCKETS = 64
BLOCK_DOCUMENTS = 256
# Words whose postings a task of the build sorts, about; and those that make a task worth while.
TASK_WORDS = 2_000_000
LEAST_WORDS = 200_000
K1 = 1.2
B = 0.75


@dataclass(frozen=True)
class TermIndex(Corpus):
    """See above; ``df`` is the documents table."""

    peaks: DataFrame | None = None
    buckets: int = BUCKETS

    @property
    def postings(self) -> DataFrame:
        """One row per word and document: bucket, term, block, and what ``_listed`` names."""
        return unlisted(self.peaks, self, ["bucket", "term", "block"])

    @property
    def lists(self) -> DataFrame:
        raise ValueError("an index has no texts")

    def opened(self, terms: DataFrame) -> "TermIndex":
        """The index with only the buckets of ``terms`` (a ``term`` column), and the marker's.
        At most as many numbers as there are buckets come to the driver."""
        marker = self.df.sparkSession.range(1).select(F.lit(MARKER).alias("term"))
        wanted = terms.select("term").union(marker).select(_bucket(self.buckets)).distinct()
        open_to = F.col("bucket").isin(sorted(row[0] for row in wanted.collect()))
        return replace(
            self,
            statistics=self.statistics.where(open_to),
            peaks=self.peaks.where(open_to),
        )

    def positions(self, carry: Sequence[str], marker: bool, previous: bool) -> DataFrame:
        """The word table, from the postings: see ``tokens.positions``."""
        one = len(self.fields) == 1
        beside = ["doc_len"] if one else ["doc_len", "field_lens", "field_nos"]
        if previous:
            beside.append("previous")
        each = self.postings.select(
            *self.keys, *beside, "term", F.posexplode("slots").alias("slot", "pos")
        )
        no = F.lit(0) if one else F.get("field_nos", F.col("slot"))
        rows = each.select(
            *self.keys,
            "doc_len",
            no.alias("field_no"),
            (F.col("doc_len") if one else F.get("field_lens", no)).alias("field_len"),
            "pos",
            "term",
            *([F.get("previous", F.col("slot")).alias("previous")] if previous else []),
        )
        if marker:
            first = F.get("field_lens", F.lit(0))
            rows = rows.union(
                self.df.select(
                    *self.keys,
                    "doc_len",
                    F.lit(0).alias("field_no"),
                    first.alias("field_len"),
                    first.alias("pos"),
                    F.lit(MARKER).alias("term"),
                    *([F.lit(None).cast("string").alias("previous")] if previous else []),
                )
            )
        return self._carrying(rows, carry)

    def field_counts(self, carry: Sequence[str], marker: bool) -> DataFrame:
        """Each word of each field once, counted: see ``tokens.field_counts``."""
        kept = [*self.keys, "doc_len"]
        if len(self.fields) == 1:
            rows = self.postings.select(
                *kept, F.lit(0).alias("field_no"), "term", F.size("slots").alias("n")
            )
        else:
            counts = F.transform(
                F.sequence(F.lit(0), F.lit(len(self.fields) - 1)),
                lambda i: F.size(F.filter("field_nos", lambda x: x == i)),
            )
            rows = self.postings.select(
                *kept, "term", F.posexplode(counts).alias("field_no", "n")
            ).where("n > 0").select(*kept, "field_no", "term", "n")
        if marker:
            marks = [F.lit(0).alias("field_no"), F.lit(MARKER).alias("term"), F.lit(1).alias("n")]
            rows = rows.union(self.df.select(*kept, *marks))
        return self._carrying(rows, carry)

    def doc_terms(self, carry: Sequence[str], marker: bool) -> DataFrame:
        """Each word of each document once: see ``tokens.doc_terms``."""
        rows = self.postings.select(*self.keys, "doc_len", "term")
        if marker:
            rows = rows.union(self.df.select(*self.keys, "doc_len", F.lit(MARKER).alias("term")))
        return self._carrying(rows, carry)

    def _carrying(self, rows: DataFrame, carry: Sequence[str]) -> DataFrame:
        if not carry:
            return rows
        return rows.join(self.df.select(*self.keys, *carry), list(self.keys))


def _listed(corpus: Corpus) -> dict[str, str]:
    """Columns of a posting and their types, in the order of the arrays that hold them."""
    kinds = {k: corpus.df.schema[k].dataType.simpleString() for k in corpus.keys}
    kinds |= {"doc_len": "int", "slots": "array<int>", "previous": "array<string>"}
    if len(corpus.fields) > 1:
        kinds |= {"field_lens": "array<int>", "field_nos": "array<int>"}
    return kinds


def unlisted(rows: DataFrame, corpus: Corpus, kept: Sequence[str]) -> DataFrame:
    """The postings of rows of ``peaks``, one by one, with the columns ``kept``."""
    first, *others = _listed(corpus)
    each = rows.select(*kept, *others, F.posexplode(first).alias("__at", first))
    return each.select(*kept, first, *[F.get(c, F.col("__at")).alias(c) for c in others])


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int").alias("bucket")


def _slots(corpus: Corpus) -> DataFrame:
    """One row per document and distinct word: its places in order.

    A document's words are sorted in their row and cut where the word changes, so no word row
    is made or moved.
    """

    def spots(listed: Column, field: Column) -> Column:
        n = F.size(listed)
        return F.arrays_zip(
            listed.alias("term"),
            F.array_repeat(field, n).alias("field_no"),
            F.slice(F.sequence(F.lit(0), n), F.lit(1), n).alias("pos"),
            F.slice(F.concat(F.array(F.lit(None).cast("string")), listed), F.lit(1), n).alias("previous"),
        )

    names = "array<struct<term: string, field_no: int, pos: int, previous: string>>"
    several = len(corpus.fields) > 1
    if several:
        each = F.flatten(F.transform("words", spots))
    else:
        each = spots(F.col("words")[0], F.lit(0))
    sorted_spots = corpus.df.select(
        *corpus.keys,
        "doc_len",
        "field_lens",
        "block",
        # Not array_sort, which compares by an expression.
        F.sort_array(each.cast(names)).alias("spots"),
    )
    places = F.sequence(F.lit(0), F.size("spots") - 1)
    changes = F.filter(
        places, lambda i: (i == 0) | (F.get("spots", i)["term"] != F.get("spots", i - 1)["term"])
    )
    starts = F.when(F.size("spots") > 0, changes).otherwise(F.array().cast("array<int>"))
    begun = sorted_spots.withColumn("starts", starts)
    end = lambda j: F.coalesce(F.get("starts", j + 1), F.size("spots"))

    def word(s: Column, j: Column) -> Column:
        own = F.slice("spots", s + 1, end(j) - s)
        places = [own["pos"].alias("slots"), own["previous"].alias("previous")]
        if several:
            places.append(own["field_no"].alias("field_nos"))
        return F.struct(F.get("spots", s)["term"].alias("term"), *places)

    kept = [*corpus.keys, "doc_len", *(["field_lens"] if several else []), "block"]
    words = F.explode(F.transform("starts", word)).alias("word")
    return begun.select(*kept, words).select(*kept, "word.*")


def _length_class(length: Column) -> Column:
    """Eight classes to each doubling of the length, some hundreds in all."""
    return F.floor(F.log2(F.greatest(length, F.lit(1))) * 8).cast("int")


def _block(documents: DataFrame, keys: Iterable[str]) -> Column:
    """The length class and a slice of it, of about ``BLOCK_DOCUMENTS``. The sizes of the classes
    come to the driver."""
    length = _length_class(F.col("doc_len"))
    counts = documents.groupBy(length).agg(F.count(F.lit(1)))
    slices: Column = F.lit(1)
    if sizes := dict(map(tuple, counts.collect())):
        pairs = [F.lit(x) for c, n in sizes.items() for x in (c, -(-n // BLOCK_DOCUMENTS))]
        slices = F.element_at(F.create_map(*pairs), length)
    part = F.pmod(F.xxhash64(*keys), slices)
    return F.shiftleft(length.cast("bigint"), 40) + part


def save_index(corpus: Corpus, path: str, buckets: int = BUCKETS) -> None:
    """Write the index of a corpus to an empty folder. The texts are split twice, for the lengths
    that make the blocks and for the postings: keeping the words of the first time would take as
    much disk as the texts."""
    with with_settings(corpus.df.sparkSession, BUILD):
        _save_documents(corpus, path)
        _save_peaks(corpus, path, buckets)
        _save_statistics(corpus, path, buckets)


# Rows are sorted into their groups and so written as they come, not hashed first; shuffle files
# go with the step that they were made for.
BUILD = {
    "spark.sql.execution.useObjectHashAggregateExec": "false",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def _lists(corpus: Corpus) -> DataFrame:
    """The documents with ``field_lens``, and in ``words`` those of a field joined by spaces."""
    lens = F.transform("words", lambda x: F.size(x))
    joined = F.transform("words", lambda x: F.array_join(x, " "))
    return prepare(corpus).df.withColumns({"field_lens": lens, "words": joined})


def _save_documents(corpus: Corpus, path: str) -> None:
    spark = corpus.df.sparkSession
    lengths = _lists(corpus).drop("words")
    lengths.write.mode("error").parquet(f"{path}/lengths")
    lengths = spark.read.schema(lengths.schema).parquet(f"{path}/lengths")
    documents = lengths.withColumn("block", _block(lengths, corpus.keys))
    documents.write.mode("error").parquet(f"{path}/documents")
    deleted(spark, f"{path}/lengths")


def _save_peaks(corpus: Corpus, path: str, buckets: int) -> None:
    documents = corpus.df.sparkSession.read.parquet(f"{path}/documents")
    n, words = documents.agg(F.count(F.lit(1)), F.coalesce(F.sum("doc_len"), F.lit(0))).first()
    lists = _lists(corpus).select(*corpus.keys, "doc_len", "field_lens", "words")
    lists = lists.withColumn("block", _block(documents, corpus.keys))
    # By block first, so that all that is grouped by block and word later stays in its task.
    lists = lists.repartition(_tasks(documents.sparkSession, words), "block")
    none = F.array().cast("array<string>")
    split = F.transform("words", lambda x: F.when(x == "", none).otherwise(F.split(x, " ")))
    rows = _slots(replace(corpus, df=lists.withColumn("words", split), prepared=True))
    # All of a word's share in a document that depends on the document.
    tf = F.size("slots").cast("double")
    average = F.lit(words / n if n else 0.0)
    peak = F.max(tf / (tf + K1 * (1 - B + B * F.col("doc_len") / average)))
    posting = F.struct(*_listed(corpus))
    peaks = rows.withColumn("bucket", _bucket(buckets)).groupBy("bucket", "block", "term").agg(
        peak.alias("peak"),
        F.count(F.lit(1)).alias("docs"),
        F.sum(F.size("slots")).alias("hits"),
        F.collect_list(posting).alias("listed"),
    )
    kept = ["term", "block", "peak", "docs", "hits"]
    arrays = [F.col("listed")[c].alias(c) for c in _listed(corpus)]
    _by_bucket(peaks.select(*kept, *arrays, "bucket"), f"{path}/peaks")


def _tasks(spark: SparkSession, words: int) -> int:
    cores = spark.sparkContext.defaultParallelism
    return max(1, min(cores, words // LEAST_WORDS), -(-words // TASK_WORDS))


def _save_statistics(corpus: Corpus, path: str, buckets: int) -> None:
    """A word's counts are those of its blocks: no posting is read."""
    spark = corpus.df.sparkSession
    blocks = "term string, docs long, hits long, bucket int"
    counts = spark.read.schema(blocks).parquet(f"{path}/peaks").groupBy("bucket", "term").agg(
        F.sum("docs").alias("docs"),
        F.lit(None).cast("bigint").alias("words"),
        F.sum("hits").alias("hits"),
    )
    documents = spark.read.parquet(f"{path}/documents")
    found = documents.agg(F.count(F.lit(1)), F.coalesce(F.sum("doc_len"), F.lit(0))).first()
    columns = "term string, docs long, words long, hits long"
    sums = spark.createDataFrame([(MARKER, *found, 0)], columns)
    sums = sums.withColumn("bucket", _bucket(buckets))
    # A corpus of no documents has no totals, as when texts are counted.
    counts = counts.unionByName(sums.where("docs > 0"))
    _by_bucket(counts.hint("rebalance", "bucket"), f"{path}/statistics")


def _by_bucket(df: DataFrame, path: str) -> None:
    """Write in folders by bucket."""
    ordered = df.sortWithinPartitions("bucket").write.mode("error").option("compression", "zstd")
    ordered.partitionBy("bucket").parquet(path)


def load_index(
    spark: SparkSession, path: str, like: Corpus, buckets: int = BUCKETS
) -> TermIndex:
    """The index of the corpus ``like`` that ``save_index`` wrote to ``path``."""
    counts = "term string, docs long, words long, hits long, bucket int"
    arrays = ", ".join(f"`{c}` array<{kind}>" for c, kind in _listed(like).items())
    peaks = f"term string, block long, peak double, docs long, hits long, {arrays}, bucket int"
    return TermIndex(
        df=spark.read.parquet(f"{path}/documents"),
        fields=like.fields,
        attrs=like.attrs,
        name=like.name,
        keys=like.keys,
        prepared=True,
        statistics=spark.read.schema(counts).parquet(f"{path}/statistics"),
        peaks=spark.read.schema(peaks).parquet(f"{path}/peaks"),
        buckets=buckets,
    )
