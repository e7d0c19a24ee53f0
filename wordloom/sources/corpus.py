"""A corpus is a DataFrame with an id, ordered text fields and attributes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wordloom.functions.text import words
from wordloom.sizing import join_by_term

SPREAD_BELOW_BYTES = 256 * 1024 * 1024
# A word no text can contain: it stands for "the document itself".
MARKER = ""


@dataclass(frozen=True)
class Corpus:
    """Named document collection.

    ``df`` holds the key columns (``doc_id``, and ``index_name`` for a union of
    corpora), the text fields or, once prepared, ``words`` (one word list per
    field) and ``doc_len``, and the attributes. Keys are unique. ``statistics`` are the stored
    counts per word (term, docs, words, hits) of an index.
    """

    df: DataFrame
    fields: tuple[str, ...]
    attrs: tuple[str, ...]
    name: str = "main"
    keys: tuple[str, ...] = ("doc_id",)
    prepared: bool = False
    statistics: DataFrame | None = None

    def where(self, *conditions: Column) -> "Corpus":
        """The corpus without the documents that fail a condition."""
        df = self.df
        for condition in conditions:
            df = df.where(condition)
        return replace(self, df=df)

    @property
    def documents(self) -> DataFrame:
        """Keys and attributes, without texts."""
        return self.df.select(*self.keys, *self.attrs)

    @property
    def lists(self) -> DataFrame:
        """Keys, attributes, ``words`` and ``doc_len``."""
        return prepare(self).df


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Read Parquet; an input too small for its splits is spread over the cores.

    One unsplittable file leaves all later per-document work to one task. Only an
    input whose files are shown to be below ``SPREAD_BELOW_BYTES`` in total is
    repartitioned; a large one already has many splits and is never moved.
    """
    df = spark.read.parquet(path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    size = files.agg(F.sum("length")).first()[0]
    if size is not None and size < SPREAD_BELOW_BYTES:
        return df.repartition(spark.sparkContext.defaultParallelism)
    return df


def corpus(
    df: DataFrame,
    id: str | Column,
    fields: Sequence[str],
    attrs: Sequence[str] = (),
    name: str = "main",
) -> Corpus:
    """Choose the columns of a corpus; the id becomes ``doc_id``."""
    key = (F.col(id) if isinstance(id, str) else id).cast("bigint").alias("doc_id")
    columns = [c for c in dict.fromkeys([*fields, *attrs]) if c != "doc_id"]
    return Corpus(
        df=df.select(key, *columns),
        fields=tuple(fields),
        attrs=tuple(a for a in attrs if a != "doc_id"),
        name=name,
    )


def corpora(parts: dict[str, Corpus]) -> Corpus:
    """Search several corpora as one.

    Ids are unique per corpus only, so ``index_name`` joins the key. Fields are
    matched by name; a field or attribute a corpus lacks is null there.
    """
    fields = tuple(dict.fromkeys(f for c in parts.values() for f in c.fields))
    attrs = tuple(dict.fromkeys(a for c in parts.values() for a in c.attrs))
    union: DataFrame | None = None
    for name, part in parts.items():
        named = part.df.withColumn("index_name", F.lit(name))
        union = named if union is None else union.unionByName(named, allowMissingColumns=True)
    columns = dict.fromkeys([*fields, *attrs])
    return Corpus(
        df=union.select("index_name", "doc_id", *columns),
        fields=fields,
        attrs=attrs,
        name="*",
        keys=("index_name", "doc_id"),
    )


def prepare(corpus: Corpus) -> Corpus:
    """Replace the texts by their word lists and the document length in words."""
    if corpus.prepared:
        return corpus
    lists = corpus.df.select(
        *corpus.keys,
        *corpus.attrs,
        F.array(*[words(f) for f in corpus.fields]).alias("words"),
    )
    length = sum((F.size(F.col("words")[i]) for i in range(len(corpus.fields))), F.lit(0))
    return replace(
        corpus, df=lists.withColumn("doc_len", length.cast("int")), prepared=True
    )


def save_prepared(corpus: Corpus, path: str) -> None:
    """Write the word lists once, for repeated batches over the same corpus."""
    prepare(corpus).df.write.mode("overwrite").parquet(path)


def load_prepared(spark: SparkSession, path: str, like: Corpus) -> Corpus:
    """The corpus ``like``, with its word lists read from ``path``."""
    return replace(like, df=spark.read.parquet(path), prepared=True)


def describe_corpus(corpus: Corpus) -> DataFrame:
    """Fields, then attributes: position, name, type and number of values present.

    One aggregate over the corpus, turned into one row per column.
    """
    columns = [("field", f) for f in corpus.fields] + [("attribute", a) for a in corpus.attrs]
    types = {f.name: f.dataType.simpleString() for f in corpus.df.schema.fields}
    counts = corpus.df.agg(
        *[F.count(F.col(name)).alias(f"c{i}") for i, (_, name) in enumerate(columns)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(role).alias("role"),
                F.lit(name).alias("name"),
                F.lit(types[name]).alias("type"),
                F.col(f"c{i}").alias("filled"),
            )
            for i, (role, name) in enumerate(columns)
        ]
    )
    return counts.select(F.inline(rows))


def corpus_status(corpus: Corpus) -> DataFrame:
    """Documents, words, distinct words and average length as (key, value) text rows.

    Words are first counted per word, so no task ever holds the vocabulary; the
    document totals ride along under the empty word, which no text contains.
    """
    if corpus.statistics is not None:
        marker = F.col("term") == MARKER
        totals = corpus.statistics.agg(
            F.sum(F.when(marker, F.col("docs"))).alias("documents"),
            F.coalesce(F.sum("words"), F.lit(0)).alias("tokens"),
            F.count_if(~marker).alias("terms"),
        )
    else:
        totals = _counted_totals(corpus)
    average = F.round(F.col("tokens") / F.col("documents") * 1000, 0).cast("bigint")
    pairs = {
        "documents": F.coalesce("documents", F.lit(0)),
        "tokens": F.col("tokens"),
        "distinct_terms": F.col("terms"),
        "avg_length_milli": F.coalesce(average, F.lit(0)),
    }
    rows = F.array(
        *[
            F.struct(F.lit(k).alias("key"), v.cast("string").alias("value"))
            for k, v in pairs.items()
        ]
    )
    return totals.select(F.inline(rows))


def _counted_totals(corpus: Corpus) -> DataFrame:
    """Documents, tokens and distinct terms, counted in the texts."""
    lists = corpus.lists.select("words", "doc_len")
    marked = F.concat(F.flatten("words"), F.array(F.lit(MARKER)))
    per_word = (
        lists.select("doc_len", F.explode_outer(marked).alias("term"))
        .groupBy("term")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.when(F.col("term") == MARKER, F.col("doc_len"))).alias("total"),
        )
    )
    marker = F.col("term") == MARKER
    return per_word.agg(
        F.sum(F.when(marker, F.col("n"))).alias("documents"),
        F.coalesce(F.sum("total"), F.lit(0)).alias("tokens"),
        F.count_if(~marker).alias("terms"),
    )


def term_counts(corpus: Corpus, terms: DataFrame, small: bool) -> DataFrame:
    """(term, docs, hits) of the given distinct terms, in one pass.

    Each document lists its distinct words and then all its words, so both counts
    are summed before the shuffle and no (document, term) pair is ever moved. An index has them.
    """
    if corpus.statistics is not None:
        known = corpus.statistics.select("term", "docs", "hits")
        return join_by_term(known, terms.select("term").distinct(), small, ["term"])
    flat = corpus.lists.select(*corpus.keys, F.flatten("words").alias("all_words"))
    both = flat.select(*corpus.keys, "all_words", F.array_distinct("all_words").alias("once"))
    listed = both.select(
        *corpus.keys,
        F.size("once").alias("n_once"),
        F.posexplode_outer(F.concat("once", "all_words")).alias("i", "term"),
    )
    joined = join_by_term(listed, terms.select("term").distinct(), small, list(corpus.keys))
    return joined.groupBy("term").agg(
        F.count_if(F.col("i") < F.col("n_once")).alias("docs"),
        F.count_if(F.col("i") >= F.col("n_once")).alias("hits"),
    )
