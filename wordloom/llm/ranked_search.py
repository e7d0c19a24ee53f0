"""Ranked lexical search on an index in strata of documents of equal length.

The score of a term depends on the document only by its normaliser m, a whole number that grows
with its length, and by tf, the term's occurrences. The index therefore groups documents by m
and a term's documents by tf within m: an impact is computed once for all documents of one
term, m and tf. Strata are laid out in shards of bounded size, small neighbours together, a
large one in several slices; a shard is one group of rows, ``term`` by ``term``, and one row
without a term that lists its documents in the order of m.

A search takes each stratum's largest tf of each term as the bound of what its documents can
score. First every item visits the ``k`` strata with the highest bounds; the k-th best score
found there is beaten or equalled only in strata whose bound reaches it, and only those are
visited then. Results are exact. Items come in blocks of bounded size, each a pass over the
index.

Null and empty texts have no terms: as items they find nothing, as documents they are never
found. Rows count as they stand: repeated documents and ids are ranked each, repeated items are
answered each; documents without an id rank last among equals. Other columns stay behind. Empty
tables give no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wordloom.llm.common import best, new_folder, stored, table
from wordloom.sizing import hint, measure

SHARD_BYTES = 8 << 20
#: What a document takes in a shard besides its terms.
DOCUMENT_BYTES = 64
ITEM_BYTES = 32 << 20
CELLS = 4 << 20

_DOCS = pa.schema(
    [
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("terms", pa.binary()),
        ("tfs", pa.binary()),
    ]
)
_DOCS_SQL = "row long, doc_id long, n long, terms binary, tfs binary"
_ENTRIES = pa.schema(
    [
        ("shard", pa.int64()),
        ("term", pa.string()),
        ("docs", pa.list_(pa.int32())),
        ("tfs", pa.list_(pa.int64())),
        ("strata", pa.list_(pa.int64())),
        ("peaks", pa.list_(pa.int64())),
        ("ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
    ]
)
_ENTRIES_SQL = (
    "shard long, term string, docs array<int>, tfs array<long>, strata array<long>, "
    "peaks array<long>, ids array<long>, lengths array<long>"
)


def _byte_table() -> bytes:
    """Lower case for A-Z, a blank for every other ASCII character but letters and digits."""
    kept = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
    return bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in kept else 32 for c in range(256))


_BYTES = _byte_table()


@dataclass(frozen=True)
class Index:
    """Entries by shard and term, the number of documents with a term, and of all terms."""

    entries: DataFrame
    documents: int
    words: int


def _terms(texts: DataFrame) -> DataFrame:
    """Each row's distinct terms, joined by blanks, how often each occurs, and their sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            terms, tfs, n = [], [], []
            for text in batch.column(1).cast(pa.large_binary()).to_pylist():
                counts = Counter((text or b"").translate(_BYTES).split())
                terms.append(b" ".join(counts))
                tfs.append(np.fromiter(counts.values(), "<i4", len(counts)).tobytes())
                n.append(counts.total())
            rows = range(row, row := row + len(n))
            yield table(
                _DOCS, row=list(rows), doc_id=batch.column(0), n=n, terms=terms, tfs=tfs
            )

    return texts.mapInArrow(run, _DOCS_SQL)


def _unit(m: Column) -> Column:
    """Neighbouring lengths that the layout treats as one: each below 1024, then 512 to each
    doubling, so their number is bounded whatever the lengths."""
    above = F.greatest(F.length(F.bin(m)) - 10, F.lit(0))
    return F.call_function("shiftright", m, above) + above * 512


def _layout(docs: DataFrame) -> DataFrame:
    """First shard and number of slices of each unit. At most some 30,000 units come to the
    driver."""
    size = F.sum(F.octet_length("terms") + F.octet_length("tfs") + DOCUMENT_BYTES)
    units = sorted(docs.groupBy(_unit(F.col("m")).alias("unit")).agg(size).collect())
    rows, shard, used = [], 0, 0
    for unit, held in units:
        if used and used + held > SHARD_BYTES:
            shard, used = shard + 1, 0
        slices = -(-held // SHARD_BYTES)
        rows.append((unit, shard, slices))
        if slices > 1:
            shard, used = shard + slices, 0
        else:
            used += held
    return docs.sparkSession.createDataFrame(rows, "unit long, first long, slices long")


def _entries(docs: pa.Table) -> pa.Table:
    """The entries of a shard."""
    order = np.lexsort((docs["row"].to_numpy(), docs["m"].to_numpy()))
    docs = docs.take(pa.array(order))
    m = docs["m"].to_numpy()
    texts = [x.split() for x in docs["terms"].to_pylist()]
    coded = pa.array([t for x in texts for t in x], pa.binary()).dictionary_encode()
    term = coded.indices.to_numpy()
    doc = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
    tf = np.frombuffer(b"".join(docs["tfs"].to_pylist()), "<i4").astype(np.int64)
    names = coded.dictionary.cast(pa.string())
    by_name = pc.array_sort_indices(names)
    rank = np.empty(len(names), np.int64)
    rank[by_name.to_numpy()] = np.arange(len(names))
    sort = np.lexsort((doc, tf, m[doc], rank[term]))
    term, doc, tf = rank[term][sort], doc[sort], tf[sort]
    begins = np.searchsorted(term, np.arange(len(names) + 1))
    # The last posting of each term and stratum has its largest tf.
    last = np.r_[(term[1:] != term[:-1]) | (m[doc][1:] != m[doc][:-1]), [True] * bool(len(term))]
    last = np.flatnonzero(last)
    strata = np.searchsorted(term[last], np.arange(len(names) + 1))
    shard, none = docs["shard"][0].as_py(), pa.nulls(len(names), pa.list_(pa.int64()))
    postings = table(
        _ENTRIES,
        shard=pa.array(np.full(len(names), shard)),
        term=names.take(by_name),
        docs=_lists(begins, doc.astype(np.int32)),
        tfs=_lists(begins, tf),
        strata=_lists(strata, m[doc][last]),
        peaks=_lists(strata, tf[last]),
        ids=none,
        lengths=none,
    )
    blank = {n: [None] for n in ("term", "docs", "tfs", "strata", "peaks")}
    ids = pa.array([docs["doc_id"].to_pylist()], pa.list_(pa.int64()))
    listed = table(_ENTRIES, shard=[shard], ids=ids, lengths=_lists([0, len(m)], m), **blank)
    return pa.Table.from_batches([listed, postings])


def _lists(ends: object, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.asarray(ends, np.int32)), pa.array(values))


def index_documents(docs: DataFrame, path: str | None = None) -> Index:
    """The index of every row of ``docs`` (``doc_id``, ``text``), written to ``path`` or to
    the session's shared folder."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counted = stored(_terms(texts), "terms")
    documents, words = counted.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    words = words or 0
    wide = lambda x: F.lit(x).cast("decimal(19,0)")
    share = F.call_function("div", wide(50 * documents) * F.col("n"), wide(max(words, 1)))
    laid = counted.withColumn("m", share + 50)
    layout = F.broadcast(_layout(laid))
    slice_of = F.pmod(F.xxhash64("row"), F.col("slices"))
    dealt = laid.withColumn("unit", _unit(F.col("m"))).join(layout, "unit")
    dealt = dealt.withColumn("shard", F.col("first") + slice_of)
    columns = ("shard", "row", "doc_id", "m", "terms", "tfs")
    entries = dealt.select(*columns).groupBy("shard").applyInArrow(_entries, _ENTRIES_SQL)
    path = path or new_folder(docs.sparkSession, "index")
    entries.write.mode("error").parquet(f"{path}/entries")
    sums = docs.sparkSession.createDataFrame([(documents, words)], "documents long, words long")
    sums.coalesce(1).write.mode("error").parquet(f"{path}/sums")
    return load_index(docs.sparkSession, path)


def load_index(spark: SparkSession, path: str) -> Index:
    documents, words = spark.read.parquet(f"{path}/sums").first()
    entries = spark.read.schema(_ENTRIES_SQL).parquet(f"{path}/entries")
    return Index(entries, documents, words)


def _asked(items: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """``items`` with a number each; ``item``, ``term``, ``block``; the number of blocks."""
    number = F.monotonically_increasing_id().alias("item")
    numbered = stored(items.select(number, "item_id", F.col("text").cast("string")), "items")
    counted = _terms(numbered.select(F.col("item").alias("doc_id"), "text")).where("n > 0")
    each = F.explode(F.split(F.col("terms").cast("string"), " ")).alias("term")
    terms = counted.select(F.col("doc_id").alias("item"), each)
    held = terms.agg(F.sum(F.octet_length("term") + DOCUMENT_BYTES)).first()[0] or 0
    blocks = -(-held // ITEM_BYTES)
    block = F.pmod(F.xxhash64("item"), F.lit(max(blocks, 1))).alias("block")
    return numbered, stored(terms.select("item", "term", block), "asked"), blocks


def _found(index: Index, asked: DataFrame) -> DataFrame:
    """The entries of the terms that are asked for, each with the items and weights it counts
    for, and the lists of documents."""
    small = measure(asked).small
    terms = asked.groupBy("term").agg(F.sort_array(F.collect_list("item")).alias("items"))
    entries = index.entries.where(F.col("term").isNotNull())
    held = entries.select("term", F.size("docs").alias("held"))
    held = held.join(hint(terms.select("term"), small), "term")
    df = held.groupBy("term").agg(F.sum("held").alias("df"))
    ratio = F.lit(2.0 * index.documents + 2) / (F.col("df") * 2 + 1)
    weight = F.floor(F.log(ratio) * 1000).alias("w")
    weights = terms.join(df, "term").select("term", "items", weight)
    weighed = entries.join(hint(weights, small), "term")
    lists = index.entries.where(F.col("term").isNull())
    return weighed.unionByName(lists, allowMissingColumns=True)


def bounds(found: DataFrame) -> DataFrame:
    """What the documents of each stratum of a shard can score at most for each item:
    ``shard``, ``m``, ``item``, ``bound``."""
    peaks = found.where(F.col("term").isNotNull()).select(
        "shard", "items", "w", F.explode(F.arrays_zip("strata", "peaks")).alias("x")
    )
    tf, m = F.col("x.peaks"), F.col("x.strata")
    impact = F.call_function("div", tf * 1_000_000_000, tf * 1000 + m * 20)
    most = (F.col("w") * impact).alias("most")
    each = peaks.select("shard", m.alias("m"), most, F.explode("items").alias("item"))
    return each.groupBy("shard", "m", "item").agg(F.sum("most").alias("bound")).where("bound > 0")


_SCORES = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _add(
    scores: np.ndarray, visited: np.ndarray, m: np.ndarray, row: dict, items: np.ndarray
) -> None:
    """A term's impacts, one per run of equal m and tf, for the items that ask for it and the
    strata they visit."""
    at = np.searchsorted(items, row["items"])
    at = at[items[np.minimum(at, len(items) - 1)] == row["items"]]
    if not len(at):
        return
    docs, tfs = row["docs"], row["tfs"]
    lengths = m[docs]
    heads = np.flatnonzero(np.r_[True, (tfs[1:] != tfs[:-1]) | (lengths[1:] != lengths[:-1])])
    tf = tfs[heads]
    impacts = row["w"] * ((1_000_000_000 * tf) // (1000 * tf + 20 * lengths[heads]))
    impacts = np.repeat(impacts, np.diff(heads, append=len(docs)))
    for i in at:
        open_to = visited[i, docs]
        scores[i, docs[open_to]] += impacts[open_to]


def _top(item: int, scores: np.ndarray, ids: pa.Array, k: int) -> pa.RecordBatch:
    """The ``k`` best of one item, equal scores by ascending id, those without an id last."""
    found = np.flatnonzero(scores > 0)
    if len(found) > k:
        least = np.partition(scores[found], len(found) - k)[len(found) - k]
        found = found[scores[found] >= least]
    listed = pa.record_batch(
        [pa.array(np.full(len(found), item)), ids.take(pa.array(found)), pa.array(scores[found])],
        schema=_SCORES,
    )
    order = [("score", "descending"), ("doc_id", "ascending")]
    return listed.sort_by(order).slice(0, k)


def _scored(found: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """The ``k`` best documents of each shard for each item, in the strata it visits."""

    def run(shard: pa.Table, asked: pa.Table) -> pa.Table:
        if not len(asked):
            return _SCORES.empty_table()
        known = pc.is_valid(shard["term"])
        listed = shard.filter(pc.invert(known))
        m = listed["lengths"].combine_chunks()[0].values.to_numpy()
        ids = listed["ids"].combine_chunks()[0].values
        columns = shard.filter(known).select(["docs", "tfs", "items", "w"]).combine_chunks()
        lists = lambda x: x.values.to_numpy()
        rows = [
            {"docs": lists(d), "tfs": lists(t), "items": lists(i), "w": w.as_py()}
            for d, t, i, w in zip(*columns.columns)
        ]
        item, stratum = asked["item"].to_numpy(), asked["m"].to_numpy()
        everyone, out = np.unique(item), []
        for items in np.array_split(everyone, -(-len(everyone) * len(m) // CELLS)):
            visited = np.zeros((len(items), len(m)), bool)
            mine = np.isin(item, items)
            starts = np.searchsorted(m, stratum[mine], "left")
            ends = np.searchsorted(m, stratum[mine], "right")
            for i, a, b in zip(np.searchsorted(items, item[mine]), starts, ends):
                visited[i, a:b] = True
            scores = np.zeros(visited.shape, np.int64)
            for row in rows if len(items) else ():
                _add(scores, visited, m, row, items)
            out += [_top(i, s, ids, k) for i, s in zip(items.tolist(), scores)]
        return pa.Table.from_batches(out, _SCORES)

    there = found.select("shard", "term", "docs", "tfs", "ids", "lengths", "items", "w")
    asked = visits.select(F.col("shard").alias("of"), "item", "m")
    cogrouped = there.groupBy("shard").cogroup(asked.groupBy("of"))
    return cogrouped.applyInArrow(run, "item long, doc_id long, score long")


def search(index: Index, items: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` best documents with a score above 0 for every row of ``items`` (``item_id``,
    ``text``): ``item_id``, ``rank`` from 1, ``doc_id``, ``score``."""
    numbered, asked, blocks = _asked(items)
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    parts = []
    for block in range(max(blocks, 1)):
        found = stored(_found(index, asked.where(F.col("block") == block).drop("block")), "found")
        limits = stored(bounds(found), "bounds")
        first = best(limits, ["item"], [F.desc("bound"), F.col("shard"), F.col("m")], k)
        first = stored(first.select("shard", "m", "item"), "visits")
        early = best(_scored(found, first, k), ["item"], order, k)
        early = stored(early, "early")
        reached = early.where(F.col("rank") == k).select("item", F.col("score").alias("reached"))
        rest = limits.join(first, ["shard", "m", "item"], "left_anti").join(reached, "item", "left")
        rest = rest.where(F.col("bound") >= F.coalesce("reached", F.lit(0)))
        parts.append(early.drop("rank").union(_scored(found, rest, k)))
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.union(more)
    ranked = best(rows, ["item"], order, k)
    return ranked.join(numbered, "item").select("item_id", "rank", "doc_id", "score")


ORACLE = """
WITH counted AS (
  SELECT doc, doc_id, term, count(*) AS tf FROM (
    SELECT doc, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS doc, doc_id, text FROM documents))
  GROUP BY doc, doc_id, term),
terms AS (SELECT *, sum(tf) OVER (PARTITION BY doc) AS n FROM counted),
sums AS (SELECT count(DISTINCT doc) AS docs, sum(tf)::BIGINT AS words FROM terms),
dfs AS (SELECT term, count(*) AS df FROM terms GROUP BY term),
asked AS (
  SELECT DISTINCT item, item_id, term FROM (
    SELECT item, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark))),
weights AS (
  SELECT item, item_id, term,
    floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM asked JOIN dfs USING (term), sums),
scores AS (
  SELECT item, item_id, doc, doc_id, sum(w * ((1000000000 * tf)
    // (1000 * tf + 20 * (100 - 50 + ((50 * n::BIGINT * docs) // words)))))::BIGINT AS score
  FROM weights JOIN terms USING (term), sums GROUP BY item, item_id, doc, doc_id)
SELECT item_id, doc_id, score,
  (row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id))::INTEGER AS rank
FROM scores WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) <= 50
"""
