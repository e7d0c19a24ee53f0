"""Ranking factors of each (query, document), from one pass over the words.

Everything is combined before a shuffle; no word row is moved as it is. Counts alone
take one aggregate by (query, document). Otherwise each query word is first counted per
document, once however many queries share it, and the counts join the queries after
that. Runs need positions, but only of words that follow the word they follow in the
query: all other words make runs of one, which the counts already show.

The statistics of BM25 come from the same shuffled counts, so the texts are split once.
Spark shares that shuffle only when both uses ask for the same columns and filters of
it; comments below say where that shapes the code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wordloom.codes import WEIGHT_BOUND
from wordloom.sources.batch import QueryBatch
from wordloom.sizing import dealt, join_by_term
from wordloom.sources.corpus import Corpus
from wordloom.sources.tokens import MARKER, doc_terms, field_counts, positions

K1 = 1.2
B = 0.75
SCALE = 1_000_000
# Up to this many queries, counting a shared word once per query costs less than a shuffle.
FEW_QUERIES = 16


def _total(columns: list[Column]) -> Column:
    result = columns[0]
    for column in columns[1:]:
        result = result + column
    return result


def _document_counts(corpus: Corpus, batch: QueryBatch) -> DataFrame:
    """(term, docs, words) of the query words: documents holding each, in one pass.

    Each document gives its distinct words and the marker word, whose row so counts
    all documents and sums their lengths. Sums are made per word before the shuffle. An index
    has them stored.
    """
    wanted = batch.words(marker=MARKER).select("term").distinct()
    if corpus.statistics is not None:
        known = corpus.statistics.select("term", "docs", "words")
        return join_by_term(known, wanted, batch.small, ["term"])
    listed = doc_terms(corpus, marker=True)
    found = join_by_term(listed, wanted, batch.small, list(corpus.keys))
    return found.groupBy("term").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("doc_len").alias("words")
    )


def with_idf(batch: QueryBatch, counts: DataFrame) -> DataFrame:
    """Query words with idf and avg_len from the document counts of the whole corpus.

    Each query carries the marker word too and so picks up the totals by the same
    join. The marker is then dropped by position: a filter on the word would be
    passed on to the other side of later joins and make its plan differ.
    """
    rows = batch.words(marker=MARKER)
    joined = join_by_term(rows, counts, batch.small, ["query_id", "qpos"], "left")
    query = Window.partitionBy("query_id")
    is_marker = F.col("term") == MARKER
    docs = F.max(F.when(is_marker, F.col("docs"))).over(query).cast("double")
    total = F.max(F.when(is_marker, F.col("words"))).over(query).cast("double")
    found = F.coalesce("docs", F.lit(0)).cast("double")
    return joined.select(
        *["query_id", "qpos", "term", "first_qpos", "before", "qlen", "n_terms"],
        F.log(1.0 + (docs - found + 0.5) / (found + 0.5)).alias("idf"),
        (total / docs).alias("avg_len"),
    ).where(F.col("qpos") < F.col("qlen"))


def _bm25_term(tf: Column, k1: float, b: float) -> Column:
    """Contribution of one word, in millionths, so that sums do not depend on order."""
    norm = tf + k1 * (1 - b + b * F.col("doc_len") / F.col("avg_len"))
    score = F.col("idf") * tf * (k1 + 1) / norm
    return F.round(score * SCALE).cast("bigint")


def _longest_run(batch: QueryBatch, linked: Column) -> tuple[Column, Column, Column]:
    """How the linked query positions of one alignment are kept, the run they make, and
    whether there are none.

    A position occurs at most once per alignment, and a run of n words links n - 1.
    Up to 62 positions are bits of a number and the longest row of ones is read off
    its binary text; longer queries keep the positions and count through them.
    """
    spots = F.col("spots")
    if batch.fits_mask:
        mask = F.bit_or(F.when(linked, F.expr("shiftleft(1L, qpos)")))
        bits = F.bin(spots)
        longer = [F.contains(bits, F.lit("1" * n)).cast("int") for n in range(2, batch.max_len)]
        run = (
            F.when(spots.isNull(), F.lit(1))
            .when(F.bit_count(spots) == 1, F.lit(2))
            .otherwise(_total([F.lit(2), *longer]))
        )
        return mask, run, spots.isNull()
    start = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("row"), F.lit(0).alias("best"))

    def step(state: Column, spot: Column) -> Column:
        row = F.when(state["last"] == spot - 1, state["row"] + 1).otherwise(F.lit(1))
        return F.struct(
            spot.alias("last"), row.alias("row"), F.greatest(state["best"], row).alias("best")
        )

    best = F.aggregate(F.array_sort(spots), start, step, lambda state: state["best"])
    return F.collect_list(F.when(linked, F.col("qpos"))), best + 1, F.size(spots) == 0


def factors(
    corpus: Corpus,
    batch: QueryBatch,
    runs: bool,
    scored: bool,
    ends: bool = False,
    carry: Sequence[str] = (),
    stats: Corpus | None = None,
    k1: float = K1,
    b: float = B,
) -> DataFrame:
    """One row per (query, document sharing a word with it).

    Columns: query_id, keys, carried attributes, qlen, n_terms, doc_len,
    matched_terms, field_mask, and per field i: hits_i (occurrences of query
    words), terms_i (distinct query words). With ``runs`` also per field lcs_i
    (longest run of query words in order and adjacent) and best_run over the fields;
    with ``ends`` besides head_i (the first query word opens the field) and exact_i
    (the field is the query). With ``scored`` also bm25 in millionths, from the
    statistics of ``stats`` (the unfiltered corpus; none when ``corpus`` is it).
    """
    group = ["query_id", *corpus.keys, *carry]
    if corpus.statistics is not None:
        stats = corpus
    if not runs and not scored and batch.fits_mask and batch.queries <= FEW_QUERIES:
        return _counts(corpus, batch, carry, group)
    n_fields = range(len(corpus.fields))
    met = _total([F.col(f"tf_{i}") for i in n_fields])
    if runs:
        counted, run, unlinked = _words_and_alignments(corpus, batch, carry, ends)
        # No alignment passes these tests, which touch all its columns and no key.
        is_count = unlinked & (met > 0)
        if ends:
            is_count &= F.col("head").isNull() & F.col("field_len").isNull()
            is_count &= F.col("span").isNull()
    else:
        counted, is_count = _word_counts(corpus, batch, carry), met > 0
    if not scored:
        terms = batch.terms
    elif stats is None:
        counts = counted.where(is_count).groupBy("term").agg(
            F.count(F.lit(1)).alias("docs"), F.sum("doc_len").alias("words")
        )
        terms = with_idf(batch, counts)
    else:
        terms = with_idf(batch, _document_counts(stats, batch))

    lead = terms.where(F.col("qpos") == F.col("first_qpos"))
    if runs and batch.queries > FEW_QUERIES:
        counted = dealt(counted, _rows(corpus, batch), corpus.keys)
    if runs:
        level = join_by_term(counted, lead, batch.small, list(corpus.keys), "left")
        level = level.withColumns(
            {"query_id": F.coalesce("of_query", "query_id"), "run": run}
        ).where(F.col("query_id").isNotNull())
    else:
        level = join_by_term(counted, lead, batch.small, list(corpus.keys))
    is_word = F.col("qpos").isNotNull()

    measures = [F.max(c).alias(c) for c in ("qlen", "n_terms", "doc_len")]
    measures.append(F.count_if(is_word).alias("matched_terms"))
    for i in n_fields:
        measures.append(F.sum(F.when(is_word, F.col(f"tf_{i}"))).alias(f"hits_{i}"))
        measures.append(F.count_if(is_word & (F.col(f"tf_{i}") > 0)).alias(f"terms_{i}"))
    if scored:
        share = _bm25_term(met.cast("double"), k1, b)
        measures.append(F.sum(F.when(is_word, share)).alias("bm25"))
    if runs:
        for i in n_fields:
            here = F.col("at_field") == i
            measures.append(F.max(F.when(here, F.col("run"))).alias(f"lcs_{i}"))
            if ends:
                full = (F.col("run") == F.col("span")) & (F.col("field_len") == F.col("span"))
                head = here & F.col("head")
                measures += [
                    F.coalesce(F.max(head.cast("int")), F.lit(0)).alias(f"head_{i}"),
                    F.coalesce(F.max((head & full).cast("int")), F.lit(0)).alias(f"exact_{i}"),
                ]
    result = _with_mask(level.groupBy(*group).agg(*measures), corpus)
    if runs:
        found = {
            f"lcs_{i}": F.when(F.col(f"terms_{i}") > 0, F.coalesce(f"lcs_{i}", F.lit(1))).otherwise(0)
            for i in n_fields
        }
        result = result.withColumns(found)
        best = [F.col(name) for name in found]
        result = result.withColumn("best_run", F.greatest(*best) if len(best) > 1 else best[0])
    return result


def _tf(corpus: Corpus) -> list[Column]:
    """Occurrences per field."""
    return [F.count_if(F.col("field_no") == i).alias(f"tf_{i}") for i in range(len(corpus.fields))]


def _word_counts(corpus: Corpus, batch: QueryBatch, carry: Sequence[str]) -> DataFrame:
    """One row per document and distinct word of any query, and the marker, with counts.

    A document's words are counted in its row and dealt by document, so that all that is
    grouped by document later stays in its task, which holds a bounded number of documents.
    """
    keys = list(corpus.keys)
    vocabulary = batch.words(marker=MARKER).select("term").distinct()
    words = join_by_term(field_counts(corpus, carry, marker=True), vocabulary, batch.small, keys)
    # Grouping what one field has grouped already keeps every column in both uses.
    sums = [
        F.sum(F.when(F.col("field_no") == i, F.col("n")).otherwise(0)).alias(f"tf_{i}")
        for i in range(len(corpus.fields))
    ]
    words = dealt(words, _rows(corpus, batch), keys)
    return words.groupBy(*keys, *carry, "term").agg(*sums, F.max("doc_len").alias("doc_len"))


def _rows(corpus: Corpus, batch: QueryBatch) -> int:
    """About how many rows the words and queries met make at most. Counts the documents."""
    return corpus.df.count() * batch.rows_per_document


def _words_and_alignments(
    corpus: Corpus, batch: QueryBatch, carry: Sequence[str], ends: bool
) -> tuple[DataFrame, Column, Column]:
    """Rows of two kinds per document, and the run and the mark of no links of a row.

    Counts: one row per distinct word of any query, and the marker, with ``of_query``
    null. Alignments: one row per query laid over a field (``of_query``, ``at_field``,
    ``anchor``) that links two words, and with ``ends`` also one that puts the first
    query word at the start; their ``term`` is the marker, never null, because a test
    for null would be pushed into one use of this table and not the other.
    """
    queries = batch.terms.select("query_id", "qpos", "term", "before", "qlen")
    vocabulary = batch.words(marker=MARKER).select("term").distinct()
    side = queries.unionByName(vocabulary, allowMissingColumns=True)
    words = positions(corpus, carry, marker=True, previous=True)
    hits = join_by_term(words, side, batch.small, list(corpus.keys))
    is_word = F.col("query_id").isNull()
    linked = F.coalesce(F.col("previous") == F.col("before"), F.lit(False))
    opens = F.coalesce((F.col("pos") == 0) & (F.col("qpos") == 0), F.lit(False))
    kept = is_word | linked | opens if ends else is_word | linked
    term = F.coalesce(F.when(is_word, F.col("term")), F.lit(MARKER))
    rows = hits.where(kept).select(
        *corpus.keys,
        *carry,
        F.col("query_id").alias("of_query"),
        F.when(~is_word, F.col("field_no")).alias("at_field"),
        F.when(~is_word, F.col("pos") - F.col("qpos")).alias("anchor"),
        term.alias("term"),
        linked.alias("linked"),
        F.when(~is_word, opens).alias("opens"),
        F.when(~is_word, F.col("field_len")).alias("field_len"),
        F.col("qlen").alias("span"),
        *["qpos", "field_no", "doc_len"],
    )
    spots, run, unlinked = _longest_run(batch, F.col("linked"))
    edges = [
        F.max("opens").alias("head"),
        F.max("field_len").alias("field_len"),
        F.max("span").alias("span"),
    ]
    counted = rows.groupBy(*corpus.keys, *carry, "of_query", "at_field", "anchor", "term").agg(
        spots.alias("spots"),
        *_tf(corpus),
        F.max("doc_len").alias("doc_len"),
        *(edges if ends else []),
    )
    return counted, run, unlinked


def _with_mask(df: DataFrame, corpus: Corpus) -> DataFrame:
    """``df`` plus field_mask: bit i is set when field i holds a query word."""
    n_fields = range(len(corpus.fields))
    mask = _total([F.when(F.col(f"terms_{i}") > 0, F.lit(1 << i)).otherwise(0) for i in n_fields])
    return df.withColumn("field_mask", mask.cast("bigint"))


def _counts(
    corpus: Corpus, batch: QueryBatch, carry: Sequence[str], group: list[str]
) -> DataFrame:
    """Counting factors in one aggregate: the words met are bits of a number."""
    hits = join_by_term(
        positions(corpus, carry), batch.lead_terms, batch.small, list(corpus.keys)
    )
    word = F.expr("shiftleft(1L, qpos)")
    measures = [F.max(c).alias(c) for c in ("qlen", "n_terms", "doc_len")]
    measures.append(F.bit_count(F.bit_or(word)).cast("bigint").alias("matched_terms"))
    for i in range(len(corpus.fields)):
        here = F.col("field_no") == i
        met = F.bit_count(F.bit_or(F.when(here, word)))
        measures.append(F.count_if(here).alias(f"hits_{i}"))
        measures.append(F.coalesce(met, F.lit(0)).cast("bigint").alias(f"terms_{i}"))
    return _with_mask(hits.groupBy(*group).agg(*measures), corpus)


def minor(score: Column) -> Column:
    """A score cut to 32 bits, to sit below a major factor in one bigint."""
    return F.least(score, F.lit(WEIGHT_BOUND))
