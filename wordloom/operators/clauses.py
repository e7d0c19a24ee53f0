"""Boolean and extended matching by clauses held in a table.

A query is a set of clauses, one row each: query_id, clause (number), kind, op, text,
n and field. ``kind`` is 'must' (the clause has to hold), 'any' (it holds when one of
its words does) or 'not' (it must not hold, by any of its words). ``op`` is one of

* ``words``   every word of the text occurs ('any' and 'not': one of them);
* ``quorum``  at least ``n`` distinct words of the text occur;
* ``phrase``  the words stand next to each other, in order, in one field;
* ``near``    all words occur within ``n`` successive positions of one field;
* ``start``   the phrase opens a field;
* ``end``     the phrase closes a field.

``field`` (null for all) restricts a clause to one field. A query without 'must'
and 'any' clauses starts from all documents.

With a column ``parent`` (the number of a group, null at the top) clauses nest to any depth. A
group is a row of op ``group`` without a text: 'must' holds when all its members hold, 'any'
when one does, 'not' when none does; a 'not' clause inside a group holds where none of its
words occurs. All rows at the top must hold. A group's number is below those of its members.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from wordloom.functions.text import words
from wordloom.sizing import Size, hint, join_by_term, row_bytes
from wordloom.sources.batch import MASK_BITS, QueryBatch, query_batch
from wordloom.sources.corpus import Corpus
from wordloom.sources.tokens import MARKER, doc_terms, positions

KINDS = ("must", "any", "not")
OPS = ("words", "quorum", "phrase", "near", "start", "end")
ALIGNED = ("phrase", "start", "end")
NOWHERE = -(2**30)  # lies before every position by more than any span
GROUP = "group"


@dataclass(frozen=True)
class ClauseBatch:
    """Clauses split into words: one row per clause word, measured for broadcast.

    ``terms`` has query_id, clause, kind, op, n, field, qpos, term, first_qpos, term_no
    (among the distinct words), before (the word one position earlier), len (words), need (distinct words that make the
    clause hold) and wanted (clauses of the query that must hold). ``ops`` are the
    operators in use. ``trees`` are the groups of each query, where clauses nest.
    """

    terms: DataFrame
    rows: DataFrame
    small: bool
    ops: frozenset[str]
    trees: "Trees | None" = None


@dataclass(frozen=True)
class Trees:
    """Nested clauses of each query, whose nodes are numbered members first.

    ``df`` has query_id, ``nots`` (clauses that hold where they are not found), ``steps`` (each
    group's number, kind and members, innermost first) and ``top`` (what must hold). Sets of
    nodes are bits of a number where every query has at most 62, otherwise lists.
    """

    df: DataFrame
    bits: bool
    small: bool

    def set_of(self, node: Column) -> Column:
        """Collects the node numbers of a group of rows; null counts for none."""
        if self.bits:
            return F.coalesce(F.bit_or(_bit(node)), F.lit(0).cast("bigint"))
        return F.collect_set(node)

    def all_in(self, part: Column, whole: Column) -> Column:
        if self.bits:
            return part.bitwiseAND(whole) == part
        return F.size(F.array_except(part, whole)) == 0

    def some_in(self, part: Column, whole: Column) -> Column:
        return part.bitwiseAND(whole) != 0 if self.bits else F.arrays_overlap(part, whole)

    def holds(self, found: Column) -> Column:
        """Whether the tree holds where the clauses of the set ``found`` are found."""
        if self.bits:
            start = found.bitwiseXOR(F.col("nots"))
        else:
            start = F.concat(F.array_except(found, "nots"), F.array_except("nots", found))

        def step(true: Column, group: Column) -> Column:
            members = group["members"]
            ok = (
                F.when(group["kind"] == "must", self.all_in(members, true))
                .when(group["kind"] == "any", self.some_in(members, true))
                .otherwise(~self.some_in(members, true))
            )
            if self.bits:
                return F.when(ok, true.bitwiseOR(_bit(group["node"]))).otherwise(true)
            return F.when(ok, F.concat(true, F.array(group["node"]))).otherwise(true)

        return F.aggregate("steps", start, step, lambda true: self.all_in(F.col("top"), true))


def _bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), number)


def _trees(rows: DataFrame) -> tuple[DataFrame, Trees, DataFrame]:
    """The clauses of nested ``rows`` under new numbers, their trees, and the queries that
    documents without any of their words may match.

    Clauses without words are left out, as in flat queries. Windows are over one query's rows.
    """
    query = Window.partitionBy("query_id")
    kept = rows.where((F.col("op") == GROUP) | (F.size(words("text")) > 0))
    node = F.row_number().over(query.orderBy(F.desc("clause"))) - 1
    nodes = kept.withColumn("node", node.cast("int"))
    above = nodes.where(F.col("op") == GROUP).select(
        "query_id", F.col("clause").alias("parent"), F.col("node").alias("in")
    )
    joined = nodes.join(above, ["query_id", "parent"], "left")
    lost = F.col("parent").isNotNull() & F.col("in").isNull()
    checks = joined.agg(
        F.max("node"),
        F.count_if(lost),
        F.count_if(F.col("parent") >= F.col("clause")),
        F.count(F.lit(1)),
    ).first()
    if checks[1]:
        raise ValueError("a clause names a parent that is no group of its query")
    if checks[2]:
        raise ValueError("a group's number must be below those of its members")
    trees = Trees(nodes, (checks[0] or 0) < MASK_BITS, Size(checks[3], checks[3] * 256).small)
    members = joined.groupBy("query_id", F.col("in").alias("node")).agg(
        trees.set_of(F.col("node")).alias("members")
    )
    top = members.where(F.col("node").isNull()).select("query_id", F.col("members").alias("top"))
    groups = nodes.where(F.col("op") == GROUP).join(members, ["query_id", "node"], "left")
    if not groups.where(F.col("members").isNull()).isEmpty():
        raise ValueError("a group has no members")
    steps = groups.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("node", "kind", "members"))).alias("steps")
    )
    clauses = nodes.where(F.col("op") != GROUP)
    inverted = F.when((F.col("op") != GROUP) & (F.col("kind") == "not"), F.col("node"))
    nots = nodes.groupBy("query_id").agg(trees.set_of(inverted).alias("nots"))
    df = nots.join(top, "query_id").join(steps, "query_id", "left")
    none = F.array().cast(steps.schema["steps"].dataType)
    trees = replace(trees, df=df.withColumn("steps", F.coalesce("steps", none)))
    nothing = F.lit(0).cast("bigint") if trees.bits else F.array().cast("array<int>")
    anywhere = trees.df.where(trees.holds(nothing)).select("query_id")
    # Words under a negation do not rank.
    listed = F.array_sort(F.collect_list(F.struct("clause", "parent", "kind")))
    negative = F.aggregate(
        listed,
        F.array().cast("array<int>"),
        lambda found, x: F.when(
            (x["kind"] == "not") | F.coalesce(F.array_contains(found, x["parent"]), F.lit(False)),
            F.concat(found, F.array(x["clause"])),
        ).otherwise(found),
    )
    negatives = nodes.groupBy("query_id").agg(negative.alias("negative"))
    ranks = ~F.array_contains("negative", F.col("clause"))
    leaves = clauses.join(negatives, "query_id").withColumn("ranks", ranks)
    leaves = leaves.withColumn("clause", F.col("node")).drop("node", "negative", "parent")
    return leaves, trees, anywhere


def clause_batch(clauses: DataFrame) -> ClauseBatch:
    """Batch from (query_id, clause, kind, text[, op, n, field, parent])."""
    present = clauses.columns
    nested = "parent" in present
    rows = clauses.select(
        F.col("query_id").cast("bigint").alias("query_id"),
        F.col("clause").cast("int").alias("clause"),
        "kind",
        (F.col("op") if "op" in present else F.lit("words")).alias("op"),
        (F.col("n") if "n" in present else F.lit(None)).cast("int").alias("n"),
        (F.col("field") if "field" in present else F.lit(None)).cast("string").alias("field"),
        "text",
        *([F.col("parent").cast("int").alias("parent")] if nested else []),
    )
    wordless = F.coalesce(F.size(words("text")), F.lit(0)) <= 0
    empty = (F.col("kind") == "must") & (F.col("op") != GROUP) & wordless
    checks = rows.agg(
        F.count(F.lit(1)), F.count_distinct(F.struct("query_id", "clause")), F.count_if(empty)
    ).first()
    if checks[0] != checks[1]:
        raise ValueError("a clause of a query occurs twice")
    if checks[2]:
        raise ValueError("a clause that must hold has no words")
    trees = anywhere = None
    if nested:
        rows, trees, anywhere = _trees(rows)
    else:
        rows = rows.withColumn("ranks", F.col("kind") != "not")
    lists = rows.withColumn("list", words("text")).where(F.size("list") > 0)
    distinct = F.size(F.array_distinct("list"))
    need = (
        F.when(F.col("op") == "quorum", F.col("n"))
        .when((F.col("op") == "words") & (F.col("kind") != "must"), F.lit(1))
        .otherwise(distinct)
    )
    lists = lists.withColumns({"len": F.size("list"), "need": need})
    # A query with nothing to find gets the marker word, which every document has.
    positive = F.count_if(F.col("kind") != "not")
    base = lists.groupBy("query_id").agg(positive.alias("p")).where(F.col("p") == 0)
    everything = (base if anywhere is None else anywhere).select(
        "query_id",
        F.lit(-1).alias("clause"),
        F.lit("must").alias("kind"),
        F.lit("words").alias("op"),
        F.lit(None).cast("int").alias("n"),
        F.lit(None).cast("string").alias("field"),
        F.array(F.lit(MARKER)).alias("list"),
        F.lit(1).alias("len"),
        F.lit(1).alias("need"),
    )
    lists = lists.drop("text", "ranks").unionByName(everything)
    wanted = F.count_if(F.col("kind") != "not").over(Window.partitionBy("query_id"))
    exploded = lists.withColumn("wanted", wanted.cast("int")).select(
        "*", F.posexplode_outer("list").alias("qpos", "term")
    )
    terms = exploded.withColumns(
        {
            "first_qpos": (F.array_position("list", F.col("term")) - 1).cast("int"),
            "term_no": (F.array_position(F.array_distinct("list"), F.col("term")) - 1).cast("int"),
            "before": F.get("list", F.col("qpos") - 1),
        }
    ).drop("list")
    row = terms.agg(
        F.count(F.lit(1)),
        F.sum(row_bytes(terms)),
        F.collect_set(F.when(F.col("op").isin(*OPS), F.col("op"))),
        F.count_if(~F.col("kind").isin(*KINDS) | ~F.col("op").isin(*OPS)),
        F.count_if(F.col("op").isin("quorum", "near") & ~F.coalesce(F.col("n") >= 1, F.lit(False))),
    ).first()
    if row[3]:
        raise ValueError(f"clause kinds are {KINDS}, operators {OPS}")
    if row[4]:
        raise ValueError("quorum and near clauses need n >= 1")
    return ClauseBatch(
        terms=terms,
        rows=rows,
        small=Size(row[0], row[1] or 0).small,
        ops=frozenset(row[2]),
        trees=trees,
    )


def ranking_batch(clauses: ClauseBatch) -> QueryBatch:
    """The words of the clauses to find, in clause order, as queries for a ranker.

    A query with nothing to find has no words.
    """
    part = F.when(F.col("ranks"), F.struct("clause", "text"))
    per_query = clauses.rows.groupBy("query_id").agg(
        F.array_sort(F.collect_list(part)).alias("parts")
    )
    text = F.concat_ws(" ", F.transform("parts", lambda p: p["text"]))
    return query_batch(per_query.select("query_id", text.alias("text")))


def _decide(held: DataFrame, found_by: list[str], trees: Trees | None) -> DataFrame:
    """Documents where all wanted clauses hold and no 'not' clause does, or the query's tree
    holds: the clauses found become one set per (query, document), the groups follow from it."""
    if trees is not None:
        clause = F.when(F.col("holds") & (F.col("clause") >= 0), F.col("clause"))
        found = held.groupBy(*found_by).agg(trees.set_of(clause).alias("found"))
        joined = found.join(hint(trees.df, trees.small), "query_id")
        return joined.where(trees.holds(F.col("found"))).select(*found_by)
    banned = F.col("kind") == "not"
    found = held.groupBy(*found_by).agg(
        F.count_if(F.col("holds") & ~banned).alias("found"),
        F.count_if(F.col("holds") & banned).alias("banned"),
        F.max("wanted").alias("wanted"),
    )
    good = (F.col("found") == F.col("wanted")) & (F.col("banned") == 0)
    return found.where(good).select(*found_by)


def match_boolean(
    corpus: Corpus, clauses: ClauseBatch, carry: Sequence[str] = ()
) -> DataFrame:
    """(query_id, keys, carried attributes) for clauses on whole documents: words and quorum, no field.

    Each document lists its distinct words, so a clause counts rows; counts are
    combined before the shuffle.
    """
    if not clauses.ops <= {"words", "quorum"}:
        raise ValueError("clauses with positions need match_extended")
    terms = clauses.terms.where(F.col("qpos") == F.col("first_qpos")).select(
        "query_id", "clause", "kind", "need", "wanted", "term"
    )
    hits = join_by_term(
        doc_terms(corpus, carry, marker=True), terms, clauses.small, list(corpus.keys)
    )
    found_by = ["query_id", *corpus.keys, *carry]
    held = hits.groupBy(*found_by, "clause", "kind", "wanted").agg(
        (F.count(F.lit(1)) >= F.max("need")).alias("holds")
    )
    return _decide(held, found_by, clauses.trees)


def match_extended(
    corpus: Corpus, clauses: ClauseBatch, carry: Sequence[str] = ()
) -> DataFrame:
    """(query_id, keys, carried attributes) for clauses of every operator.

    A phrase of several words needs only the words that follow the word they follow
    in the clause; other operators need each distinct word. These rows are combined
    before the shuffle, those of a 'near' clause into one list of places per field.
    """
    unknown = F.col("field").isNotNull() & ~F.col("field").isin(*corpus.fields)
    if not clauses.rows.where(unknown).isEmpty():
        raise ValueError(f"a clause names a field that is not among {list(corpus.fields)}")
    names = F.array(*[F.lit(f) for f in corpus.fields])
    words = positions(corpus, carry, marker=True, previous=True)
    hits = join_by_term(words, clauses.terms, clauses.small, list(corpus.keys))
    in_field = F.col("field").isNull() | (F.col("field") == names[F.col("field_no")])
    aligned = F.col("op").isin(*ALIGNED)
    near = F.col("op") == "near"
    single = F.col("len") == 1
    linked = F.coalesce(F.col("previous") == F.col("before"), F.lit(False))
    lead = F.col("qpos") == F.col("first_qpos")
    kept = F.when(aligned, single | linked).otherwise(lead)
    hits = hits.where(F.col("pos").isNotNull() & in_field & kept)
    found_by = ["query_id", *corpus.keys, *carry]
    clause = [*found_by, "clause", "kind", "op", "wanted"]

    spans = "near" in clauses.ops
    place = F.when(near, F.struct("pos", "term_no"))
    # The unit a row proves: an alignment, a field's spans, or a word of the clause.
    anchor = F.col("pos") - F.col("qpos")
    units = hits.withColumns(
        {
            "unit_field": F.when(aligned | near, F.col("field_no")),
            "unit": F.when(aligned, anchor).when(near, F.lit(0)).otherwise(F.col("qpos")),
        }
    )
    proved = units.groupBy(*clause, "unit_field", "unit").agg(
        F.count(F.lit(1)).alias("n_hits"),
        F.max("field_len").alias("field_len"),
        F.max("len").alias("len"),
        F.max("need").alias("need"),
        F.max("n").alias("n"),
        *([F.collect_list(place).alias("places")] if spans else []),
    )
    whole = F.col("n_hits") == F.when(single, F.lit(1)).otherwise(F.col("len") - 1)
    opens = F.col("unit") == 0
    closes = F.col("unit") + F.col("len") == F.col("field_len")
    ok = (
        F.when(F.col("op") == "phrase", whole)
        .when(F.col("op") == "start", whole & opens)
        .when(F.col("op") == "end", whole & closes)
        .when(near, _within() if spans else F.lit(False))
        .otherwise(F.lit(True))
    )
    by_count = F.col("op").isin("words", "quorum")
    held = proved.groupBy(*clause).agg(
        F.when(by_count, F.count_if(ok) >= F.max("need"))
        .otherwise(F.count_if(ok) > 0)
        .alias("holds")
    )
    return _decide(held, found_by, clauses.trees)


def _within() -> Column:
    """Whether some n successive positions hold all the words, from the places of a field.

    Goes through the places in order with the last position of each word in hand.
    """
    start = F.struct(
        F.array_repeat(F.lit(NOWHERE), F.col("need")).alias("last"), F.lit(False).alias("found")
    )

    def step(state: Column, place: Column) -> Column:
        last = F.transform(
            state["last"], lambda old, i: F.when(i == place["term_no"], place["pos"]).otherwise(old)
        )
        close = F.array_min(last) > place["pos"] - F.col("n")
        return F.struct(last.alias("last"), (state["found"] | close).alias("found"))

    found = F.aggregate(F.array_sort("places"), start, step, lambda state: state["found"])
    return (F.size("places") >= F.col("need")) & found
