"""Phrases that stand together more often than their parts suggest, mined level by level.

Relation R(k) holds an occurrence of a k-word phrase per place of a piece. It is persisted in
blocks, one row each, sorted by place; pieces are a place apart, so neighbouring places are
always in one piece. From one level to the next:

1. group-count: a block counts its own phrases, then the phrases of all blocks meet in one
   shuffle, at most one row per block and phrase, which also names each phrase by the first
   block and number that holds it;
2. semi-join: only occurrences of frequent phrases are persisted;
3. merge-join: occurrences at neighbouring places of the sorted relation are joined, which
   gives R(k+1) of phrases whose two halves are frequent.

Phrases are counted exactly, by identity and not by hash; scores use 38-digit integers.

Null texts are empty, a null language is ``und``; repeated rows count as often as they stand;
columns other than ``text`` and ``lang`` stay behind; an empty table gives no phrase. A text of
any length is cut in one row of Arrow; one block may hold 2^28 different words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from wordloom.llm.blocks import Numbers, as_rows, of_row
from wordloom.llm.common import best, discard, slices, stored, table

#: Words in hand before the language with most of them becomes a block.
BLOCK_WORDS = 3_000_000
NUMBER_BITS, BLOCK_BITS = 28, 15
ROWS_OUT = 100_000
# Numbers 0 and 1 of a block: what stands between two blanks, and a break between pieces.
_EMPTY, _BREAK = b"", b"\n"


def _byte_table() -> bytes:
    """Lower case for A-Z, a blank for the tab, a line end for all that ends a piece."""
    to = {**{c: c + 32 for c in range(65, 91)}, 9: 32, **dict.fromkeys(b".,;:!?\n\x0b\x0c\r", 10)}
    return bytes(to.get(c, c) for c in range(256))


_BYTES = _byte_table()

_WORDS = pa.schema(
    [
        ("block", pa.int64()),
        ("lang", pa.string()),
        ("sequence", pa.binary()),
        ("word", pa.string()),
        ("number", pa.int64()),
        ("uses", pa.int64()),
    ]
)
_RELATION = pa.schema(
    [("block", pa.int64()), ("steps", pa.binary()), ("groups", pa.binary()), ("ids", pa.binary())]
)
_RELATION_SQL = "block long, steps binary, groups binary, ids binary"
_GROUPS = pa.schema([(n, pa.int64()) for n in ("first", "second", "block", "number", "uses")])
_GROUPS_SQL = "first long, second long, block long, number long, uses long"


class _Texts:
    """The words of one block and language: their numbers in order, with breaks."""

    def __init__(self) -> None:
        self.numbers, self.parts, self.size = Numbers(), [], 0
        self.numbers.number([_EMPTY, _BREAK], pa.binary())
        self.numbers.news()

    def add(self, words: list[bytes]) -> None:
        numbers = self.numbers.number(words, pa.binary())
        self.parts.append(numbers[numbers != 0])
        self.size += len(self.parts[-1])

    def rows(self, block: int, lang: str) -> pa.RecordBatch:
        sequence = np.concatenate(self.parts)
        first, words = self.numbers.news()
        uses = np.bincount(sequence, minlength=first + len(words))[first:]
        numbers = np.arange(first, first + len(words))
        named = pa.array(words, pa.binary()).cast(pa.string())
        if len(sequence) >> NUMBER_BITS:
            raise ValueError("a block has too many words")
        return table(
            _WORDS,
            block=[block] * (1 + len(words)),
            lang=[lang] * (1 + len(words)),
            sequence=as_rows([sequence]) + [None] * len(words),
            word=pa.concat_arrays([pa.nulls(1, pa.string()), named]),
            number=[None, *numbers.tolist()],
            uses=[None, *uses.tolist()],
        )


def _occurrences(docs: DataFrame) -> DataFrame:
    """A row per block with its words in order, and a row per block and word with its uses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, first, held = 0, TaskContext.get().partitionId() << BLOCK_BITS, {}
        for batch in batches:
            words: dict[str, list[bytes]] = {}
            texts = batch.column(0).cast(pa.large_binary()).to_pylist()
            for text, lang in zip(texts, batch.column(1).to_pylist()):
                cut = (text or b"").translate(_BYTES).replace(b"\n", b" \n ").split(b" ")
                words.setdefault(lang, []).extend(cut)
                words[lang].append(_BREAK)
            for lang, cut in words.items():
                held.setdefault(lang, _Texts()).add(cut)
            while held and sum(x.size for x in held.values()) >= BLOCK_WORDS:
                lang = max(held, key=lambda name: held[name].size)
                yield held.pop(lang).rows(first + block, lang)
                block += 1
            if block + len(held) >> BLOCK_BITS:
                raise ValueError("a task has too many blocks")
        for lang, texts in held.items():
            yield texts.rows(first + block, lang)
            block += 1

    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    columns = "block long, lang string, sequence binary, word string, number long, uses long"
    return docs.select(F.col("text").cast("string"), lang).mapInArrow(run, columns)


def _counted(groups: DataFrame, by: list[str], least: int) -> DataFrame:
    """Rows of groups with ``total`` uses of at least ``least``, and the group's ``id``: the
    first block and number that holds it. A group has one row per block."""
    same = Window.partitionBy(*by)
    own = F.shiftleft("block", NUMBER_BITS) + F.col("number")
    counted = groups.select(
        "*", F.sum("uses").over(same).alias("total"), F.min(own).over(same).alias("id")
    )
    frequent = counted.where(F.col("total") >= least)
    # The row that names a group describes it; the others only tell its id to their block.
    once = [F.when(own == F.col("id"), F.col(c)).alias(c) for c in (*by, "total")]
    return frequent.select("block", "number", "id", *once)


def _persisted(block: int, places: np.ndarray, groups: np.ndarray, ids: np.ndarray) -> dict:
    """A block of a relation: steps between places, group numbers, and the groups' ids."""
    steps, groups = as_rows([np.diff(places, prepend=0), groups])
    ids = ids.astype("<i8").tobytes()
    return {"block": [block], "steps": [steps], "groups": [groups], "ids": [ids]}


def _keep(numbers: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray]:
    """New numbers of the frequent groups (-1 for the others), and their ids."""
    known = numbers["number"].to_numpy()
    order = np.argsort(known)
    new = np.full(size, -1, np.int32)
    new[known[order]] = np.arange(len(known))
    return new, numbers["id"].to_numpy()[order]


def _semi_joined(
    block: int, places: np.ndarray, groups: np.ndarray, frequent: pa.Table
) -> pa.Table:
    new, ids = _keep(frequent, int(groups.max(initial=0)) + 2)
    groups = new[groups]
    kept = groups >= 0
    return pa.table(_persisted(block, places[kept], groups[kept], ids), _RELATION)


def _frequent_words(texts: pa.Table, frequent: pa.Table) -> pa.Table:
    """R(1) of a block: places of frequent words."""
    if not len(texts):
        return _RELATION.empty_table()
    sequence = of_row(texts["sequence"][0].as_py())
    block = texts["block"][0].as_py()
    return _semi_joined(block, np.arange(len(sequence)), sequence, frequent)


def _pairs(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Merge-join of a block's relation with itself by neighbouring places: where the pairs
    begin, and the two groups of each as one number."""
    places, groups = np.cumsum(of_row(row["steps"]), dtype=np.int32), of_row(row["groups"])
    next_to = np.flatnonzero(places[1:] == places[:-1] + 1)
    pairs = groups[next_to].astype(np.int64) << 32
    pairs |= groups[next_to + 1]
    return places[next_to], pairs


def _groups(relation: DataFrame) -> DataFrame:
    """The phrases one word longer than the relation's, counted per block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                kinds, uses = np.unique(_pairs(row)[1], return_counts=True)
                ids = np.frombuffer(row["ids"], "<i8")
                for a, b in slices(len(kinds), ROWS_OUT):
                    yield table(
                        _GROUPS,
                        first=pa.array(ids[kinds[a:b] >> 32]),
                        second=pa.array(ids[kinds[a:b] & 0xFFFFFFFF]),
                        block=pa.array(np.full(b - a, row["block"])),
                        number=pa.array(np.arange(a, b)),
                        uses=pa.array(uses[a:b]),
                    )

    return relation.mapInArrow(run, _GROUPS_SQL)


def _frequent_groups(relation: pa.Table, frequent: pa.Table) -> pa.Table:
    """R(k+1) of a block: places of frequent phrases one word longer."""
    if not len(relation) or not len(frequent):
        return _RELATION.empty_table()
    row = relation.to_pylist()[0]
    places, pairs = _pairs(row)
    number = np.searchsorted(np.unique(pairs), pairs)
    return _semi_joined(row["block"], places, number, frequent)


def _narrowed(relation: DataFrame, frequent: DataFrame, how, name: str) -> DataFrame:
    found = frequent.select(F.col("block").alias("of"), "number", "id")
    cogrouped = relation.groupBy("block").cogroup(found.groupBy("of"))
    return stored(cogrouped.applyInArrow(how, _RELATION_SQL), name)


def phrases(
    docs: DataFrame, longest: int = 3, least: int = 10
) -> tuple[list[DataFrame], DataFrame]:
    """Frequent phrases by length from 1 to ``longest``, and the words of each language.

    Length 1: ``id``, ``lang``, ``word``, ``total``. Longer: ``id``, ``total``, and ``first``
    and ``second``, the ids of the phrase without its last and without its first word.
    """
    words = stored(_occurrences(docs), "occurrences")
    uses = words.where(F.col("word").isNotNull()).drop("sequence")
    counted = stored(_counted(uses, ["lang", "word"], least), "words")
    texts = words.where(F.col("word").isNull()).select("block", "sequence")
    langs = stored(uses.groupBy("lang").agg(F.sum("uses").alias("n")), "languages")
    relation = _narrowed(texts, counted, _frequent_words, "relation")
    levels = [_named(counted, "lang", "word")]
    discard(words)
    for length in range(2, longest + 1):
        counted = stored(_counted(_groups(relation), ["first", "second"], least), "phrases")
        levels.append(_named(counted, "first", "second"))
        if length < longest:
            narrower = _narrowed(relation, counted, _frequent_groups, "relation")
            discard(relation)
            relation = narrower
    return levels, langs


def _named(counted: DataFrame, *by: str) -> DataFrame:
    """One row per group, of those that ``_counted`` gave."""
    return counted.where(F.col("total").isNotNull()).select("id", *by, "total")


def _described(levels: list[DataFrame]) -> list[DataFrame]:
    """Phrases of two words or more, with their words and the totals of all their beginnings
    and ends, shortest first: each takes them from the two phrases one word shorter."""
    none = F.array().cast("array<bigint>")
    words = F.array("word").alias("words")
    whole = levels[0].select(
        "id", "lang", words, "total", none.alias("heads"), none.alias("tails")
    )
    out = []
    for level in levels[1:]:
        head = whole.select(
            F.col("id").alias("first"),
            "lang",
            F.col("words").alias("begin"),
            F.concat("heads", F.array("total")).alias("heads"),
        )
        tail = whole.select(
            F.col("id").alias("second"),
            F.element_at("words", -1).alias("last"),
            F.concat("tails", F.array("total")).alias("tails"),
        )
        whole = stored(
            level.join(head, "first")
            .join(tail, "second")
            .withColumn("words", F.concat("begin", F.array("last")))
            .select("id", "first", "second", "lang", "words", "total", "heads", "tails"),
            "described",
        )
        out.append(whole)
    return out


def _scored(found: DataFrame, length: int) -> DataFrame:
    """The lowest score over all cuts, with the totals of its two parts."""
    wide = lambda c: c.cast("decimal(16,0)")
    million, a = F.lit(1_000_000).cast("decimal(7,0)"), wide(F.col("total"))
    cuts = []
    for k in range(1, length):
        l, r = F.col("heads")[k - 1], F.col("tails")[length - k - 1]
        score = F.call_function("div", million * a * a, wide(l) * wide(r))
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r")))
    return found.withColumn("cut", F.array_min(F.array(*cuts)))


def collocations(
    docs: DataFrame, longest: int = 3, least: int = 10, share: int = 50, top: int = 2000
) -> DataFrame:
    """The ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a`` (its uses),
    ``l``, ``r`` (uses of its two parts), ``n`` (words of the language), ``score``.

    A phrase with at least ``share`` percent of its uses inside one that is a word longer is
    left out. (Inside a phrase two words longer it also stands in one a word longer, which is
    at least as frequent.)
    """
    levels, langs = phrases(docs, longest, least)
    described = _described(levels)
    kept = []
    for length, found in enumerate(described, 2):
        scored = _scored(found, length)
        if length < longest:
            longer = described[length - 1]
            ends = longer.select(F.col("first").alias("id"), F.col("total").alias("longer"))
            ends = ends.union(longer.select("second", "total"))
            most = ends.groupBy("id").agg(F.max("longer").alias("longer"))
            inside = F.col("longer") * 100 >= F.col("total") * share
            scored = scored.join(most, "id", "left").where(~F.coalesce(inside, F.lit(False)))
        text, a = F.array_join("words", " ").alias("phrase"), F.col("total").alias("a")
        kept.append(scored.select("lang", text, a, "cut.l", "cut.r", "cut.score"))
    rows = kept[0]
    for more in kept[1:]:
        rows = rows.union(more)
    ranked = best(rows, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top)
    rank = F.col("rank").cast("long").alias("rank")
    return ranked.join(langs, "lang").select("lang", rank, "phrase", "a", "l", "r", "n", "score")


ORACLE = """
WITH pieces AS (
  SELECT doc, lang, unnest(range(1, len(cut) + 1)) AS piece, unnest(cut) AS piece_text FROM (
    SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
      string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]') AS cut
    FROM documents)),
words AS (
  SELECT doc, lang, piece, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM (
    SELECT doc, lang, piece, regexp_extract_all(piece_text, '[^\\x20\\x09]+') AS w FROM pieces)),
runs AS (
  SELECT lang, word,
    lead(word) OVER p AS second, lead(word, 2) OVER p AS third
  FROM words WINDOW p AS (PARTITION BY doc, piece ORDER BY pos)),
one AS (SELECT lang, word, count(*) AS f FROM words GROUP BY ALL),
two AS (SELECT lang, word, second, count(*) AS f FROM runs WHERE second IS NOT NULL GROUP BY ALL
  HAVING count(*) >= 10),
three AS (SELECT lang, word, second, third, count(*) AS f FROM runs WHERE third IS NOT NULL
  GROUP BY ALL HAVING count(*) >= 10),
longer AS (
  SELECT lang, word, second, max(f) AS f FROM (
    SELECT lang, word, second, f FROM three
    UNION ALL SELECT lang, second, third, f FROM three) GROUP BY ALL),
cuts AS (
  SELECT two.lang, two.word || ' ' || two.second AS phrase, two.f AS a, x.f AS l, y.f AS r, 1 AS k
  FROM two JOIN one x ON x.lang = two.lang AND x.word = two.word
    JOIN one y ON y.lang = two.lang AND y.word = two.second
    LEFT JOIN longer ON longer.lang = two.lang AND longer.word = two.word
      AND longer.second = two.second
  WHERE coalesce(100 * longer.f >= 50 * two.f, false) = false
  UNION ALL
  SELECT t.lang, t.word || ' ' || t.second || ' ' || t.third, t.f, x.f, y.f, 1
  FROM three t JOIN one x ON x.lang = t.lang AND x.word = t.word
    JOIN two y ON y.lang = t.lang AND y.word = t.second AND y.second = t.third
  UNION ALL
  SELECT t.lang, t.word || ' ' || t.second || ' ' || t.third, t.f, x.f, y.f, 2
  FROM three t JOIN two x ON x.lang = t.lang AND x.word = t.word AND x.second = t.second
    JOIN one y ON y.lang = t.lang AND y.word = t.third),
scored AS (
  SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
lowest AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang
    ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM lowest)
SELECT ranked.lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN (SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY lang) t
  ON t.lang = ranked.lang
WHERE rank <= 2000
"""
