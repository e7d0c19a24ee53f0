"""Quality classifier: cumulative-link (ordered logit) regression on hashed text.

Ratings are grades in order. One weight per hashed feature is shared by all grades, and
ordered thresholds cut the score: P(grade <= k) = sigmoid(threshold_k - score). A document
gets its expected grade and the tail probability of a wanted grade, by which it is selected.

Features of a text are its distinct words and their beginnings, the shapes of its words
(letters, capitals, digits and signs) by their share, and coarse figures (repetition, length),
all hashed into ``BINS``.
The model is fitted on at most ``max_rows`` rated documents, those with the smallest hash of
their id, and keeps features that at least ``min_rows`` of them have; the number of rows is
the only bound, and every document is scored from its whole text.

Rows: a null or empty text has only the figures' features; a null grade is not a rating;
rated ids without a document do not count; without any rating all grades are equally likely;
repeated rows are scored each; a null ``doc_id`` is kept; an empty table gives no row; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from wordloom.llm.common import table

BINS = 1 << 20
MAX_ROWS = 8000
MIN_ROWS = 10
WORDS = 300_000
SHAPE_SCALE = 20.0
BEGINNINGS = (3, 5, 7)

_EDGES = re.compile(r"^\W+|\W+$")
_SHAPES = [(re.compile("[^\\W\\d_]+"), "a"), (re.compile("[0-9]+"), "0")]

EXAMPLES = pa.schema(
    [("grade", pa.int32()), ("bins", pa.list_(pa.int32())), ("values", pa.list_(pa.float32()))]
)
SCORES = pa.schema(
    [("doc_id", pa.int64()), ("expected_grade", pa.float64()), ("tail_probability", pa.float64())]
)


def _bin(feature: str) -> int:
    return xxhash.xxh64_intdigest(feature) % BINS


class Bins(dict):
    """Bins of a word, its beginnings and its shape, remembered up to a bound."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        letters = _EDGES.sub("", word).lower()
        shape = word
        for pattern, sign in _SHAPES:
            shape = pattern.sub("A" if sign == "a" and word.isupper() else sign, shape)
        found = (
            _bin("w " + letters),
            *(_bin("b " + letters[:n]) for n in BEGINNINGS),
            _bin("s " + shape[:12]),
        )
        if len(word) <= 40:
            if len(self) >= WORDS:
                self.clear()
            self[word] = found
        return found


_bins = Bins()


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Bins and values of a text; each bin once."""
    words = (text or "").split()
    distinct = set(words)
    width = len(BEGINNINGS) + 2
    found = np.fromiter(
        chain.from_iterable(map(_bins.__getitem__, distinct)), np.int64, width * len(distinct)
    ).reshape(-1, width)
    names = np.unique(found[:, :-1])
    shapes, counts = np.unique(found[:, -1], return_counts=True)
    lines = [x for x in (text or "").split("\n") if x]
    figures = [
        _bin(f"f distinct {10 * len(distinct) // max(1, len(words))}"),
        _bin(f"f words {len(words).bit_length()}"),
        _bin(f"f lines {10 * len(set(lines)) // max(1, len(lines))}"),
    ]
    bins, place = np.unique(np.r_[names, shapes, figures], return_inverse=True)
    share = SHAPE_SCALE * counts / max(1, len(distinct))
    values = np.r_[np.ones(len(names)), share, np.ones(len(figures))]
    return bins.astype(np.int64), np.bincount(place, values, minlength=len(bins))


@dataclass(frozen=True)
class Model:
    """Weight per bin and ordered thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    def grades(self, score: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade, and the probability of ``wanted`` or a higher one."""
        above = 1.0 - _sigmoid(self.thresholds[None, :] - score[:, None])
        return above.sum(axis=1), above[:, wanted - 1]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit(
    grades: np.ndarray,
    sizes: np.ndarray,
    column: np.ndarray,
    value: np.ndarray,
    levels: int,
    min_rows: int = MIN_ROWS,
    penalty: float = 1e-3,
    rounds: int = 200,
    rate: float = 0.03,
) -> Model:
    """Maximum likelihood with a ridge penalty, by full-batch Adam steps. ``column`` and
    ``value`` hold the features of row after row, ``sizes`` how many each has."""
    counts = np.bincount(grades, minlength=levels) + 1.0
    share = np.cumsum(counts)[:-1] / counts.sum()
    thresholds = np.log(share / (1 - share))
    weights = np.zeros(BINS)
    if not len(grades):
        return Model(weights, thresholds)
    often = np.bincount(column, minlength=BINS) >= min_rows
    used = np.flatnonzero(often)
    place = np.cumsum(often) - 1
    kept = often[column]
    row = np.repeat(np.arange(len(grades), dtype=np.int32), sizes)[kept]
    column, value = place[column[kept]].astype(np.int32), value[kept]
    n, m = len(grades), len(used)
    # Parameters: weights, the first threshold, logs of the gaps between thresholds.
    params = np.r_[np.zeros(m), thresholds[0], np.log(np.diff(thresholds))]
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, rounds + 1):
        gaps = np.exp(params[m + 1 :])
        cuts = params[m] + np.r_[0.0, np.cumsum(gaps)]
        score = np.bincount(row, value * params[column], minlength=n)
        edges = np.r_[-np.inf, cuts, np.inf]
        high, low = (np.where(np.isinf(edges[g]), np.sign(edges[g]) * 40, edges[g] - score)
                     for g in (grades + 1, grades))
        p_high, p_low = _sigmoid(high), _sigmoid(low)
        chance = np.maximum(p_high - p_low, 1e-12)
        d_high, d_low = p_high * (1 - p_high) / chance, p_low * (1 - p_low) / chance
        slope = np.zeros_like(params)
        slope[:m] = np.bincount(column, value * (d_high - d_low)[row], minlength=m) / n
        slope[:m] += penalty * params[:m]
        per_cut = np.zeros(levels + 1)
        np.add.at(per_cut, grades + 1, -d_high / n)
        np.add.at(per_cut, grades, d_low / n)
        per_cut = per_cut[1:levels]
        slope[m] = per_cut.sum()
        slope[m + 1 :] = np.cumsum(per_cut[::-1])[::-1][1:] * gaps
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        params -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights[used] = params[:m]
    return Model(weights, params[m] + np.r_[0.0, np.cumsum(np.exp(params[m + 1 :]))])


def train(
    docs: DataFrame, ratings: DataFrame, levels: int, max_rows: int = MAX_ROWS, **settings
) -> Model:
    """Fit on ``ratings`` (``doc_id, grade`` from 0 to ``levels`` - 1)."""
    rated = ratings.where(F.col("grade").isNotNull() & F.col("doc_id").isNotNull())
    chosen = rated.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(max_rows)
    chosen = chosen.select("doc_id", F.col("grade").cast("int").alias("grade")).distinct()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t) for t in batch.column("text").to_pylist()]
            yield table(
                EXAMPLES,
                grade=batch.column("grade"),
                bins=[b.astype(np.int32) for b, _ in found],
                values=[v.astype(np.float32) for _, v in found],
            )

    # At most max_rows narrow rows on the small side, and as many feature lists back: of the
    # texts of one id the one with the smallest hash counts, combined before the shuffle.
    met = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    hashed = F.struct(F.xxhash64("text").alias("hash"), "text")
    texts = met.groupBy("doc_id", "grade").agg(F.min(hashed)["text"].alias("text"))
    rows = texts.select("grade", "text").mapInArrow(
        each, "grade int, bins array<int>, values array<float>"
    ).toArrow()
    bins = rows["bins"].combine_chunks()
    sizes = np.diff(bins.offsets.to_numpy()) if len(rows) else np.zeros(0, np.int64)
    return fit(
        rows["grade"].to_numpy().astype(np.int64),
        sizes,
        bins.flatten().to_numpy(),
        rows["values"].combine_chunks().flatten().to_numpy(),
        levels,
        **settings,
    )


def score(docs: DataFrame, model: Model, wanted: int, min_tail: float = 0.5) -> DataFrame:
    """``doc_id, expected_grade, tail_probability, selected`` for every document."""
    used = np.flatnonzero(model.weights)
    weights = model.weights[used].astype(np.float32)
    thresholds = model.thresholds

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = np.zeros(BINS)
        full[used] = weights
        own = Model(full, thresholds)
        for batch in batches:
            scores = []
            for text in batch.column("text").to_pylist():
                bins, values = features(text)
                scores.append(full[bins] @ values)
            expected, tail = own.grades(np.array(scores, np.float64), wanted)
            yield table(
                SCORES,
                doc_id=batch.column("doc_id"),
                expected_grade=expected,
                tail_probability=tail,
            )

    scored = docs.select("doc_id", "text").mapInArrow(
        each, "doc_id long, expected_grade double, tail_probability double"
    )
    return scored.withColumn("selected", F.col("tail_probability") >= min_tail)


def grade(quality: str = "quality", toxic: str = "toxic") -> Column:
    """Grades from two labels: 0 toxic, 1 poor, 2 good."""
    return F.when(F.col(toxic) == 1, 0).when(F.col(quality) == 0, 1).when(F.col(quality) == 1, 2)
