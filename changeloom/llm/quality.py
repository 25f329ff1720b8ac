"""Quality classifier: ordinal cumulative-link regression on graded ratings.

``P(grade <= k) = logistic(threshold[k] - score)``: all grades share one weight vector over
hashed text, and the thresholds are ordered by construction. A document's score sums the
weights of its distinct words, and of word endings and word shapes by their share of the text. Weights only lower the grade: faults show, while a text without any needs no
words in its favour, however short it is. The model gives the expected grade and the tail probability of the top grade.

Grades come from ``labels``: 0 for low quality, 1 for good but toxic, 2 for good and clean.
A document with several labels takes the lowest. The model is fitted on a bounded sample, at
most ``SAMPLE`` labelled documents of each grade, the first by a hash of their id; scoring
covers every document, whole. Grades weigh by the root of their share of all labels.

Defined results: null and empty texts have a score of 0. Labels with nulls and of unknown
documents are left out. Without labels of two grades at least, or features that tell them apart, there is
nothing to learn, and every document gets the top grade. Input columns come back inside ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import Texts, lists, mix, pieces, span_hashes

GRADES, SAMPLE, BITS = 3, 3000, 18
#: Features in fewer documents of the sample are left out, and those whose means on the two
#: sides of every threshold differ by fewer standard errors, or by less than this share of the
#: mean below; weight of the penalty; steps.
LEAST, ERRORS, EFFECT, PENALTY, STEPS = 4, 4.0, 0.75, 1e-5, 1500

_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LOWER = np.zeros(256, bool)
_LOWER[ord("a") : ord("z") + 1] = True
_LOWER[0x80:] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_MARK = np.zeros(256, bool)
_MARK[list(b".,;:!?)\"'")] = True


def _bucket(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (mix(hashes ^ np.uint64(kind << 56)) >> np.uint64(64 - BITS)).astype(np.int64)


def _tokens(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of what counts by its share: endings, shapes, repeats."""
    data, starts, ends = texts.data, texts.starts, texts.ends
    ending = np.zeros(len(starts), np.uint64)
    for back in (1, 2, 3):
        at = ends - back
        ending = (ending << np.uint64(8)) | np.where(at >= starts, data[np.maximum(at, 0)], 0).astype(np.uint64)

    def some(which):
        sums = np.concatenate([[0], np.cumsum(which[data])])
        return sums[ends] > sums[starts]

    again = np.zeros(len(starts), bool)
    again[1:] = (texts.words[1:] == texts.words[:-1]) & (texts.row[1:] == texts.row[:-1])
    shape = some(_UPPER) * 4 + some(_LOWER) * 2 + again
    buckets = [_bucket(ending, 2), _bucket(shape.astype(np.uint64), 3)]
    return np.concatenate(buckets), np.tile(texts.row, 2)


def _distinct(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of the distinct words of each row, without case and closing marks."""
    starts, ends = texts.starts, texts.ends.copy()
    for _ in range(3):
        ends -= _MARK[texts.data[ends - 1]] & (ends - starts > 1)
    codes = np.unique(texts.row << BITS | _bucket(span_hashes(_FOLD[texts.data], starts, ends), 4))
    return codes & ((1 << BITS) - 1), codes >> BITS


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse vectors of the sample; distinct words stand in the second half."""
    for batch in batches:
        for texts in pieces(batch.column("text")):
            bucket, row = _tokens(texts)
            codes, counts = np.unique(row << BITS | bucket, return_counts=True)
            share = counts / texts.counts[codes >> BITS]
            bucket, row = _distinct(texts)
            all_rows = np.concatenate([codes >> BITS, row])
            columns = np.concatenate([codes & ((1 << BITS) - 1), bucket + (1 << BITS)])
            values = np.concatenate([share, np.ones(len(row))])
            order = np.argsort(all_rows, kind="stable")
            sizes = np.bincount(all_rows, minlength=len(texts))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("grade").slice(texts.rows.start, len(texts)),
                    lists(columns[order].astype(np.int32), sizes, pa.int32()),
                    lists(values[order].astype(np.float32), sizes, pa.float32()),
                ],
                ["grade", "columns", "values"],
            )


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, texts: Texts) -> np.ndarray:
        n = len(texts)
        bucket, row = _tokens(texts)
        shares = np.bincount(row, self.weights[bucket], n) / np.maximum(texts.counts, 1)
        bucket, row = _distinct(texts)
        return shares + np.bincount(row, self.weights[bucket + (1 << BITS)], n)

    def grades(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade and probability of the top grade."""
        above = 1 / (1 + np.exp(np.clip(self.thresholds[:, None] - scores, -500, 500)))
        return above.sum(axis=0), above[-1]


def telling(grades: np.ndarray, row: np.ndarray, column: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether each feature is clearly more common in the documents below some grade.

    Most words of a text say nothing of its grade; in a sum over hundreds of them, weights
    fitted to chance would drown those of the few that do.
    """
    n = int(column.max()) + 1 if len(column) else 0
    found = np.zeros(n, bool)
    for k in range(1, GRADES):
        above = grades >= k
        sides = []
        for side in (above, ~above):
            own, many = side[row], max(side.sum(), 1)
            mean = np.bincount(column[own], value[own], n) / many
            square = np.bincount(column[own], value[own] ** 2, n) / many
            sides.append((mean, np.maximum(square - mean**2, 0) / many))
        (a, va), (b, vb) = sides
        if above.any() and not above.all():
            clear = np.abs(a - b) > ERRORS * np.sqrt(va + vb) + 1e-12
            found |= clear & (b - a > EFFECT * b)  # more of it below
    return found & (np.bincount(column, minlength=n) >= LEAST)


def fit_vectors(
    grades: np.ndarray, row: np.ndarray, column: np.ndarray, value: np.ndarray, shares: np.ndarray
) -> Model:
    """Maximum penalised likelihood by full-batch gradient steps, no weight above zero.

    ``shares``: of the grades among all labelled documents, which the sample stands for.
    Plain gradients favour what many documents share over what tells single ones apart.
    """
    weights = np.zeros(2 << BITS)
    present = np.unique(grades)
    if len(present) < 2:
        return Model(weights, np.full(GRADES - 1, -500.0))
    kept = telling(grades, row, column, value)[column]
    row, value = row[kept], value[kept]
    used, column = np.unique(column[kept], return_inverse=True)
    if not len(used):
        return Model(weights, np.full(GRADES - 1, -500.0))
    # Rare grades count for more than their share, by its root, and common ones for less.
    n, balance = len(grades), (np.sqrt(shares) / np.maximum(np.bincount(grades, minlength=GRADES), 1))[grades]
    balance = balance / balance.sum()
    # Presence counts as it is; shares are put on the scale of their spread.
    spread = np.sqrt(np.maximum(np.bincount(column, value**2, len(used)) / n, 1e-12))
    spread[used >= 1 << BITS] = 1
    value = value / spread[column]

    def times(w):
        return np.bincount(row, w[column] * value, n)

    def back(d):
        return np.bincount(column, d[row] * value, len(used))

    # The steepest curvature, by power iteration, bounds the step.
    probe, size = np.ones(len(used)), 1.0
    for _ in range(20):
        probe = back(balance * times(probe / max(np.linalg.norm(probe), 1e-30)))
        size = max(np.linalg.norm(probe), 1e-9)
    rate = 1 / (size + 2 + PENALTY)
    w, cuts = np.zeros(len(used)), np.arange(GRADES - 1, dtype=np.float64)
    at_w, at_cuts, momentum = w, cuts, 0
    for _ in range(STEPS):
        edges = np.concatenate([[-np.inf], at_cuts, [np.inf]])
        score = times(at_w)
        with np.errstate(over="ignore"):
            low = 1 / (1 + np.exp(score - edges[grades]))
            high = 1 / (1 + np.exp(score - edges[grades + 1]))
        chance = np.maximum(high - low, 1e-12)
        d_low, d_high = low * (1 - low) / chance * balance, high * (1 - high) / chance * balance
        by_edge = np.bincount(grades, d_low, GRADES + 1) - np.bincount(grades + 1, d_high, GRADES + 1)
        slope = back(d_high - d_low) + PENALTY * at_w
        new_w = np.minimum(at_w - rate * slope, 0)
        # The loss is convex in weights and thresholds together, and so is their order.
        new_cuts = at_cuts - rate * by_edge[1:GRADES]
        new_cuts = np.maximum.accumulate(new_cuts + np.arange(GRADES - 1) * -0.01) + np.arange(GRADES - 1) * 0.01
        # Momentum starts again whenever it leads uphill.
        momentum = 0 if slope @ (new_w - w) + by_edge[1:GRADES] @ (new_cuts - cuts) > 0 else momentum + 1
        ahead = momentum / (momentum + 3)
        at_w, at_cuts = new_w + ahead * (new_w - w), new_cuts + ahead * (new_cuts - cuts)
        w, cuts = new_w, new_cuts
    weights[used] = w / spread
    return Model(weights, cuts)


def graded(labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``grade`` of the labelled documents."""
    grade = F.when(F.col("quality") < 1, 0).when(F.col("toxic") > 0, 1).otherwise(2)
    known = labels.select("doc_id", "quality", "toxic").dropna()
    return known.groupBy("doc_id").agg(F.min(grade).alias("grade"))


def fit(docs: DataFrame, ratings: DataFrame, id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model:
    """``ratings``: ``doc_id`` and ``grade``. At most ``sample`` documents of each grade count."""
    counts = dict(ratings.groupBy("grade").count().collect())
    shares = np.array([counts.get(g, 0) for g in range(GRADES)], np.float64)
    chosen = None
    for grade in range(GRADES):
        part = ratings.filter(F.col("grade") == grade)
        part = part.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.union(part)
    # At most GRADES * sample rows of two numbers.
    chosen = F.broadcast(chosen.select(F.col("doc_id").alias("rated"), "grade"))
    rated = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).join(
        chosen, F.col("id") == F.col("rated")
    )
    # One text for each id, the same in any order of the rows.
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), "text", "grade")).alias("first")
    rated = rated.groupBy("id").agg(first).select("first.text", F.col("first.grade").cast("int").alias("grade"))
    # Sums of floating-point numbers depend on the order of the rows.
    rated = rated.orderBy("grade", F.xxhash64("text"), "text")
    found = rated.mapInArrow(
        _features, "grade int, columns array<int>, values array<float>"
    ).toArrow()
    counts = found.column("columns").combine_chunks().value_lengths().to_numpy()
    return fit_vectors(
        found.column("grade").to_numpy(),
        np.repeat(np.arange(len(counts)), counts),
        found.column("columns").combine_chunks().flatten().to_numpy(),
        found.column("values").combine_chunks().flatten().to_numpy().astype(np.float64),
        shares,
    )


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``row`` (all input columns), ``score``, ``expected_grade`` and ``p_top``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in pieces(batch.column("text_")):
                scores = model.scores(texts)
                expected, top = model.grades(scores)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(texts.rows.start, len(texts)),
                        pa.array(scores),
                        pa.array(expected),
                        pa.array(top),
                    ],
                    ["row", "score", "expected_grade", "p_top"],
                )

    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text_"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, score double, expected_grade double, p_top double")
