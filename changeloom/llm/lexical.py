"""Ranked lexical search in buckets of vectors of like length.

A document is a vector of term impacts, an item a vector of term weights, and a score their
product. With each coordinate scaled by the root of the term's weight, lengths bound scores by
Cauchy and Schwarz. All vectors are ordered by length and lie in buckets of ``BUCKET``. For each
item and bucket:

* the bucket is passed over if its greatest length times the item's is below the score that the
  item's last place so far has, or if the greatest impact in each coordinate gives no more;
* inside, shorter vectors fall off at the first too short one, and of the rest those whose exact
  share in the item's heaviest coordinates, plus the bound for all others, stays below;
* survivors are scored exactly, in whole numbers.

Bounds only ever drop what cannot be among the best, so results are exact. The places start from
the ``SEEDS`` longest vectors, so that tasks of shorter ones can pass over their buckets at once.

Terms, weights and impacts come from all documents, whole. Documents keep the terms that some item
has, no others; items go through in blocks of at most ``TERMS`` different terms (or one item),
whose terms are broadcast. Tasks keep the best of each item, and these are merged in two steps.

Defined results: null and empty texts have no terms and are never found. Items with the same
id are ranked each for itself, rows repeated in full once. Documents with equal ids are rows of
their own; null ids stand last among equal scores. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import stored
from .text import Texts, lists, pieces, span_hashes

PLACES, BUCKET, SEEDS, TERMS, FOCUS = 50, 1024, 4096, 1 << 18, 3
#: Bounds are compared with this much to spare, far more than rounding takes.
SPARE = 1 + 1e-9

_TERM = np.zeros(256, bool)
_TERM[ord("0") : ord("9") + 1] = True
_TERM[ord("A") : ord("Z") + 1] = True
_TERM[ord("a") : ord("z") + 1] = True
_TERM[0x80:] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32


def term_spans(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, and starts, ends and rows of the terms."""
    data, n = _FOLD[texts.data], len(texts.data)
    inside = _TERM[data]
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = ~inside[:-1], ~inside[1:]
    edges = texts.offsets[(texts.offsets > 0) & (texts.offsets < n)]
    before[edges] = True
    after[edges - 1] = True
    starts = np.flatnonzero(inside & before)
    return data, starts, np.flatnonzero(inside & after) + 1, np.searchsorted(texts.offsets, starts, "right") - 1


@dataclass
class Terms:
    """Different terms, by their hashes; the bytes settle equal hashes."""

    hashes: np.ndarray  # sorted
    flat: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @staticmethod
    def of(words: list[bytes]) -> Terms:
        flat = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        hashes = span_hashes(flat, ends - sizes, ends)
        order = np.argsort(hashes)
        if len(hashes) > 1 and (np.diff(hashes[order]) == 0).any():
            raise ValueError("two terms have the same hash")
        return Terms(hashes[order], flat, (ends - sizes)[order], sizes[order])

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The place of each span among the terms, or -1."""
        if not len(self) or not len(starts):
            return np.full(len(starts), -1, np.int64)
        hashes = span_hashes(data, starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self) - 1)
        hit = np.flatnonzero((self.hashes[at] == hashes) & (self.sizes[at] == ends - starts))
        sizes = self.sizes[at[hit]]
        bounds = np.cumsum(sizes) - sizes
        step = np.arange(sizes.sum()) - np.repeat(bounds, sizes)
        same = data[np.repeat(starts[hit], sizes) + step] == self.flat[np.repeat(self.starts[at[hit]], sizes) + step]
        found = np.full(len(starts), -1, np.int64)
        if len(hit):
            equal = np.logical_and.reduceat(same, bounds)
            found[hit[equal]] = at[hit[equal]]
        return found


def _counted(terms):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Length of each document, and its known terms with their counts."""
        known: Terms = terms.value
        for batch in batches:
            for texts in pieces(batch.column("text")):
                data, starts, ends, row = term_spans(texts)
                place = known.find(data, starts, ends)
                hit = place >= 0
                codes, tf = np.unique(row[hit] * max(len(known), 1) + place[hit], return_counts=True)
                sizes = np.bincount(codes // max(len(known), 1), minlength=len(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(texts.rows.start, len(texts)),
                        pa.array(np.bincount(row, minlength=len(texts)).astype(np.int64)),
                        lists((codes % max(len(known), 1)).astype(np.int32), sizes, pa.int32()),
                        lists(tf.astype(np.int64), sizes, pa.int64()),
                    ],
                    ["id", "n", "terms", "tf"],
                )

    return run


@dataclass
class Queries:
    """Items of a block: places of their terms, and weights of all terms."""

    terms: list[np.ndarray]
    weights: np.ndarray
    lengths: np.ndarray

    def __init__(self, terms: list[np.ndarray], weights: np.ndarray):
        # Terms that no document or all have weigh nothing.
        self.terms = [t[weights[t] > 0] for t in terms]
        self.terms = [t[np.argsort(-weights[t], kind="stable")] for t in self.terms]
        self.weights = weights
        self.lengths = np.sqrt([weights[t].sum() for t in self.terms], dtype=np.float64)


class _Best:
    """The best documents of each item that a task has met."""

    def __init__(self, n: int, least: np.ndarray):
        self.scores = [np.zeros(0, np.int64) for _ in range(n)]
        self.ids = [np.zeros(0, np.int64) for _ in range(n)]
        self.missing = [np.zeros(0, bool) for _ in range(n)]
        self.least = least.copy()

    def add(self, k: int, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        some = scores >= max(self.least[k], 1)
        if not some.any():
            return
        scores = np.concatenate([self.scores[k], scores[some]])
        ids = np.concatenate([self.ids[k], ids[some]])
        missing = np.concatenate([self.missing[k], missing[some]])
        order = np.lexsort((ids, missing, -scores))[:PLACES]
        self.scores[k], self.ids[k], self.missing[k] = scores[order], ids[order], missing[order]
        if len(order) == PLACES:
            self.least[k] = max(self.least[k], scores[order[-1]])

    def batch(self, part: int) -> pa.RecordBatch:
        sizes = [len(x) for x in self.scores]
        ids, missing = np.concatenate(self.ids), np.concatenate(self.missing)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(sizes)), sizes).astype(np.int32)),
                pa.array(ids, pa.int64(), mask=missing),
                pa.array(np.concatenate(self.scores)),
                pa.array(np.full(len(ids), part, np.int32)),
            ],
            ["item", "id", "score", "part"],
        )


def search_bucket(queries: Queries, best: _Best, ids, missing, lengths, row, term, impact) -> int:
    """One bucket, its vectors longest first, through all items; how many were scored.

    ``row``, ``term``, ``impact``: the vectors' coordinates.
    """
    order = np.argsort(term, kind="stable")
    row, term, impact = row[order], term[order], impact[order]
    cuts = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.zeros(0, np.int64)
    names, ends = term[cuts], np.append(cuts[1:], len(term))
    most = np.maximum.reduceat(impact, cuts) if len(cuts) else np.zeros(0, np.int64)
    weights, n, scored = queries.weights, len(lengths), 0
    if not len(names):
        return 0
    for k in np.flatnonzero(queries.lengths * lengths[0] * SPARE >= np.maximum(best.least, 1)).tolist():
        own = queries.terms[k]
        at = np.minimum(np.searchsorted(names, own), len(names) - 1)
        there = names[at] == own
        own, at = own[there], at[there]
        if not len(own):
            continue
        need = max(best.least[k], 1)
        if int((weights[own] * most[at]).sum()) < need:
            continue
        # Vectors that are long enough, and what the heaviest coordinates leave of their length.
        long = int(np.searchsorted(-lengths * queries.lengths[k] * SPARE, -need, "right"))
        heavy = min(FOCUS, len(own))
        exact, taken = np.zeros(long, np.float64), np.zeros(long, np.float64)
        for t, a in zip(own[:heavy].tolist(), at[:heavy].tolist(), strict=True):
            rows, x = row[cuts[a] : ends[a]], impact[cuts[a] : ends[a]]
            inside = rows < long
            exact[rows[inside]] += weights[t] * x[inside]
            taken[rows[inside]] += weights[t] * x[inside].astype(np.float64) ** 2
        left = np.sqrt(max(float(weights[own[heavy:]].sum()), 0.0))
        rest = np.sqrt(np.maximum(lengths[:long] ** 2 * SPARE - taken, 0)) * left
        good = (exact + rest) * SPARE >= need
        if not good.any():
            continue
        sizes = (ends - cuts)[at]
        take = np.arange(sizes.sum()) + np.repeat(cuts[at] - np.cumsum(sizes) + sizes, sizes)
        rows = row[take]
        inside = rows < long
        inside[inside] = good[rows[inside]]
        scores = np.zeros(n, np.int64)
        np.add.at(scores, rows[inside], (np.repeat(weights[own], sizes) * impact[take])[inside])
        some = np.flatnonzero(good)
        scored += len(some)
        best.add(k, scores[some], ids[some], missing[some])
    return scored


def _searched(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Vectors come longest first."""
        queries, least = shared.value
        best = _Best(len(queries.terms), least)
        for batch in batches:
            for first in range(0, len(batch), BUCKET):
                part = batch.slice(first, BUCKET)
                terms = part.column("terms")
                sizes = terms.value_lengths().to_numpy()
                ids = part.column("id")
                search_bucket(
                    queries,
                    best,
                    ids.fill_null(0).to_numpy(),
                    ids.is_null().to_numpy(zero_copy_only=False),
                    part.column("length").to_numpy(),
                    np.repeat(np.arange(len(part)), sizes),
                    np.asarray(terms.flatten()).astype(np.int64),
                    np.asarray(part.column("impacts").flatten()),
                )
        context = TaskContext.get()
        yield best.batch(context.partitionId() if context else 0)

    return run


def _vectors(weights, total: int, documents: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for batch in batches:
            terms = batch.column("terms")
            sizes = terms.value_lengths().to_numpy()
            flat = np.asarray(terms.flatten())
            tf = np.asarray(batch.column("tf").flatten())
            m = np.array([50 + (50 * n * documents) // total for n in batch.column("n").to_pylist()], np.int64)
            impact = (1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, sizes))
            row = np.repeat(np.arange(len(batch)), sizes)
            square = np.bincount(row, w[flat] * impact.astype(np.float64) ** 2, len(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.sqrt(square)), terms, lists(impact, sizes, pa.int64())],
                ["id", "length", "terms", "impacts"],
            )

    return run


def _merged(tops: DataFrame) -> DataFrame:
    """The best of each item, of one task's rows each at first, then of the groups'."""

    def best(*by: str):
        return F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id")))

    groups = tops.withColumn("group", F.pmod("part", F.lit(32)))
    some = groups.withColumn("r", best("item", "group")).filter(F.col("r") <= PLACES)
    return some.withColumn("rank", best("item").cast("int")).filter(F.col("rank") <= PLACES)


def _items(benchmark: DataFrame, id: str, text: str) -> Iterator[list[tuple[object, list[bytes]]]]:
    """Blocks of items with their different terms."""
    held, known = [], set()
    rows = benchmark.select(F.col(id).alias("id"), F.col(text).alias("text")).distinct()
    for own_id, own_text in rows.orderBy("id", "text").toLocalIterator():
        for texts in pieces(pa.array([own_text], pa.string())):
            data, starts, ends, _ = term_spans(texts)
            raw = data.tobytes()
            words = {raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)}
            if held and len(known | words) > TERMS:
                yield held
                held, known = [], set()
            held.append((own_id, sorted(words)))
            known |= words
    if held:
        yield held


def _block(docs: DataFrame, items: list[tuple[object, list[bytes]]]) -> DataFrame:
    """``item`` (place in the block), ``id``, ``score`` and ``rank``."""
    spark = docs.sparkSession
    context = spark.sparkContext
    words = sorted({w for _, own in items for w in own})
    terms = Terms.of(words)
    sorted_place = {w: int(p) for w, p in zip(words, terms.find(terms.flat, *_ends(words)), strict=True)}
    counted = docs.mapInArrow(_counted(context.broadcast(terms)), "id long, n long, terms array<int>, tf array<long>")
    counted = stored(counted.filter("n > 0"), "lexical-counts")
    sums = counted.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("total")).first()
    if not sums.documents:
        return spark.createDataFrame([], "item int, id long, score long, rank int")
    df = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toArrow()
    found = dict(zip(df.column("term").to_pylist(), df.column("df").to_pylist(), strict=True))
    weights = np.zeros(len(terms), np.int64)
    for term, n in found.items():
        weights[term] = math.floor(1000 * math.log((2 * sums.documents + 2) / (2 * n + 1)))
    queries = Queries([np.array([sorted_place[w] for w in own], np.int64) for _, own in items], weights)
    vectors = counted.mapInArrow(
        _vectors(context.broadcast(weights), sums.total, sums.documents),
        "id long, length double, terms array<int>, impacts array<long>",
    ).filter("length > 0")
    vectors = stored(vectors, "lexical-vectors")
    longest_first = [F.desc("length"), F.asc_nulls_last("id")]
    least = np.zeros(len(items), np.int64)
    top = "item int, id long, score long, part int"
    shared = context.broadcast((queries, least))
    # At most SEEDS vectors, hence at most PLACES results an item.
    seeds = vectors.orderBy(*longest_first).limit(SEEDS).coalesce(1).mapInArrow(_searched(shared), top)
    for row in seeds.groupBy("item").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).collect():
        if row.n == PLACES:
            least[row.item] = row.least
    shared = context.broadcast((queries, least))
    ordered = vectors.repartitionByRange(*longest_first).sortWithinPartitions(*longest_first)
    return _merged(stored(ordered.mapInArrow(_searched(shared), top), "lexical-best"))


def _ends(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum([len(w) for w in words])
    return ends - np.array([len(w) for w in words], np.int64), ends


def search(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``item_id``, ``rank``, ``id`` (a whole number) and ``score`` of each item's best documents."""
    spark = docs.sparkSession
    base = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    kind = benchmark.schema[item_id].dataType.simpleString()
    found = None
    for items in _items(benchmark, item_id, item_text):
        part = _block(base, items)
        names = F.array(*[F.lit(i).cast(kind) for i, _ in items])
        part = part.select(F.get(names, "item").alias("item_id"), "rank", "id", "score")
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, id long, score long")
    return found
