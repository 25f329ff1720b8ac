"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into overlapping passages, weighted by TF-IDF with document counts
over the whole corpus, and put into a latent space by a randomised singular value
decomposition: random projection of the passages, orthonormalised through its Gram matrix,
then the eigenvectors of the small projected matrix. All documents are searched, passage by
passage, for a cosine with some benchmark passage in that space. Candidates are settled by
the longest common subsequence of words with the whole item, and by its answer: the item's
last words, which must come in order for a looser match to count.

The passage norm covers all words, those outside the benchmark too. So that rare words around
a copy do not hide it, a passage is also a candidate if it holds a share ``HELD`` of a
benchmark passage's own weight, whatever else it says. Of a whole copy, one of two neighbouring
passages holds half at least. A passage whose known words reach neither is passed over, exactly.

Passages of a set of at most ``ITEMS`` items and ``RANK`` passages go through the search at
once, so that the space has a dimension for every passage and no copy is lost in it. Their
latent table is broadcast: at most ``RANK * PASSAGE`` features of ``RANK`` numbers. A larger
benchmark takes several passes. An item longer than ``LONGEST`` words is searched in parts, and
what a part finds is settled against the whole item. Items under ``LEAST_WORDS`` words have no
passage of their own; they are found where their words stand in a row, at most ``SHORT`` items
a pass.

Defined results: null and empty texts match nothing, and items without words are in no
text. Equal items are found under each of their ids.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import mix, pieces, seeds, window_hashes

BITS, RANK, EXTRA = 20, 512, 16
PASSAGE, STEP = 32, 16
#: Passages whose latent vectors a task holds at once.
TOGETHER = 500
LEAST_WORDS, LONGEST, ITEMS, SHORT = 8, 256, 500, 1 << 16
LEAST_COSINE, HELD, SAME, LIKE, ANSWER, ANSWERED = 0.35, 0.45, 0.85, 0.6, 5, 0.6


def _buckets(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - BITS)).astype(np.int64)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many of a task's documents each bucket occurs; bucket -1 counts documents."""
    counts, documents = np.zeros(1 << BITS, np.int64), 0
    for batch in batches:
        for texts in pieces(batch.column("text")):
            codes = np.unique(texts.row << BITS | _buckets(texts.words))
            counts += np.bincount(codes & ((1 << BITS) - 1), minlength=1 << BITS)
            documents += len(texts)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(some, -1)), pa.array(np.append(counts[some], documents))],
        ["bucket", "n"],
    )


def inverse_frequencies(docs: DataFrame, text: str = "text") -> np.ndarray:
    """IDF of each hashed word: a vector of fixed length, from all documents."""
    found = (
        docs.select(F.col(text).alias("text"))
        .mapInArrow(_document_counts, "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    bucket, n = found.column("bucket").to_numpy(), found.column("n").to_numpy()
    counts = np.zeros(1 << BITS)
    counts[bucket[bucket >= 0]] = n[bucket >= 0]
    return np.log((1 + n[bucket < 0].sum()) / (1 + counts)).astype(np.float32) + np.float32(0.01)


def _cuts(n: int) -> list[int]:
    """Where the passages of n words start; the last one ends with the text."""
    last = max(0, n - PASSAGE)
    return [*range(0, last, STEP), last]


def _vector(buckets: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bucket, counts = np.unique(buckets, return_counts=True)
    weights = counts * idf[bucket].astype(np.float64)
    norm = np.linalg.norm(weights)
    return bucket, weights / norm if norm else weights


def _projection(buckets: np.ndarray, width: int) -> np.ndarray:
    """Rows of a random matrix of signs, a function of the bucket."""
    columns = seeds(width, 21)
    signs = mix(buckets.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) ^ columns[None, :])
    return ((signs & np.uint64(1)).astype(np.float64) * 2 - 1) / np.sqrt(width)


@dataclass
class Index:
    """Latent vectors of one set of items, and their words."""

    idf: np.ndarray
    table: np.ndarray  # line of each bucket, or the last line, which is zero
    basis: np.ndarray  # latent vector of each known bucket
    latent: np.ndarray  # one column for each passage
    norm: np.ndarray  # of each passage, before it was scaled to 1
    most: np.ndarray  # by line: the greatest share that one such word is of a passage
    item: np.ndarray  # of each passage: the whole item that it is from
    words: list[np.ndarray]
    ids: list


def _decompose(passages: DataFrame, idf: np.ndarray, rank: int):
    """Right singular vectors (bucket, vector) of the passages' TF-IDF matrix."""
    width = rank + EXTRA

    def projected(batch: pa.RecordBatch) -> tuple[np.ndarray, list]:
        rows = [_vector(np.array(x), idf) for x in batch.column("buckets").to_pylist()]
        return np.array([w @ _projection(b, width) for b, w in rows]).reshape(-1, width), rows

    def gram(batches):
        total = np.zeros((width, width))
        for batch in batches:
            left, _ = projected(batch)
            total += left.T @ left
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["gram"])

    def summed(df: DataFrame) -> np.ndarray:
        return sum(
            (np.frombuffer(r[0]).reshape(width, width) for r in df.toLocalIterator()),
            np.zeros((width, width)),
        )

    values, vectors = np.linalg.eigh(summed(passages.mapInArrow(gram, "gram binary")))
    good = values > 1e-9 * max(values.max(), 1e-30)
    whiten = vectors[:, good] / np.sqrt(values[good])

    def columns(batches):
        """Q' A, a vector for each bucket of the task's passages."""
        sums: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(whiten.shape[1]))
        for batch in batches:
            left, rows = projected(batch)
            for q, (bucket, weights) in zip(left @ whiten, rows, strict=True):
                for b, w in zip(bucket.tolist(), weights, strict=True):
                    sums[b] += w * q
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())],
                ["bucket", "vector"],
            )

    parts = passages.mapInArrow(columns, "bucket long, vector binary").toArrow()
    vectors = np.array([np.frombuffer(x) for x in parts.column("vector").to_pylist()])
    bucket, where = np.unique(parts.column("bucket").to_numpy(), return_inverse=True)
    small = np.zeros((len(bucket), whiten.shape[1]))
    np.add.at(small, where, vectors)
    values, left = np.linalg.eigh(small.T @ small)
    order = np.argsort(values)[::-1][:rank]
    order = order[values[order] > 1e-9 * values.max()]
    return bucket, small @ left[:, order] / np.sqrt(values[order])


def _index(spark, items: list[tuple[object, np.ndarray, np.ndarray]], idf: np.ndarray, rank: int) -> Index:
    passages, item, owners = [], [], []
    for own_id, words, whole in items:
        # The parts of an item come one after another.
        if not owners or owners[-1][1] is not whole:
            owners.append((own_id, whole))
        k = len(owners) - 1
        for cut in _cuts(len(words)):
            passages.append(_buckets(words[cut : cut + PASSAGE]))
            item.append(k)
    rows = spark.createDataFrame([(x.tolist(),) for x in passages], "buckets array<long>")
    bucket, basis = _decompose(rows, idf, max(rank, len(passages)))
    table = np.full(1 << BITS, len(bucket), np.int32)
    table[bucket] = np.arange(len(bucket))
    basis = np.vstack([basis, np.zeros(basis.shape[1])]).astype(np.float32)
    latent, norms = [], []
    most = np.zeros(len(bucket) + 1)
    for x in passages:
        b, w = _vector(x, idf)
        norms.append(np.linalg.norm(np.unique(x, return_counts=True)[1] * idf[b].astype(np.float64)))
        most[table[b]] = np.maximum(most[table[b]], w / max(norms[-1], 1e-30))
        own = w.astype(np.float32) @ basis[table[b]]
        latent.append(own / max(np.linalg.norm(own), 1e-30))
    most[-1] = 0
    return Index(
        idf, table, basis, np.array(latent).T.copy(), np.array(norms, np.float32), most, np.array(item),
        [w for _, w in owners], [i for i, _ in owners],
    )


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, by bits of a whole number."""
    masks: dict[int, int] = defaultdict(int)
    for k, x in enumerate(a):
        masks[x] |= 1 << k
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & masks.get(x, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def _search(index: Index):
    known_square = np.append(np.ones(len(index.basis) - 1, np.float32), np.float32(0))
    words = [w.tolist() for w in index.words]
    least = HELD * index.norm.min()

    def candidates(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word and end of a passage, and the benchmark passage that it resembles."""
        bucket = _buckets(texts.words)
        line, weight = index.table[bucket], index.idf[bucket]
        counts = texts.counts
        per = np.where(counts > 0, np.maximum(1, -(-(np.maximum(counts, PASSAGE) - PASSAGE) // STEP) + 1), 0)
        row = np.repeat(np.arange(len(texts)), per)
        k = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
        last = texts.bounds[row] + np.maximum(counts[row] - PASSAGE, 0)
        first = np.minimum(texts.bounds[row] + k * STEP, last)
        end = np.minimum(first + PASSAGE, texts.bounds[row + 1])
        square = weight.astype(np.float64) ** 2
        all_sums = np.concatenate([[0], np.cumsum(square)])
        known_sums = np.concatenate([[0], np.cumsum(square * known_square[line])])
        known = known_sums[end] - known_sums[first]
        # Repeated words: the norm is at least this, and the known part at most PASSAGE times.
        total = all_sums[end] - all_sums[first]
        out = [[], [], []]
        could = np.concatenate([[0], np.cumsum(weight * index.most[line])])
        likely = np.flatnonzero(
            (known * PASSAGE >= LEAST_COSINE**2 * total) | (could[end] - could[first] >= HELD)
        )
        for at in range(0, len(likely), TOGETHER):
            part = likely[at : at + TOGETHER]
            sizes = end[part] - first[part]
            starts = np.cumsum(sizes) - sizes
            own = np.arange(sizes.sum()) + np.repeat(first[part] - starts, sizes)
            passage = np.repeat(np.arange(len(part)), sizes)
            codes = passage << BITS | bucket[own]
            order = np.argsort(codes, kind="stable")
            codes = codes[order]
            new = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
            n = np.diff(np.append(new, len(codes)))
            b, p = codes[new] & ((1 << BITS) - 1), codes[new] >> BITS
            values = n * index.idf[b]
            norm = np.sqrt(np.bincount(p, values.astype(np.float64) ** 2, len(part)))
            inside = known_square[index.table[b]] > 0
            share = np.sqrt(np.bincount(p[inside], values[inside].astype(np.float64) ** 2, len(part)))
            bound = np.bincount(p, values * index.most[index.table[b]], len(part))
            good = (share >= LEAST_COSINE * norm) | (share >= least) & (bound >= HELD)
            keep = inside & good[p]
            if not keep.any():
                continue
            p, values, lines = p[keep], values[keep], index.table[b[keep]]
            cuts = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
            some = p[cuts]
            latent = np.add.reduceat(index.basis[lines] * values[:, None].astype(np.float32), cuts, axis=0)
            product = latent @ index.latent
            cosine = product / norm[some][:, None]
            hit, passage = np.nonzero((cosine >= LEAST_COSINE) | (product >= HELD * index.norm))
            out[0].append(part[some[hit]])
            out[1].append(passage)
            out[2].append(cosine[hit, passage])
        if not out[0]:
            return (np.zeros(0, np.int64),) * 4
        which, passage, cosine = (np.concatenate(x) for x in out)
        return row[which], first[which], index.item[passage], cosine

    def settle(own: list[int], item: list[int]) -> tuple[float, float]:
        share = common_subsequence(item, own) / len(item)
        answer = item[-ANSWER:]
        return share, common_subsequence(answer, own) / len(answer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in pieces(batch.column("text")):
                row, first, item, cosine = candidates(texts)
                best: dict[tuple[int, int], tuple] = {}
                done: set[tuple[int, int]] = set()
                order = np.argsort(-cosine, kind="stable")
                for r, at, k, c in zip(row[order].tolist(), first[order].tolist(), item[order].tolist(), cosine[order].tolist(), strict=True):
                    if (at, k) in done:
                        continue
                    done.add((at, k))
                    if best.get((r, k), (0,))[0] >= SAME:
                        continue
                    size = len(words[k])
                    start, end = texts.bounds[r], texts.bounds[r + 1]
                    own = texts.words[max(start, at - size) : min(end, at + PASSAGE + size)].tolist()
                    share, answer = settle(own, words[k])
                    if share >= SAME or share >= LIKE and answer >= ANSWERED:
                        best[r, k] = max(best.get((r, k), (0.0,)), (share, answer, c))
                if best:
                    at = texts.rows.start + np.array([r for r, _ in best])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("id").take(pa.array(at)),
                            batch.column("key").take(pa.array(at)),
                            pa.array([k for _, k in best], pa.int32()),
                            *(pa.array([float(x[j]) for x in best.values()]) for j in range(3)),
                        ],
                        ["id", "key", "item", "share", "answer", "cosine"],
                    )

    return run


def _short(benchmark: DataFrame, id: str, text: str) -> Iterator[list[tuple[object, np.ndarray]]]:
    """Blocks of the items that are too short for a passage."""
    held = []
    for own_id, own_text in benchmark.select(id, text).orderBy(id, text).toLocalIterator():
        for texts in pieces(pa.array([own_text], pa.string())):
            if 0 < len(texts.words) < LEAST_WORDS:
                held.append((own_id, texts.words))
        if len(held) >= SHORT:
            yield held
            held = []
    if held:
        yield held


def _rows_of_words(items: list[np.ndarray]):
    """Documents that hold the words of an item in a row."""
    by_width: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
    for k, words in enumerate(items):
        name = window_hashes(words, np.array([0]), np.array([len(words)]))[0]
        by_width[len(words)][int(name)].append(k)
    known = {n: np.array(sorted(names), np.uint64) for n, names in by_width.items()}
    owners = {n: dict(names) for n, names in by_width.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in pieces(batch.column("text")):
                found = set()
                for width, names in known.items():
                    starts, ends, row = texts.windows(width)
                    hashes = window_hashes(texts.words, starts, ends)
                    at = np.minimum(np.searchsorted(names, hashes), len(names) - 1)
                    hit = np.flatnonzero(names[at] == hashes)
                    for r, name in zip(row[hit].tolist(), hashes[hit].tolist(), strict=True):
                        found.update((r, k) for k in owners[width][name])
                if found:
                    at = pa.array([texts.rows.start + r for r, _ in sorted(found)])
                    whole = pa.array(np.ones(len(found)))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("id").take(at),
                            batch.column("key").take(at),
                            pa.array([k for _, k in sorted(found)], pa.int32()),
                            whole, whole, whole,
                        ],
                        ["id", "key", "item", "share", "answer", "cosine"],
                    )

    return run


def _items(
    benchmark: DataFrame, id: str, text: str, rank: int
) -> Iterator[list[tuple[object, np.ndarray, np.ndarray]]]:
    """Sets of items in the order of their ids: the words of each, long ones in parts, and of the
    whole item. A set of more than one part has at most ``rank`` passages."""
    held: list[tuple[object, np.ndarray, np.ndarray]] = []
    passages = 0
    for own_id, own_text in benchmark.select(id, text).orderBy(id, text).toLocalIterator():
        for texts in pieces(pa.array([own_text], pa.string())):
            n = len(texts.words)
            if n >= LEAST_WORDS:
                parts = -(-n // LONGEST)
                for part in np.array_split(texts.words, parts):
                    more = len(_cuts(len(part)))
                    if held and (len(held) >= ITEMS or passages + more > rank):
                        yield held
                        held, passages = [], 0
                    held.append((own_id, part, texts.words))
                    passages += more
    if held:
        yield held


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    rank: int = RANK,
) -> DataFrame:
    """One row for each document and item found in it: ``id``, ``key`` (hash of id and text),
    ``item_id``, ``share`` (of the item's words found in order), ``answer`` and ``cosine``."""
    spark = docs.sparkSession
    base = docs.select(F.col(id).alias("id"), F.xxhash64(id, text).alias("key"), F.col(text).alias("text"))
    kind, item_kind = (x.dataType.simpleString() for x in (base.schema["id"], benchmark.schema[item_id]))
    found, idf, columns = None, None, f"id {kind}, key long, item int, share double, answer double, cosine double"

    def named(part: DataFrame, ids: list) -> DataFrame:
        names = F.array(*[F.lit(i).cast(item_kind) for i in ids])
        return part.withColumn("item_id", F.get(names, "item")).drop("item")

    for block in _short(benchmark, item_id, item_text):
        part = named(base.mapInArrow(_rows_of_words([w for _, w in block]), columns), [i for i, _ in block])
        found = part if found is None else found.union(part)
    for items in _items(benchmark, item_id, item_text, rank):
        idf = inverse_frequencies(docs, text) if idf is None else idf
        index = _index(spark, items, idf, rank)
        part = named(base.mapInArrow(_search(index), columns), index.ids)
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame(
            [], f"id {kind}, key long, item_id {item_kind}, share double, answer double, cosine double"
        )
    best = F.max(F.struct("share", "answer", "cosine")).alias("best")
    return found.groupBy("id", "key", "item_id").agg(best).select("id", "key", "item_id", "best.*")
