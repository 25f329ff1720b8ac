"""Embedding near-dedup by spherical k-means cells.

Vectors of equal labels are compared by cosine within cells. A vector's home is the cell of
the nearest of some centroids, fitted by spherical k-means on a bounded sample: the first
``SAMPLE`` vectors by hash. All vectors are assigned, and a vector also goes, as a guest, to
every cell whose border it is so close to that a linked vector may live there: for unit
vectors x at home in c and y at home in c', ``y.(c' - c) <= |x - y| |c' - c|``. So no link at
the threshold is lost, and each vector counts its links once, at home, against all residents
and guests. Products are in double precision, in blocks of bounded size: the residents of a cell
ask in blocks, each against all that are in it, so that a vector is sent once for each block of
askers in its cells, most of which have one.

Equal vectors of a label are one class, compared once and counted as often as they occur.

Defined results: vectors that are null, zero, or hold nulls or non-finite numbers, and those
without a label, link with nothing. Vectors of different lengths never link. Ids can be null
or repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .groups import grouped
from .scratch import stored

THRESHOLD, SAMPLE, PER_CELL, CELLS, ROUNDS = 0.98, 8192, 4096, 1024, 12
#: Residents of a cell, and all that are in it, that one product takes at most; and how many
#: residents are multiplied at once.
ASKERS, OTHERS, PART = 4096, 16_384, 128


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaling by the largest part first keeps squares finite."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def spherical_means(vectors: np.ndarray, k: int) -> np.ndarray:
    """Centroids of unit vectors, from the first ones on."""
    centroids = vectors[:k].copy()
    for _ in range(ROUNDS):
        home = (vectors @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, vectors)
        norms = np.linalg.norm(sums, axis=1)
        centroids[norms > 0] = sums[norms > 0] / norms[norms > 0][:, None]
    return centroids


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.float64).reshape(-1, width)


def _assign(centroids: np.ndarray, reach: float):
    """Home and guest cells; other lengths than the centroids' have one cell."""
    gaps = np.linalg.norm(centroids[:, None] - centroids[None, :], axis=2) if len(centroids) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 2048):
                part = batch.slice(start, 2048)
                widths = part.column("vector").value_lengths().to_numpy()
                rows, cells, homes = [], [], []
                for width in np.unique(widths):
                    at = np.flatnonzero(widths == width)
                    if not len(centroids) or width != centroids.shape[1]:
                        rows.append(at)
                        cells.append(np.zeros(len(at), np.int64))
                        homes.append(np.ones(len(at), bool))
                        continue
                    near = _unit(_matrix(part.column("vector").take(pa.array(at)), width)) @ centroids.T
                    home = near.argmax(axis=1)
                    short = near[np.arange(len(at)), home][:, None] - near
                    row, cell = np.nonzero(short <= reach * gaps[home] + 1e-9)
                    rows.append(at[row])
                    cells.append(cell)
                    homes.append(cell == home[row])
                row = np.concatenate(rows)
                picked = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [
                        *picked.columns,
                        pa.array(widths[row], pa.int32()),
                        pa.array(np.concatenate(cells), pa.int32()),
                        pa.array(np.concatenate(homes)),
                    ],
                    [*picked.schema.names, "width", "cell", "home"],
                )

    return run


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (a smaller or equal place for each place) with the places of each pair joined."""
    while True:
        left, right = label[a], label[b]
        apart = left != right
        if not apart.any():
            return label
        a, b, left, right = a[apart], b[apart], left[apart], right[apart]
        least = np.minimum(left, right)
        np.minimum.at(label, left, least)
        np.minimum.at(label, right, least)
        while (label[label] != label).any():
            label = label[label]


def _link(threshold: float, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A group: some residents of a cell (askers) and a block of all that are in it."""
        for table in grouped(batches, ["bucket", "asking", "other"]):
            table = table.combine_chunks()
            width = table.column("width")[0].as_py()
            unit = _unit(_matrix(table.column("vector").combine_chunks(), width))
            name, copies = table.column("class").to_numpy(), table.column("copies").to_numpy()
            asks = table.column("asks").to_numpy(zero_copy_only=False)
            left, right = np.flatnonzero(asks), np.flatnonzero(~asks)
            others, links = unit[right], np.zeros(len(table), np.int64)
            _, first, same = np.unique(name, return_index=True, return_inverse=True)
            label = first[same]  # an asker is also among the others
            for start in range(0, len(left), most):
                some = left[start : start + most]
                linked = unit[some] @ others.T >= threshold
                linked &= name[some][:, None] != name[right][None, :]
                links[some] = linked @ copies[right]
                a, b = np.nonzero(linked)
                label = _joined(label, some[a], right[b])
            found = np.flatnonzero((name[label] != name) | (links > 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(name[found]), pa.array(name[label[found]]), pa.array(links[found])],
                ["class", "root", "n"],
            )

    return run


def embedding_links(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row a vector: ``id``, ``n_links``, ``component_id``, ``kept``."""
    spark = vectors.sparkSession
    values = F.col("vector")
    sound = (
        F.col("label").isNotNull()
        & (F.size(values) > 0)
        & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(values, lambda x: x != 0)
    )
    rows = vectors.select(
        F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("vector"), F.col(label).alias("label")
    )
    rows = rows.withColumn("class", F.when(sound, F.xxhash64("label", "vector")))
    classes = stored(
        rows.filter("class IS NOT NULL")
        .groupBy("class")
        .agg(F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector")),
        "vectors",
    )
    # At most SAMPLE vectors.
    sample = [r[0] for r in classes.orderBy("class").limit(SAMPLE).select("vector").collect()]
    width = max(sorted({len(x) for x in sample}), key=[len(x) for x in sample].count, default=0)
    sample = [x for x in sample if len(x) == width]
    k = min(CELLS, len(sample), -(-classes.count() // PER_CELL))
    centroids = spherical_means(_unit(np.array(sample)), k) if sample else np.zeros((0, 0))
    reach = float(np.sqrt(2 - 2 * threshold))
    kind = classes.schema["label"].dataType.simpleString()
    placed = stored(
        classes.mapInArrow(
            _assign(centroids, reach),
            f"class long, copies long, label {kind}, vector array<double>, width int, cell int, home boolean",
        ).withColumn("bucket", F.xxhash64("label", "width", "cell")),
        "vector-cells",
    )
    # A cell's residents ask block by block, each block against all others of the cell.
    residents, everyone = F.count(F.when(F.col("home"), 1)), F.count(F.lit(1))
    sizes = placed.groupBy("bucket").agg(
        F.ceil(residents / ASKERS).cast("int").alias("asking_blocks"),
        F.ceil(everyone / OTHERS).cast("int").alias("other_blocks"),
    )
    dealt = placed.join(sizes.filter("asking_blocks > 0"), "bucket")
    columns = ["bucket", "class", "copies", "vector", "width"]

    def block(blocks: str) -> Column:
        return F.pmod("class", blocks).cast("int")

    def each(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    asks = dealt.filter("home").withColumn("asking", block("asking_blocks"))
    asks = asks.select(*columns, "asking", each("other_blocks").alias("other"), F.lit(True).alias("asks"))
    told = dealt.withColumn("other", block("other_blocks"))
    told = told.select(*columns, each("asking_blocks").alias("asking"), "other", F.lit(False).alias("asks"))
    found = stored(
        asks.unionByName(told)
        .repartition("bucket", "asking", "other")
        .sortWithinPartitions("bucket", "asking", "other")
        .mapInArrow(_link(threshold, PART), "class long, root long, n long"),
        "vector-links",
    )
    links = found.groupBy("class").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("class").alias("u"), F.col("root").alias("v")))
    roots = roots.select(F.col("node").alias("class"), "root")
    known = (
        classes.select("class", "copies").join(links, "class", "left").join(roots, "class", "left")
        .select("class", F.coalesce("root", "class").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"))
    )
    joined = stored(rows.select("id", "class").join(known, "class", "left"), "vector-rows")
    least = joined.filter("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("least"))
    return joined.join(least, "root", "left").select(
        "id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"),
    ).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
