"""N-gram Jaccard join by chosen paths.

Every document is the set of its five-word runs. In each of several runs of the method, all
sets start in one node and are split, level by level, by a sampled token: the least of the
set under a hash order of its own for that level, so that two sets stay together with
probability equal to their similarity. Nodes that are still large are split further, into
two sampled children each, which keeps a similar pair together with a probability that no
longer falls with depth; nodes that are small are compared by brute force. The number of
runs follows from the wanted recall at the threshold.

* Equal sets are one class from the start, so a group of copies costs one row a node.
* Nodes hold 8-byte names only. Sets travel for classes that share a node, once for each
  distinct membership, since isolated pairs meet again in most runs.
* A node that splitting leaves together (many similar sets) is compared in blocks of bounded
  size, a task for each pair of blocks. Intersections are counted in the task; no
  pair is emitted. A pair found in several nodes counts in the first of them only.

Defined results: texts without words (null, empty) link with nothing; a text of fewer than
five words has one run, all its words. Rows repeated in full are documents that link with
each other. Ids can be null or repeated.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import stored
from .text import lists, mix, pieces, seeds

WIDTH, THRESHOLD, RECALL = 5, 0.8, 0.9999
#: Runs beyond those of independent splits: further splits take up tokens of other runs, so that
#: runs do not miss a pair independently. Measured by simulation of the scheme.
MORE_RUNS = 5
#: Splits that every set goes through in a run, and further ones of large nodes.
DEPTH, FURTHER = 3, 3
#: Largest node that is not split further; sets and runs of words in a block.
NODE, BLOCK_SETS, BLOCK_RUNS = 256, 1024, 2_000_000
#: Sets with a common run of words beyond this count are compared by matrix products.
_COMMON = 64


def runs_for(recall: float, threshold: float) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall``."""
    deep = 1.0
    for _ in range(FURTHER):
        deep = 1 - (1 - threshold * deep) ** 2
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**DEPTH * deep)) + MORE_RUNS


def _sets(texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct runs of words, sorted by row and hash."""
    row, runs = texts.shingles(width)
    order = np.lexsort((runs, row))
    row, runs = row[order], runs[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (runs[1:] != runs[:-1])
    return row[new], runs[new]


def _identity(runs: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each set."""
    return mix(np.add.reduceat(mix(runs ^ np.uint64(0x5851F42D4C957F2D)), first))


def _paths(width: int, n_runs: int):
    n = n_runs * DEPTH
    factors, starts = seeds(n, 11) | np.uint64(1), seeds(n_runs, 12)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in pieces(batch.column("text")):
                row, runs = _sets(texts, width)
                rows, first, sizes = np.unique(row, return_index=True, return_counts=True)
                tokens = np.empty((len(rows), n), np.uint64)
                for j in range(n if len(rows) else 0):
                    tokens[:, j] = mix(np.minimum.reduceat(runs * factors[j], first))
                nodes = np.tile(starts, (len(rows), 1))
                for level in range(DEPTH):
                    nodes = mix(nodes ^ tokens[:, level::DEPTH])
                at = texts.rows.start + rows
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").take(pa.array(at)),
                        pa.array(
                            _identity(runs, first).view(np.int64) if len(rows) else [], pa.int64()
                        ),
                        pa.array(sizes.astype(np.int32)),
                        lists(nodes.ravel().view(np.int64), np.full(len(rows), n_runs), pa.int64()),
                        lists(
                            (tokens.ravel() >> np.uint64(32)).astype(np.uint32).view(np.int32),
                            np.full(len(rows), n),
                            pa.int32(),
                        ),
                    ],
                    ["key", "set", "size", "nodes", "tokens"],
                )

    return run


def _members(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in pieces(batch.column("text")):
                row, runs = _sets(texts, width)
                rows, first, sizes = np.unique(row, return_index=True, return_counts=True)
                if len(rows):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(_identity(runs, first).view(np.int64)),
                            lists(runs.view(np.int64), sizes, pa.int64()),
                        ],
                        ["set", "runs"],
                    )

    return run


def common_runs(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of some sorted sets share, as a matrix."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    counts = np.diff(np.append(first, len(values)))
    shared = np.zeros((m, m), np.float32)
    common = np.flatnonzero(counts > _COMMON)
    for at in range(0, len(common), 4096):
        part = common[at : at + 4096]
        has = np.zeros((m, len(part)), np.float32)
        for column, c in enumerate(part):
            has[owner[first[c] : first[c] + counts[c]], column] = 1
        shared += has @ has.T
    for size in np.unique(counts[(counts > 1) & (counts <= _COMMON)]):
        group = owner[first[counts == size][:, None] + np.arange(size)]
        for at in range(0, len(group), max(1, 4_000_000 // size**2)):
            part = group[at : at + max(1, 4_000_000 // size**2)]
            codes = (part[:, :, None] * m + part[:, None, :]).ravel()
            shared += np.bincount(codes, minlength=m * m).reshape(m, m)
    return shared


def _roots(linked: np.ndarray) -> np.ndarray:
    """The least row that each row of a symmetric link matrix reaches."""
    label = np.arange(len(linked))
    left, right = np.nonzero(linked)
    while True:
        new = label.copy()
        np.minimum.at(new, left, label[right])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(threshold: float):
    def one(group: dict[str, list | np.ndarray]) -> pa.RecordBatch | None:
        sets, sides = group["runs"], group["side"]
        sizes = np.array([len(s) for s in sets], np.float64)
        shared = common_runs(sets).astype(np.float64)
        linked = shared >= threshold * (sizes[:, None] + sizes[None, :] - shared) - 1e-9
        np.fill_diagonal(linked, False)
        if group["two"]:
            linked &= sides[:, None] != sides[None, :]
        if not linked.any():
            return None
        root = _roots(linked)
        earlier = [names[names < group["node"]] for names in group["nodes"]]
        known = np.unique(np.concatenate(earlier))
        if len(known):
            has = np.zeros((len(sets), len(known)), np.float32)
            for i, names in enumerate(earlier):
                has[i, np.searchsorted(known, names)] = 1
            linked &= (has @ has.T) == 0
        some = np.flatnonzero((root != np.arange(len(root))) | linked.any(axis=1))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(group["set"][some]),
                pa.array(group["set"][root[some]]),
                pa.array((linked @ group["copies"])[some].astype(np.int64)),
            ],
            ["set", "root", "n_links"],
        )

    def groups(table: pa.Table, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        columns = {c: table.column(c).to_numpy() for c in ("node", "a", "b", "side", "set", "copies")}
        runs, nodes = table.column("runs").combine_chunks(), table.column("nodes").combine_chunks()

        def split(column, start, end):
            part = column.slice(start, end - start)
            flat, ends = part.flatten().to_numpy(), np.cumsum(part.value_lengths().to_numpy())
            return np.split(flat, ends[:-1])

        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            found = one(
                {
                    "node": columns["node"][start],
                    "two": columns["a"][start] != columns["b"][start],
                    "side": columns["side"][start:end],
                    "set": columns["set"][start:end],
                    "copies": columns["copies"][start:end].astype(np.float64),
                    "runs": split(runs, start, end),
                    "nodes": split(nodes, start, end),
                }
            )
            if found is not None:
                yield found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by node and pair of blocks; the last group may go on."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            names = [batch.column(c).to_numpy() for c in ("node", "a", "b")]
            if len(held) > 1 and all(
                x[-1] == held[0].column(c)[0].as_py() for x, c in zip(names, ("node", "a", "b"), strict=True)
            ):
                continue
            table = pa.Table.from_batches(held)
            names = [table.column(c).to_numpy() for c in ("node", "a", "b")]
            new = np.ones(len(table), bool)
            new[1:] = np.any([x[1:] != x[:-1] for x in names], axis=0)
            cuts = np.flatnonzero(new)
            yield from groups(table, cuts)
            held = table.slice(cuts[-1]).combine_chunks().to_batches()
        if held:
            table = pa.Table.from_batches(held)
            yield from groups(table, np.array([0, len(table)]))

    return run


def _further(nodes: DataFrame, classes: DataFrame, n_runs: int) -> DataFrame:
    """Two children for every member of a large node, by tokens that its path has not used."""
    n = n_runs * DEPTH
    place = F.pmod(F.xxhash64("node", "child"), F.lit(n - DEPTH)) + (F.col("run") + 1) * DEPTH
    token = F.get("tokens", F.pmod(place, F.lit(n)).cast("int"))
    children = nodes.join(classes.select("set", "tokens"), "set").withColumn(
        "child", F.explode(F.array(F.lit(0), F.lit(1)))
    )
    node = F.xxhash64("node", "child", token)
    return children.select("set", "run", F.col("node").alias("parent"), "m", node.alias("node"))


def _leaves(classes: DataFrame, n_runs: int) -> DataFrame:
    """Nodes to compare, as (node, set): no larger than wanted, or at the last level, or such
    that a split leaves most members together, as their sets are similar."""
    level = classes.select("set", F.posexplode("nodes").alias("run", "node"))
    sizes = level.groupBy("node").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    level = stored(level.join(sizes, "node"), "jaccard-level")
    leaves = level.filter(F.col("m") <= NODE)
    large = level.filter(F.col("m") > NODE)
    for _ in range(FURTHER):
        if large.isEmpty():
            break
        children = stored(_further(large, classes, n_runs), "jaccard-children")
        sizes = children.groupBy("parent", "node").agg(
            F.count(F.lit(1)).alias("size"), F.first("m").alias("m")
        )
        sizes = stored(sizes, "jaccard-sizes")
        largest = sizes.groupBy(F.col("parent").alias("node")).agg(F.max(2 * F.col("size") - F.col("m")).alias("x"))
        whole = largest.filter("x > 0").select("node")
        leaves = leaves.union(large.join(whole, "node", "left_semi").select(level.columns))
        split = children.join(whole.withColumnRenamed("node", "parent"), "parent", "left_anti")
        sizes = sizes.filter("size > 1").select("node", F.col("size").alias("m"))
        level = stored(split.drop("m").join(sizes, "node").select(level.columns), "jaccard-level")
        leaves = leaves.union(level.filter(F.col("m") <= NODE))
        large = level.filter(F.col("m") > NODE)
    leaves = leaves.union(large)
    members = leaves.groupBy("node").agg(
        F.count(F.lit(1)).alias("m"),
        *(F.sum(F.xxhash64(F.lit(k), "set").cast("decimal(38,0)")).alias(f"content{k}") for k in (0, 1)),
    )
    distinct = members.groupBy("m", "content0", "content1").agg(F.min("node").alias("node"))
    return leaves.select("node", "set").join(distinct.select("node"), "node")


def jaccard_join(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
) -> DataFrame:
    """One row a document: ``key`` (hash of id and text), ``id``, ``n_links`` (other documents
    linked directly, copies included) and ``class_id`` (least id reachable by links), and
    ``first_key``, the key of the row that stands for the class."""
    n_runs = runs_for(recall, threshold)
    base = docs.select(
        F.col(id).alias("id"), F.xxhash64(id, text).alias("key"), F.col(text).alias("text")
    )
    signed = stored(
        base.select("key", "text").mapInArrow(
            _paths(width, n_runs),
            "key long, set long, size int, nodes array<long>, tokens array<int>",
        ),
        "jaccard-paths",
    )
    classes = stored(
        signed.groupBy("set").agg(
            F.count(F.lit(1)).alias("copies"),
            F.min("key").alias("key"),
            F.first("size").alias("size"),
            F.first("nodes").alias("nodes"),
            F.first("tokens").alias("tokens"),
        ),
        "jaccard-classes",
    )
    leaves = stored(_leaves(classes, n_runs), "jaccard-leaves")
    named = leaves.groupBy("set").agg(F.collect_list("node").alias("nodes"))
    named = named.join(classes.select("set", "copies", "size", "key"), "set")
    named = stored(named, "jaccard-named")
    # Texts are always dealt out by key: no other plan holds when the wanted keys are many.
    wanted = named.select("key").hint("merge")
    sets = (
        base.select("key", "text")
        .join(wanted, "key", "left_semi")
        .mapInArrow(_members(width), "set long, runs array<long>")
        .groupBy("set")
        .agg(F.first("runs").alias("runs"))
    )
    weight = leaves.join(named.select("set", "size"), "set").groupBy("node").agg(
        F.sum("size").alias("runs_in"), F.count(F.lit(1)).alias("m")
    )
    blocks = F.ceil(F.greatest(F.col("m") / BLOCK_SETS, F.col("runs_in") / BLOCK_RUNS)).cast("int")
    dealt = (
        leaves.join(weight.select("node", blocks.alias("blocks")), "node")
        .withColumn("side", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "node", "set", "side", F.least("side", "other").alias("a"), F.greatest("side", "other").alias("b")
        )
    )
    rows = dealt.join(named.select("set", "copies", "nodes"), "set").join(sets, "set")
    found = stored(
        rows.repartition("node", "a", "b")
        .sortWithinPartitions("node", "a", "b")
        .mapInArrow(_compare(threshold), "set long, root long, n_links long"),
        "jaccard-found",
    )
    links = found.groupBy("set").agg(F.sum("n_links").alias("n"))
    roots = components(found.select(F.col("set").alias("u"), F.col("root").alias("v")))
    roots = roots.withColumnRenamed("node", "set")
    grouped = (
        classes.select("set", "copies")
        .join(links, "set", "left")
        .join(roots, "set", "left")
        .select(
            "set",
            F.coalesce("root", "set").alias("root"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    keyed = base.select("id", "key").join(signed.select("key", "set").distinct(), "key", "left")
    keyed = stored(
        keyed.join(grouped, "set", "left").select(
            "id", "key", F.coalesce("root", "key").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.col("set").isNull().alias("alone"),
        ),
        "jaccard-keyed",
    )
    least = keyed.filter("NOT alone").groupBy("root").agg(F.min(F.struct("id", "key")).alias("least"))
    return keyed.join(least, "root", "left").select(
        "id",
        "key",
        "n_links",
        F.when(F.col("alone"), F.col("id")).otherwise(F.col("least.id")).alias("class_id"),
        F.when(F.col("alone"), F.col("key")).otherwise(F.col("least.key")).alias("first_key"),
    )
