"""Prefix tries of conversations, with subtree totals by time-forward processing.

Every distinct sequence of first turns is a node. Conversations lie sorted by id and turn in
range partitions, and a node is known by two 64-bit hashes of its turns, running sums along the
conversation that tasks add up side by side, also where one conversation spans many of them.
Nodes are then grouped from the rows, their members counted before the shuffle.

Subtree totals flow from children to parents. A node with one member is a chain down to its end
and needs no messages. All others lie in shards, whole subtrees of at most ``limit`` conversations, about a quarter of an
even share of a task; a task gets its nodes by reverse level order through an external sort,
takes from a queue what children have sent, and sends its own total to the parent. The queue
spills sorted runs to disk. What shard roots send up is summed by parent, and the few nodes
above all shards (at most four a task and level) go through the same pass at last.

The ids of members that end in a node are hashed in order: parts of them become text in parallel,
and only nodes whose members lie in several tasks are put together again, chunk by chunk.

Defined results: rows without a conversation id belong to no conversation. Null roles and
texts are empty. Turns stand in the order of their number, null first; equal numbers by role, then
the first 64 characters of the text, then its SHA-256, and equal rows count as often as they
occur. Without conversations there are no nodes.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scan import carried, carry, power
from .scratch import stored
from .text import mix

EVERY, HEADS = 20, 4
#: Messages that a queue holds in memory; characters of a chunk of ids.
IN_MEMORY, CHUNK = 200_000, 1 << 20
#: No subtree with fewer conversations is split.
LEAST_LIMIT = 64
_U = np.uint64
_BASES = (0xD1342543DE82EF95, 0xA3EC647659359ACD)
ROOT = (0, 0)


def head_length(id: Column) -> Column:
    """How many first turns a conversation takes over."""
    return F.crc32(id.cast("string").cast("binary")) % HEADS


def source(id: Column) -> Column:
    """The conversation that they are taken from."""
    return id - id % EVERY


def _part() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0


# Rows -----------------------------------------------------------------------------------


def _turns(conversations: DataFrame, id: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv``, what its turns are sorted by, two hashes of a turn, and its words."""
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = conversations.filter(F.col(id).isNotNull()).select(
        F.col(id).cast("long").alias("conv"), F.col(turn).alias("turn"), who.alias("who"), said.alias("said")
    )
    return rows.select(
        "conv",
        "turn",
        "who",
        F.left("said", F.lit(64)).alias("begin"),
        F.sha2("said", 256).alias("sha"),
        F.monotonically_increasing_id().alias("line_id"),  # equal rows may lie apart
        F.xxhash64(F.lit(1), "who", "said").alias("h1"),
        F.xxhash64("said", F.lit(2), "who").alias("h2"),
        F.regexp_count("said", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The place of each turn in its conversation, counted from the start of the part."""
    part, lines = _part(), 0

    def take(batch, new, held):
        nonlocal lines
        n, new = len(batch), new.copy()
        if held is not None:
            new[0] = False
        begin = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        rank = np.arange(n) - np.where(begin < 0, -(held or 0) - 1, begin)
        out = pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("conv", "h1", "h2", "words")),
                pa.array(rank),
                pa.array(np.full(n, part, np.int32)),
                pa.array(np.arange(lines, lines + n)),
            ],
            ["conv", "h1", "h2", "words", "rank", "part", "line"],
        )
        lines += n
        return out, int(rank[-1])

    yield from carried(batches, "conv", take)


def _bases(ends: dict[int, tuple[int, object]], add) -> dict[int, tuple[int, object]]:
    """For each part whose first group began before: that group, and what it has until then."""
    out, before = {}, None  # (group, total)
    for part in sorted(ends):
        first, last = ends[part]
        base = before[1] if before is not None and before[0] == first else None
        if base is not None:
            out[part] = (first, base)
        total = add(base, last) if base is not None and last["group"] == first else add(None, last)
        before = (last["group"], total)
    return out


def _ranked(turns: DataFrame) -> DataFrame:
    """``conv``, ``rank`` (from 0), ``h1``, ``h2``, ``words``."""
    order = [
        F.col("conv"), F.col("turn").asc_nulls_first(), F.col("who"), F.col("begin"), F.col("sha"), F.col("line_id"),
    ]
    kinds = "conv long, h1 long, h2 long, words long, rank long, part int, line long"
    numbered = stored(
        turns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_numbered, kinds), "trie-turns"
    )
    ends = carry(numbered.withColumnRenamed("conv", "group"), "group", "rank")
    bases = _bases(ends, lambda base, last: (base or 0) + last["rank"] + 1)
    return _with_base(numbered, bases)


def _with_base(numbered: DataFrame, bases: dict[int, tuple[int, int]]) -> DataFrame:
    # At most one row a part.
    rows = [(part, group, base) for part, (group, base) in bases.items()]
    base = numbered.sparkSession.createDataFrame(rows, "part int, conv long, base long")
    joined = numbered.join(F.broadcast(base), ["part", "conv"], "left")
    rank = F.col("rank") + F.coalesce("base", F.lit(0))
    return joined.select("conv", rank.alias("rank"), "h1", "h2", "words")


def rebuilt(ranked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with their conversation's head replaced, as (conv, side, rank, ...), and all
    conversations."""
    convs = ranked.select("conv").distinct().select("conv", source(F.col("conv")).alias("from"))
    convs = convs.withColumn("head", head_length(F.col("conv")))
    same = F.col("conv") == source(F.col("conv"))
    own = ranked.filter(same | (F.col("rank") >= head_length(F.col("conv")))).withColumn("side", F.lit(1))
    heads = ranked.filter(same & (F.col("rank") < HEADS - 1)).withColumnRenamed("conv", "from")
    taken = convs.filter(F.col("conv") != F.col("from")).join(heads, "from").filter(F.col("rank") < F.col("head"))
    columns = ["conv", "side", "rank", "h1", "h2", "words"]
    return own.select(columns).union(taken.withColumn("side", F.lit(0)).select(columns)), convs.select("conv")


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Depth and hashes of the prefix that each turn ends, from the start of the part on:
    the sum of turn hashes times powers of the bases."""
    part, lines = _part(), 0

    def take(batch, new, held):
        nonlocal lines
        n, new = len(batch), new.copy()
        if held is not None:
            new[0] = False
        begin = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        going = begin < 0
        depth = np.where(going, np.arange(n) + 1, np.arange(n) - begin + 1)
        if going.any():
            depth[going] += held[0]
        columns = []
        for k, (name, base) in enumerate(zip(("h1", "h2"), _BASES, strict=True)):
            terms = mix(batch.column(name).to_numpy().view(_U)) * power(base, depth - 1)
            sums = np.cumsum(terms, dtype=_U)
            before = np.where(going, _U(0), (sums - terms)[np.maximum(begin, 0)])
            sums = sums - before
            if going.any():
                sums[going] += _U(held[1 + k])
            columns.append(sums)
        out = pa.RecordBatch.from_arrays(
            [
                batch.column("conv"),
                batch.column("words"),
                pa.array(depth.astype(np.int64)),
                *(pa.array(c.view(np.int64)) for c in columns),
                *(pa.array(mix(batch.column(h).to_numpy().view(_U)).view(np.int64)) for h in ("h1", "h2")),
                pa.array(np.full(n, part, np.int32)),
                pa.array(np.arange(lines, lines + n)),
            ],
            ["conv", "words", "depth", "s1", "s2", "t1", "t2", "part", "line"],
        )
        lines += n
        return out, (int(depth[-1]), int(columns[0][-1]), int(columns[1][-1]))

    yield from carried(batches, "conv", take)


def _prefixed(bases):
    """Whole depths and hashes, and those of the parent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, conv = (batch.column(c).to_numpy() for c in ("part", "conv"))
            depth = batch.column("depth").to_numpy().copy()
            own = [batch.column(c).to_numpy().view(_U).copy() for c in ("s1", "s2")]
            turn = [batch.column(c).to_numpy().view(_U) for c in ("t1", "t2")]
            for p in np.unique(part).tolist():
                if p in bases.value:
                    group, (d, *sums) = bases.value[p]
                    rows = np.flatnonzero((part == p) & (conv == group))
                    depth[rows] += d
                    for k, base in enumerate(_BASES):
                        shift = _U(pow(base, d, 1 << 64))
                        own[k][rows] = own[k][rows] * shift + _U(sums[k])
            # Without the turn itself.
            above = [own[k] - turn[k] * power(base, depth - 1) for k, base in enumerate(_BASES)]
            hashed = [np.where(depth > 0, mix(s ^ mix(depth.astype(_U) << _U(8 * k))), _U(0)) for k, s in enumerate(own)]
            over = [np.where(depth > 1, mix(s ^ mix((depth - 1).astype(_U) << _U(8 * k))), _U(0)) for k, s in enumerate(above)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv"),
                    batch.column("words"),
                    pa.array(depth),
                    *(pa.array(x.view(np.int64)) for x in (*hashed, *over)),
                ],
                ["conv", "words", "depth", "n1", "n2", "p1", "p2"],
            )

    return run


def prefixes(turns: DataFrame) -> DataFrame:
    """A row for each turn of a rebuilt conversation: ``conv``, ``words``, ``depth``, its node
    (``n1``, ``n2``) and the parent (``p1``, ``p2``; zeros for the root)."""
    order = ["conv", "side", "rank"]
    kinds = "conv long, words long, depth long, s1 long, s2 long, t1 long, t2 long, part int, line long"
    summed = stored(
        turns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_summed, kinds), "trie-sums"
    )
    ends = carry(summed.withColumnRenamed("conv", "group"), "group", "depth", "s1", "s2")
    whole = 1 << 64

    def add(base, last):
        own = (last["depth"], last["s1"] % whole, last["s2"] % whole)
        if base is None:
            return own
        shifted = ((pow(b, base[0], whole) * own[1 + k] + base[1 + k]) % whole for k, b in enumerate(_BASES))
        return (base[0] + own[0], *shifted)

    bases = summed.sparkSession.sparkContext.broadcast(_bases(ends, add))
    kinds = "conv long, words long, depth long, n1 long, n2 long, p1 long, p2 long"
    return summed.mapInArrow(_prefixed(bases), kinds)


# Totals ---------------------------------------------------------------------------------


class SpillingQueue:
    """A priority queue of tuples that keeps ``most`` in memory and the rest in sorted runs."""

    def __init__(self, most: int = IN_MEMORY):
        self.most, self.heap, self.files = most, [], []
        self.runs: list = []  # (first tuple, number of the run)

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.most:
            self.heap.sort()
            keep = self.most // 2
            file = tempfile.TemporaryFile()
            for x in self.heap[keep:]:
                pickle.dump(x, file)
            file.seek(0)
            self.files.append(file)
            self.heap = self.heap[:keep]
            self._next(len(self.files) - 1)

    def _next(self, run: int) -> None:
        try:
            heapq.heappush(self.runs, (pickle.load(self.files[run]), run))
        except EOFError:
            self.files[run].close()

    def peek(self) -> tuple | None:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            return self.runs[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            item, run = heapq.heappop(self.runs)
            self._next(run)
            return item
        return heapq.heappop(self.heap)


def time_forward(most: int = IN_MEMORY):
    """Nodes in reverse level order to their totals; messages to parents that do not come
    stay with the nodes that sent them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(most)
        for batch in batches:
            names = ("depth", "n1", "n2", "p1", "p2", "leaves", "saved")
            columns = [batch.column(c).to_pylist() for c in names]
            leaves_out, saved_out = [], []
            for depth, n1, n2, p1, p2, leaves, saved in zip(*columns, strict=True):
                here = (-depth, n1, n2)
                while (first := queue.peek()) is not None and first[:3] <= here:
                    message = queue.pop()
                    if message[:3] == here:
                        leaves, saved = leaves + message[3], saved + message[4]
                leaves_out.append(leaves)
                saved_out.append(saved)
                if depth:
                    queue.push((1 - depth, p1, p2, leaves, saved))
            yield pa.RecordBatch.from_arrays(
                [batch.column("n1"), batch.column("n2"), pa.array(leaves_out, pa.int64()), pa.array(saved_out, pa.int64())],
                ["n1", "n2", "n_leaves", "saved_tokens"],
            )

    return run


_TOTALS = "n1 long, n2 long, n_leaves long, saved_tokens long"
_NODE, _PARENT = ["n1", "n2"], ["p1", "p2"]


def _by_level(nodes: DataFrame, most: int) -> DataFrame:
    """``nodes`` of one or several shards a task, already dealt out."""
    ordered = nodes.sortWithinPartitions(F.desc("depth"), "n1", "n2")
    return ordered.select("depth", *_NODE, *_PARENT, "leaves", "saved").mapInArrow(time_forward(most), _TOTALS)


def _totals(rows: DataFrame, nodes: DataFrame, n_convs: int, most: int) -> DataFrame:
    """``n_leaves`` and ``saved_tokens`` of the nodes with several members."""
    spark = nodes.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    limit = max(LEAST_LIMIT, n_convs // (4 * tasks))
    shared = nodes.filter("n_convs > 1 OR depth = 0")
    # A node's own share, and the leaves right below it that have one member.
    base = F.when(F.col("n_children") == 0, 1).otherwise(0) + F.col("n_single")
    own = F.col("words") * (F.col("n_convs") - 1)
    shared = shared.select(
        *_NODE, *_PARENT, "depth", "conv_id", "n_convs", base.alias("leaves"), own.alias("saved")
    )
    top = stored(shared.filter((F.col("n_convs") > limit) | (F.col("depth") == 0)), "trie-top")
    light = shared.join(top.select(*_NODE), _NODE, "left_anti")
    roots = light.join(top.select(F.col("n1").alias("p1"), F.col("n2").alias("p2")), _PARENT, "left_semi")
    roots = stored(roots.select(*_NODE, *_PARENT), "trie-shard-roots")
    # The shard root on each member's path; nodes are found there by their least member.
    deepest = top.agg(F.max("depth")).first()[0] or 0
    under = rows.filter(F.col("depth") <= deepest + 1).select("conv", *_NODE)
    under = under.join(top.select(*_NODE), _NODE, "left_anti").join(roots.select(*_NODE), _NODE)
    shard = under.select(F.col("conv").alias("conv_id"), F.xxhash64("n1", "n2").alias("shard"))
    dealt = light.join(shard, "conv_id").repartition("shard")
    below = stored(_by_level(dealt, most), "trie-shards")
    sent = roots.join(below, _NODE).groupBy(*_PARENT).agg(
        F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved")
    )
    sent = sent.withColumnsRenamed({"p1": "n1", "p2": "n2"})
    none = F.lit(0)
    top = top.join(sent, _NODE, "left").withColumns(
        {
            "leaves": F.col("leaves") + F.coalesce("more_leaves", none),
            "saved": F.col("saved") + F.coalesce("more_saved", none),
        }
    )
    return below.union(_by_level(top.coalesce(1), most))


# Members that end -----------------------------------------------------------------------


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of nodes as text, in order: whole nodes hashed, the first and last of a part as chunks,
    since they may go on in others."""
    part, number, edge = _part(), 0, True
    now, held, size = None, [], 0

    def chunk(last: bool) -> pa.RecordBatch:
        nonlocal number, held, size
        text = ",".join(held)
        done = last and not edge
        number += 1
        out = pa.RecordBatch.from_arrays(
            [
                pa.array([now[0]], pa.int64()),
                pa.array([now[1]], pa.int64()),
                pa.array([part], pa.int32()),
                pa.array([number], pa.int64()),
                pa.array([None if done else text], pa.string()),
                pa.array([hashlib.sha256(text.encode()).hexdigest() if done else None], pa.string()),
            ],
            ["n1", "n2", "part", "number", "text", "sha"],
        )
        held, size = [], 0
        return out

    for batch in batches:
        for node in zip(*(batch.column(c).to_pylist() for c in ("n1", "n2", "conv")), strict=True):
            if node[:2] != now:
                if now is not None:
                    yield chunk(True)
                    edge = False
                now = node[:2]
            held.append(str(node[2]))
            size += len(held[-1]) + 1
            if size >= CHUNK:
                edge = True  # too long for one row, so that it is put together again
                yield chunk(False)
    if now is not None:
        edge = True
        yield chunk(True)


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks in order to one hash a node; no more than a chunk is held."""
    now, digest = None, None
    for batch in batches:
        out = []
        for n1, n2, text in zip(*(batch.column(c).to_pylist() for c in ("n1", "n2", "text")), strict=True):
            if (n1, n2) != now:
                if now is not None:
                    out.append((*now, digest.hexdigest()))
                now, digest = (n1, n2), hashlib.sha256(text.encode())
            else:
                digest.update(b"," + text.encode())
        if out:
            yield _hashes(out)
    if now is not None:
        yield _hashes([(*now, digest.hexdigest())])


def _hashes(rows: list[tuple]) -> pa.RecordBatch:
    n1, n2, sha = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(n1, pa.int64()), pa.array(n2, pa.int64()), pa.array(sha, pa.string())], ["n1", "n2", "sha"]
    )


def ends_hashed(ends: DataFrame) -> DataFrame:
    """``n1``, ``n2`` and the hash of the ids (``conv``) of each node."""
    order = ["n1", "n2", "conv"]
    kinds = "n1 long, n2 long, part int, number long, text string, sha string"
    parts = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_texts, kinds)
    parts = stored(parts, "trie-ends")
    several = parts.filter("sha IS NULL").repartition("n1", "n2").sortWithinPartitions("n1", "n2", "part", "number")
    joined = several.select("n1", "n2", "text").mapInArrow(_put_together, "n1 long, n2 long, sha string")
    return parts.filter("sha IS NOT NULL").select("n1", "n2", "sha").union(joined)


# The trie -------------------------------------------------------------------------------


def prefix_trie(
    conversations: DataFrame,
    id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    in_memory: int = IN_MEMORY,
) -> DataFrame:
    """One row a node: ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256``."""
    ranked = stored(_ranked(_turns(conversations, id, turn, role, text)), "trie-ranked")
    turns, convs = rebuilt(ranked)
    convs = stored(convs, "trie-conversations")
    rows = stored(prefixes(turns), "trie-rows")
    all_convs = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("least")).first()
    grouped = rows.groupBy(*_NODE).agg(
        F.count(F.lit(1)).alias("n_convs"),
        F.min("conv").alias("conv_id"),
        F.first("depth").alias("depth"),
        F.first("words").alias("words"),
        F.first("p1").alias("p1"),
        F.first("p2").alias("p2"),
    )
    grouped = stored(grouped, "trie-nodes")
    columns = ["n1", "n2", "n_convs", "conv_id", "depth", "words", "p1", "p2"]
    root = grouped.sparkSession.createDataFrame(
        [(*ROOT, all_convs.n, all_convs.least, 0, 0, None, None)] if all_convs.n else [], grouped.select(columns).schema
    )
    nodes = grouped.select(columns).union(root)
    kids = grouped.groupBy(*_PARENT).agg(
        F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("n_single")
    )
    kids = kids.withColumnsRenamed({"p1": "n1", "p2": "n2"})
    nodes = nodes.join(kids, _NODE, "left").na.fill(0, ["n_children", "n_single"])
    nodes = stored(nodes, "trie-kids")
    totals = stored(_totals(rows, nodes, all_convs.n, in_memory), "trie-totals")

    last = rows.groupBy("conv").agg(F.max_by(F.struct(*_NODE), "depth").alias("last"))
    ends = convs.join(last, "conv", "left").select(
        "conv", *(F.coalesce(f"last.{c}", F.lit(0)).alias(c) for c in _NODE)
    )
    hashes = ends_hashed(ends)
    nothing = F.lit(hashlib.sha256().hexdigest())

    # A parent with one member has its child's least member; the others are looked up.
    parents = totals.select(*_NODE).join(nodes.select(*_NODE, "conv_id"), _NODE)
    parents = parents.select(F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("above"))
    return (
        nodes.join(parents, _PARENT, "left")
        .join(totals, _NODE, "left")
        .join(hashes, _NODE, "left")
        .select(
            "conv_id",
            "depth",
            F.when(F.col("depth") > 0, F.coalesce("above", "conv_id")).alias("parent_conv_id"),
            "n_convs",
            "n_children",
            F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
            F.coalesce("saved_tokens", F.lit(0)).cast("long").alias("saved_tokens"),
            F.coalesce("sha", nothing).alias("ends_sha256"),
        )
    )
