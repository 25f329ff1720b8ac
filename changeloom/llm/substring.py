"""Substring dedup by relative Lempel-Ziv parsing.

Every document is factored against all documents. The reference index is a table of
anchors, hash-partitioned into blocks: an anchor is a run of words whose hash is the least
among its neighbours, so that every window of ``width`` words holds at least one, chosen by
the window's own words alone. Where the anchor that a window chooses occurs again in some
block, a factor may begin; the windows of such stretches are checked one by one, which
settles where each factor starts and ends. Greedy factors of ``width`` words or more are the
duplicate spans.

No group is ever gathered. A run that occurs once is found as a group with a count of one,
and its single member is the minimum of the group; only these go back to their document,
so that a passage shared by a third of all documents costs one pre-aggregated row a task.

Runs are compared by 64-bit hashes, and documents are told apart by a 64-bit hash of id and
text.

Defined results: a null or empty text has no words, spans or kept text (``""``). Rows
repeated in full count as documents of their own, so all their windows are duplicates.
Columns of the input come back inside ``row`` and can have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import stored
from .text import Texts, lists, pieces, window_hashes

WIDTH = 35


def _least(values: np.ndarray, width: int, best=np.minimum) -> np.ndarray:
    """The least (or by ``best``) of each ``width`` neighbouring values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = best(out[:-step], out[step:])
        have += step
    return out


class _Windows:
    """Windows and anchors of the rows that have at least one window."""

    def __init__(self, texts: Texts, width: int):
        self.gram = (width + 1) // 2
        self.span = width - self.gram + 1
        self.starts, self.ends, self.row = texts.windows(width)
        self.words = texts.words
        grams = np.arange(max(0, len(texts.words) - self.gram + 1))
        self.grams = window_hashes(texts.words, grams, grams + self.gram)

    def hashes(self, at: np.ndarray) -> np.ndarray:
        return window_hashes(self.words, self.starts[at], self.ends[at])

    def anchors(self) -> np.ndarray:
        """Words at which an anchor starts."""
        if not len(self.starts):
            return self.starts
        least = np.zeros(len(self.grams), np.uint64)
        least[self.starts] = _least(self.grams, self.span)[self.starts]
        padded = np.concatenate([np.zeros(self.span - 1, np.uint64), least])
        most = _least(padded, self.span, np.maximum)
        inside = np.zeros(len(self.grams) + 1, np.int32)
        np.add.at(inside, self.starts, 1)
        np.add.at(inside, np.minimum(self.starts + self.span, len(self.grams)), -1)
        return np.flatnonzero((most == self.grams) & (np.cumsum(inside)[:-1] > 0))

    def without(self, words: np.ndarray) -> np.ndarray:
        """Windows whose least run, the anchor they choose, starts at none of these words."""
        if not len(self.starts):
            return self.starts
        others = self.grams.copy()
        others[words] = np.uint64(2**64 - 1)
        least, other = _least(self.grams, self.span), _least(others, self.span)
        return np.flatnonzero((least == other)[self.starts])


def _once(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct hash first stands, and how often it occurs."""
    _, first, counts = np.unique(hashes, return_index=True, return_counts=True)
    return first, counts


def _table(hashes, counts, keys, at) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(hashes.view(np.int64)),
            pa.array(counts.astype(np.int32)),
            pa.array(keys),
            pa.array(at.astype(np.int32)),
        ],
        ["hash", "n", "key", "at"],
    )


_RUN = "hash long, n int, key long, at int"


def _flat(column: pa.Array, texts: Texts) -> np.ndarray:
    """Words of the piece for lists of word numbers within rows."""
    column = column.slice(texts.rows.start, len(texts))
    counts = np.asarray(column.value_lengths().fill_null(0))
    return np.asarray(column.flatten()).astype(np.int64) + np.repeat(texts.bounds[:-1], counts)


def _anchors(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.asarray(batch.column("key"))
            for texts in pieces(batch.column("text")):
                windows = _Windows(texts, width)
                at = windows.anchors()
                row = texts.row[at]
                first, counts = _once(windows.grams[at])
                yield _table(
                    windows.grams[at[first]],
                    counts,
                    keys[texts.rows][row[first]],
                    at[first] - texts.bounds[row[first]],
                )

    return run


def _candidates(width: int, text: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.asarray(batch.column("key"))
            for texts in pieces(batch.column("row").field(text)):
                windows = _Windows(texts, width)
                at = windows.without(_flat(batch.column("lone_anchors"), texts))
                hashes, row = windows.hashes(at), windows.row[at]
                first, counts = _once(hashes)
                yield _table(
                    hashes[first],
                    counts,
                    keys[texts.rows][row[first]],
                    (windows.starts[at] - texts.bounds[row])[first],
                )

    return run


def factors(starts: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end and row of the greedy factors, given the windows found elsewhere.

    Windows that follow on each other word by word are one factor; a factor that begins
    before the last one ends belongs to the same span.
    """
    if not len(starts):
        return starts, starts, row
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] > starts[:-1] + width) | (row[1:] != row[:-1])
    last = np.flatnonzero(np.append(new[1:], True))
    return starts[new], starts[last] + width, row[new]


def kept_texts(texts: Texts, keep: np.ndarray) -> pa.Array:
    """Each row's kept words, joined by one space."""
    starts, ends, row = texts.starts[keep], texts.ends[keep], texts.row[keep]
    data = np.append(texts.data, np.uint8(0))
    tail = np.ones(len(starts), bool)  # a space follows, unless it is the row's last kept word
    tail[:-1] = row[1:] == row[:-1]
    tail[-1:] = False
    data[ends[tail]] = 0x20
    edge = np.zeros(len(data) + 1, np.int8)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends + tail, -1)
    inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
    lengths = np.bincount(row, ends - starts + tail, len(texts)).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    return pa.LargeStringArray.from_buffers(
        len(texts), pa.py_buffer(offsets), pa.py_buffer(data[inside])
    ).cast(pa.string())


def _remove(width: int, text: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in pieces(batch.column("row").field(text)):
                windows = _Windows(texts, width)
                found = np.zeros(len(texts.words), bool)
                found[windows.starts[windows.without(_flat(batch.column("lone_anchors"), texts))]] = True
                found[_flat(batch.column("lone_windows"), texts)] = False
                at = np.flatnonzero(found)
                first, end, row = factors(at, texts.row[at], width)
                edge = np.zeros(len(texts.words) + 1, np.int32)
                edge[first] += 1
                edge[end] -= 1
                covered = np.cumsum(edge[:-1]) > 0
                removed = np.bincount(texts.row[covered], minlength=len(texts))
                base = texts.bounds[row]
                spans = pa.StructArray.from_arrays(
                    [pa.array((first - base).astype(np.int32)), pa.array((end - first).astype(np.int32))],
                    ["start", "length"],
                )
                offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(texts)))])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(texts.rows.start, len(texts)),
                        pa.array(texts.counts.astype(np.int64)),
                        pa.array(removed.astype(np.int64)),
                        pa.ListArray.from_arrays(offsets.astype(np.int32), spans),
                        kept_texts(texts, ~covered),
                    ],
                    ["row", "n_words", "n_removed", "spans", "kept"],
                )

    return run


def _lone(runs: DataFrame, name: str) -> DataFrame:
    """For each document the words at which a run starts that occurs nowhere else."""
    return (
        runs.groupBy("hash")
        .agg(F.sum("n").alias("n"), F.min("key").alias("key"), F.min("at").alias("at"))
        .filter("n = 1")
        .groupBy("key")
        .agg(F.collect_list("at").alias(name))
    )


def dedup_substrings(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH
) -> DataFrame:
    """``row`` (all input columns), ``n_words``, ``n_removed``, ``spans`` (first word and
    length of each duplicate span) and ``kept`` (the other words, joined by one space).
    """
    base = docs.select(
        F.struct("*").alias("row"), F.xxhash64(id, text).alias("key"), F.col(text).alias("text")
    )
    anchors = base.select("key", "text").mapInArrow(_anchors(width), _RUN)
    lone = stored(_lone(anchors, "lone_anchors"), "substring-anchors")
    # Both passes below read whole rows, so that their exchange is one and the same.
    marked = base.select("row", "key").join(lone, "key", "left")
    at = docs.columns.index(text)
    windows = marked.mapInArrow(_candidates(width, at), _RUN)
    kind = f"row {base.schema['row'].dataType.simpleString()}"
    return marked.join(_lone(windows, "lone_windows"), "key", "left").mapInArrow(
        _remove(width, at),
        f"{kind}, n_words long, n_removed long, spans array<struct<start:int,length:int>>, kept string",
    )
