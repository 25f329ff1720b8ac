"""Token ids in directly addressable codes.

Ids are cut into chunks of eight bits. Level 0 holds the lowest chunk of every id, level 1
the next chunk of those ids that have more, and so on; a bitmap for each level tells which
go on, and its rank directory how many do so before each run of ``RANK_BITS`` bits. The id
at any place is read with one rank a level, without decoding its neighbours.

Documents are dealt out by ranges of their ids, so that files and segments follow the order
of ids, and encoded where they are written. A segment is one row of a Parquet table: whole
documents, until it holds ``SEGMENT`` ids. Ids of a document start where those of all
documents before it end; only sums of the parts, one number a task, are added up to tell.

Texts are split at single spaces and line ends between other characters, which the
vocabulary's own splitting never crosses; each distinct piece of a few megabytes is encoded
once, and a worker keeps a bounded number. Documents with any other Unicode white space are encoded whole.

Defined results: null and empty texts hold the end id alone. Rows with equal ids stand in
the order of their texts' hash. Null ids come first.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .text import lists, pieces, span_hashes

END, SEGMENT, RANK_BITS = 2, 1 << 18, 512
#: Distinct parts whose ids a worker keeps.
KNOWN = 1_500_000
_LINE = 198  # the id of a line end in this vocabulary, checked below
_OTHER_WHITE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


# The code -------------------------------------------------------------------------------


def pack(ids: np.ndarray) -> list[tuple[bytes, bytes, bytes]]:
    """Levels of chunks, bitmaps and rank directories."""
    levels, ids = [], ids.astype(np.uint32)
    while True:
        more = ids > 0xFF
        ranks = np.add.reduceat(more, np.arange(0, len(more), RANK_BITS), dtype=np.int64) if len(more) else []
        before = np.concatenate([[0], np.cumsum(ranks)]).astype("<u4")
        levels.append(
            ((ids & 0xFF).astype(np.uint8).tobytes(), np.packbits(more).tobytes(), before.tobytes())
        )
        if not more.any():
            return levels
        ids = ids[more] >> np.uint32(8)


def unpack(levels: list[tuple[bytes, bytes, bytes]]) -> np.ndarray:
    """All ids."""
    ids = None
    for chunks, bits, _ in reversed(levels):
        low = np.frombuffer(chunks, np.uint8).astype(np.uint32)
        if ids is not None:
            more = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(low)).astype(bool)
            low[more] |= ids << np.uint32(8)
        ids = low
    return ids


def at(levels: list[tuple[bytes, bytes, bytes]], place: int) -> int:
    """The id at one place."""
    value = 0
    for level, (chunks, bits, before) in enumerate(levels):
        value |= chunks[place] << (8 * level)
        if not bits[place >> 3] >> (7 - (place & 7)) & 1:
            break
        block = place // RANK_BITS
        start = block * RANK_BITS // 8
        ahead = int.from_bytes(bits[start : (place >> 3) + 1], "big") >> (8 - (place & 7))
        place = int.from_bytes(before[4 * block : 4 * block + 4], "little") + ahead.bit_count()
    return value


# Encoding -------------------------------------------------------------------------------

_WORKER: dict[str, _Known] = {}


def _known(path: str) -> _Known:
    """Read once by each worker process; the file is installed on every machine."""
    if path not in _WORKER:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        if tokenizer.encode("\n", add_special_tokens=False).ids != [_LINE]:
            raise ValueError("unknown vocabulary")
        _WORKER[path] = _Known(tokenizer)
    return _WORKER[path]


def _encoded(tokenizer, texts: list[str]) -> list[list[int]]:
    return [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the parts that are encoded alone."""
    n = len(data)
    white = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    single = np.zeros(n + 1, bool)  # one white character between others, within a row
    single[1 : n - 1] = white[1:-1] & ~white[:-2] & ~white[2:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    single[edges] = False
    single[edges - 1] = False
    cut = np.zeros(n + 1, bool)
    line = single[:n] & (data == 0x0A)
    cut[:n] = single[:n] & (data == 0x20) | line
    cut[1:] |= line
    cut[offsets[:-1]] = True
    cut[n] = False
    starts = np.flatnonzero(cut)
    return starts, np.append(starts[1:], n)


def _plain(part: bytes) -> bool:
    """Without white space but for a leading space."""
    word = part[1:] if part[:1] == b" " else part
    return word.split() == [word]


class _Known:
    """Ids of the parts met so far by their hashes, a bounded number of them."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.clear()

    def clear(self) -> None:
        self.hashes, self.where = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.sizes, self.pool = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _encode(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all parts, and where each begins and how many it has."""
        plain, odd = [], []
        for k, part in enumerate(parts):
            (plain if _plain(part) else odd).append(k)
        where, sizes = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        flat, at = [], 0
        for k in range(0, len(plain), 4096):
            some = plain[k : k + 4096]
            text = b"\n".join([parts[j] for j in some] + [b""]).decode("utf-8", "replace")
            ids = np.array(_encoded(self.tokenizer, [text])[0], np.uint32)
            ends = np.flatnonzero(ids == _LINE)
            if len(ends) != len(some):  # they did not come apart: one by one
                odd += some
                continue
            begin = np.concatenate([[0], ends[:-1] + 1])
            where[some], sizes[some] = at + begin, ends - begin
            flat.append(ids)
            at += len(ids)
        texts = [parts[k].decode("utf-8", "replace") for k in odd]
        for k, ids in zip(odd, _encoded(self.tokenizer, texts), strict=True):
            where[k], sizes[k] = at, len(ids)
            flat.append(np.array(ids, np.uint32))
            at += len(ids)
        return np.concatenate(flat or [np.zeros(0, np.uint32)]), where, sizes

    def lookup(self, hashes: np.ndarray, part) -> tuple[np.ndarray, np.ndarray]:
        """Where in the pool the ids of sorted, distinct hashes begin, and how many they are;
        ``part(k)`` gives the bytes behind hash k."""
        if len(self.hashes) > KNOWN:
            self.clear()
        near = np.searchsorted(self.hashes, hashes)
        held = near < len(self.hashes)
        held[held] = self.hashes[near[held]] == hashes[held]
        new = np.flatnonzero(~held)
        if len(new):
            ids, where, sizes = self._encode([part(k) for k in new.tolist()])
            slots = near[new]
            self.hashes = np.insert(self.hashes, slots, hashes[new])
            self.where = np.insert(self.where, slots, where + len(self.pool))
            self.sizes = np.insert(self.sizes, slots, sizes)
            self.pool = np.concatenate([self.pool, ids])
        found = np.searchsorted(self.hashes, hashes)
        return self.where[found], self.sizes[found]


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct hashes, where each stands first, and which one every hash is; only the
    distinct ones are sorted."""
    coded = pa.array(hashes).dictionary_encode()
    codes, values = coded.indices.to_numpy(), coded.dictionary.to_numpy()
    order = np.argsort(values)
    places, place = np.empty(len(values), np.int64), np.empty(len(values), np.int64)
    places[order] = np.arange(len(values))
    place[codes[::-1]] = np.arange(len(hashes))[::-1]
    return values[order], place[order], places[codes]


def encode_texts(known: _Known, texts) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows one after another, each row with the end id, and their numbers."""
    data, offsets, n = texts.data, texts.offsets, len(texts)
    raw = data.tobytes()
    # Rows with other white space are encoded whole; their parts are not looked at.
    whole: dict[int, np.ndarray] = {}
    if _OTHER_WHITE.search(raw.decode("utf-8", "replace")):
        for r in range(n):
            text = raw[offsets[r] : offsets[r + 1]].decode("utf-8", "replace")
            if _OTHER_WHITE.search(text):
                whole[r] = np.array(_encoded(known.tokenizer, [text])[0], np.uint32)
    usual = np.ones(n, bool)
    usual[list(whole)] = False
    starts, ends = _cut(data, offsets) if len(data) else (np.zeros(0, np.int64),) * 2
    row = np.searchsorted(offsets, starts, "right") - 1
    keep = (ends > starts) & usual[row]
    starts, ends, row = starts[keep], ends[keep], row[keep]
    hashes, first, which = distinct(span_hashes(data, starts, ends))
    where, sizes = known.lookup(hashes, lambda k: raw[starts[first[k]] : ends[first[k]]])
    counts = np.bincount(row, sizes[which], n).astype(np.int64)
    for r, ids in whole.items():
        counts[r] = len(ids)
    counts += 1
    bounds = np.concatenate([[0], np.cumsum(counts)])
    out = np.full(bounds[-1], END, np.uint32)
    sizes_of = sizes[which]
    total = np.cumsum(sizes_of)
    own = np.arange(total[-1] if len(total) else 0)
    ids = known.pool[own + np.repeat(where[which] - total + sizes_of, sizes_of)]
    slots = np.ones(len(out), bool)
    slots[bounds[1:] - 1] = False
    for r, x in whole.items():
        out[bounds[r] : bounds[r + 1] - 1] = x
        slots[bounds[r] : bounds[r + 1]] = False
    out[slots] = ids
    return out, counts


# Files ----------------------------------------------------------------------------------

_LEVELS = "array<struct<chunks:binary,bits:binary,ranks:binary>>"


def _segments(path: str, kind: pa.DataType):
    level = pa.struct([("chunks", pa.binary()), ("bits", pa.binary()), ("ranks", pa.binary())])

    def row(part, segment, start, doc_ids, counts, ids) -> pa.RecordBatch:
        levels = [dict(zip(("chunks", "bits", "ranks"), x, strict=True)) for x in pack(np.concatenate(ids))]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()),
                pa.array([segment], pa.int32()),
                pa.array([start], pa.int64()),
                pa.array([int(sum(counts))], pa.int64()),
                pa.array([doc_ids], pa.list_(kind)),
                pa.array([counts], pa.list_(pa.int64())),
                pa.array([levels], pa.list_(level)),
            ],
            ["part", "segment", "start", "n_tokens", "ids", "counts", "levels"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part = _known(path), TaskContext.get().partitionId()
        segment, start = 0, 0
        doc_ids, counts, ids, held = [], [], [], 0
        for batch in batches:
            names = batch.column("id").to_pylist()
            for texts in pieces(batch.column("text")):
                found, sizes = encode_texts(known, texts)
                ends = np.cumsum(sizes)
                for k, (end, size) in enumerate(zip(ends.tolist(), sizes.tolist(), strict=True)):
                    doc_ids.append(names[texts.rows.start + k])
                    counts.append(size)
                    ids.append(found[end - size : end])
                    held += size
                    if held >= SEGMENT:
                        yield row(part, segment, start, doc_ids, counts, ids)
                        segment, start = segment + 1, start + held
                        doc_ids, counts, ids, held = [], [], [], 0
        if held:
            yield row(part, segment, start, doc_ids, counts, ids)

    return run


def write_tokens(
    docs: DataFrame, path: str, tokenizer_file: str, id: str = "doc_id", text: str = "text"
) -> None:
    """Encode and write all documents in ascending order of their ids."""
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    kind = rows.schema["id"].dataType.simpleString()
    empty = docs.sparkSession.createDataFrame([], rows.select("id").schema).toArrow()
    ordered = rows.repartitionByRange("id", "hash").sortWithinPartitions("id", "hash")
    ordered.select("id", "text").mapInArrow(
        _segments(tokenizer_file, empty.schema.field("id").type),
        f"part int, segment int, start long, n_tokens long, ids array<{kind}>, "
        f"counts array<long>, levels {_LEVELS}",
    ).write.option("compression", "zstd").parquet(path)


def _levels(scalar) -> list[tuple[bytes, bytes, bytes]]:
    return [(x["chunks"], x["bits"], x["ranks"]) for x in scalar.as_py()]


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments, and ``base``: how many ids all parts before have."""
    table = spark.read.parquet(path)
    parts = table.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # One row for each writing task.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return table.join(parts, "part")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row a document: ``id``, ``start``, ``n_tokens``, ``tokens`` and ``ids_crc32``."""
    table = segments(spark, path)
    kind = table.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                tokens = unpack(_levels(batch.column("levels")[k])).astype("<u4")
                counts = batch.column("counts")[k].values.to_numpy()
                ends = np.cumsum(counts)
                raw = memoryview(tokens).cast("B")
                sums = [zlib.crc32(raw[4 * (e - c) : 4 * e]) for c, e in zip(counts.tolist(), ends.tolist(), strict=True)]
                first = batch.column("base")[k].as_py() + batch.column("start")[k].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids")[k].values,
                        pa.array(first + ends - counts),
                        pa.array(counts),
                        lists(tokens.view(np.int32), counts, pa.int32()),
                        pa.array(sums, pa.int64()),
                    ],
                    ["id", "start", "n_tokens", "tokens", "ids_crc32"],
                )

    return table.select("ids", "counts", "levels", "base", "start").mapInArrow(
        run, f"id {kind}, start long, n_tokens long, tokens array<int>, ids_crc32 long"
    )


def tokens_at(spark: SparkSession, path: str, places: DataFrame) -> DataFrame:
    """``id``, ``offset`` and ``token`` for the rows of ``places`` (``id``, ``offset`` within
    the document); null where the document is not that long or not there."""
    table = spark.read.parquet(path)
    index = table.select("part", "segment", F.posexplode(F.arrays_zip("ids", "counts")).alias("k", "doc"), "counts")
    begin = F.aggregate(F.slice("counts", F.lit(1), F.col("k")), F.lit(0).cast("long"), lambda a, b: a + b)
    index = index.select("part", "segment", F.col("doc.ids").alias("id"), F.col("doc.counts").alias("n"), begin.alias("begin"))
    asked = places.select("id", F.col("offset").cast("long").alias("offset")).distinct()
    near = asked.join(index, "id").filter("offset >= 0 AND offset < n")
    near = near.groupBy("part", "segment").agg(F.collect_list(F.struct("id", "offset", (F.col("begin") + F.col("offset")).alias("place"))).alias("asked"))
    kind = places.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                levels, rows = _levels(batch.column("levels")[k]), batch.column("asked")[k].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r["id"] for r in rows], batch.column("asked").type.value_type.field("id").type),
                        pa.array([r["offset"] for r in rows], pa.int64()),
                        pa.array([at(levels, r["place"]) for r in rows], pa.int32()),
                    ],
                    ["id", "offset", "token"],
                )

    found = near.join(table.select("part", "segment", "levels"), ["part", "segment"])
    found = found.select("levels", "asked").mapInArrow(run, f"id {kind}, offset long, token int")
    return asked.join(found, ["id", "offset"], "left")
