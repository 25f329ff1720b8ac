"""Sampled SentencePiece segmentations, and decoding.

The lattice of a text has a node at every byte and an edge for every vocabulary piece that
fits; a character outside the vocabulary is spelled in byte pieces. Forward filtering sums
the weight of all paths to each node; backward sampling then draws a segmentation from its
end, each edge with its exact conditional probability. The draws are a function of seed,
row key, position and step alone, so that a row gets the same pieces in any task, batch or
run. Decoding joins the pieces' bytes and gives back the text.

White space is a piece's first character or a run of its own, so no edge crosses the start
of a white-space run or a line end, and the lattice falls into independent chunks; this is
checked against the vocabulary. Forward filtering runs once for each distinct chunk of a few
megabytes of text, and backward sampling for all its chunks at once. A chunk of many bytes (a
word without white space) is filtered and sampled by itself, a stretch of bytes at a time: only
the sums at its nodes are kept, and its edges are looked up again on the way back.

Weights: with log probabilities in the model, these, times ``alpha``; a merge-order model
has ranks for scores, and its piece of rank r weighs ``(r + 2) ** -alpha``.

Defined results: null and empty texts have no pieces, and decode to ``""``. Every other text
is encoded with a leading white space, which decoding takes off again.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import lists, mix, pieces, span_hashes

ALPHA, SEED = 1.0, 0
#: Text whose lattices are held at once; each byte takes some hundred bytes.
LATTICE_BYTES = 1 << 19
#: Chunks above this are taken by themselves, this many bytes at a time.
LONG_CHUNK, STRETCH = 1 << 12, 1 << 16
_STEP, _PLACE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Vocabulary:
    """Pieces as byte strings (white space as a space), their ids and weights."""

    def __init__(self, model_file: str, alpha: float = ALPHA):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_file)
        n = model.get_piece_size()
        scores = np.array([model.get_score(i) for i in range(n)])
        self.bytes = [b""] * n
        self.spelled = np.full(256, -1, np.int64)
        normal = []
        for i in range(n):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[3:5], 16)
                self.bytes[i], self.spelled[value] = bytes([value]), i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.bytes[i] = model.id_to_piece(i).replace("▁", " ").encode()
                normal.append(i)
        if (self.spelled < 0).any():
            raise ValueError("the model must have a piece for every byte")
        normal = np.array(normal)
        if (scores[normal] == np.round(scores[normal])).all():
            weights = -alpha * np.log(2 + scores[normal].max() - np.minimum(scores, scores[normal].max()))
        else:
            weights = alpha * scores
        self.pieces = {self.bytes[i]: (int(i), float(weights[i])) for i in normal}
        for piece in self.pieces:
            if b" " in piece.lstrip(b" ") or (b"\n" in piece and len(piece) > 1):
                raise ValueError(f"a piece crosses a chunk's edge: {piece!r}")
        self.longest = max(len(piece) for piece in self.pieces)
        lengths = np.array([len(x) for x in self.bytes])
        self.lengths, self.at = lengths, np.concatenate([[0], np.cumsum(lengths)[:-1]])
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self._grow_trie()

    def _grow_trie(self) -> None:
        """``next[node, byte]`` is a node or -1; node 0 is the root. ``piece`` is an id or -1."""
        child: dict[int, int] = {}  # by node * 256 + byte
        piece, weight = {}, {}
        for name, (i, w) in self.pieces.items():
            node = 0
            for byte in name:
                node = child.setdefault(node << 8 | byte, len(child) + 1)
            piece[node], weight[node] = i, w
        n = len(child) + 1
        self.piece, self.weight = np.full(n, -1, np.int32), np.zeros(n, np.float32)
        self.piece[list(piece)] = list(piece.values())
        self.weight[list(weight)] = list(weight.values())
        keys = np.fromiter(child, np.int64, len(child))
        inner, line = np.unique(keys >> 8, return_inverse=True)
        self.line = np.full(n, len(inner), np.int32)  # the last line has no child
        self.line[inner] = np.arange(len(inner))
        self.next = np.full((len(inner) + 1, 256), -1, np.int32)
        self.next[line, keys & 0xFF] = np.fromiter(child.values(), np.int32, len(child))


@dataclass
class _Lattice:
    """Forward-filtered edges of some chunks. Node k + c is the end of byte k of chunk c, and
    each chunk has a node before its first byte. The edges into node v have keys from v up to
    v + 1, spaced by their conditional chances."""

    keys: np.ndarray
    names: np.ndarray
    sizes: np.ndarray


def _edges(vocabulary: Vocabulary, data: np.ndarray, limit: np.ndarray):
    """All edges: start byte, length, id and weight. ``limit``: end of each byte's chunk."""
    starts, sizes, names, weights = [], [], [], []
    at = np.flatnonzero((data & 0xC0) != 0x80)
    wide = np.select([data < 0x80, data < 0xE0, data < 0xF0], [1, 2, 3], 4)
    unknown = np.zeros(len(data), bool)
    unknown[at] = True
    node, size = np.zeros(len(at), np.int32), 0
    while len(at):
        node = vocabulary.next[vocabulary.line[node], data[at + size]]
        size += 1
        going = node >= 0
        at, node = at[going], node[going]
        full = vocabulary.piece[node] >= 0
        starts.append(at[full])
        names.append(vocabulary.piece[node[full]])
        weights.append(vocabulary.weight[node[full]])
        sizes.append(np.full(full.sum(), size))
        unknown[at[full][wide[at[full]] == size]] = False
        going = at + size < limit[at]
        at, node = at[going], node[going]
    # Bytes of unknown characters stand for themselves.
    lead = np.flatnonzero(unknown)
    spelled = np.zeros(len(data) + 1, np.int32)
    np.add.at(spelled, lead, 1)
    np.add.at(spelled, np.minimum(lead + wide[lead], limit[lead]), -1)
    loose = np.flatnonzero(np.cumsum(spelled[:-1]) > 0)
    starts.append(loose)
    sizes.append(np.ones(len(loose), np.int64))
    names.append(vocabulary.spelled[data[loose]].astype(np.int32))
    weights.append(np.zeros(len(loose)))
    return tuple(np.concatenate(x) for x in (starts, sizes, names, weights))


def forward(vocabulary: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> _Lattice:
    """Filter the lattices of the chunks of ``data`` between ``offsets``."""
    lengths = np.diff(offsets)
    chunk = np.repeat(np.arange(len(lengths)), lengths)
    at, sizes, names, weights = _edges(vocabulary, data, offsets[1:][chunk])
    start = at + chunk[at]
    end, depth = start + sizes, at + sizes - offsets[chunk[at]]
    by_end = np.argsort(end, kind="stable")
    at, start, end, depth, sizes, names, weights = (
        x[by_end] for x in (at, start, end, depth, sizes, names, weights)
    )
    # Sums are kept as logarithms: the weight of a path leaves the range of floats within
    # some hundred bytes.
    logs = np.full(len(data) + len(lengths) + 1, -np.inf)
    logs[offsets[:-1] + np.arange(len(lengths))] = 0
    chances = np.zeros(len(end))
    order = np.argsort(depth, kind="stable")
    levels = np.append(np.flatnonzero(np.diff(depth[order], prepend=0)), len(order))
    for first, last in zip(levels[:-1], levels[1:], strict=True):
        part = order[first:last]
        ends = end[part]
        cuts = np.flatnonzero(np.append(True, ends[1:] != ends[:-1]))
        sizes_in = np.diff(np.append(cuts, len(part)))
        arrived = logs[start[part]] + weights[part]
        top = np.maximum.reduceat(arrived, cuts)
        top[top == -np.inf] = 0
        shares = np.exp(arrived - np.repeat(top, sizes_in))
        sums = np.add.reduceat(shares, cuts)
        reached = sums > 0
        logs[ends[cuts[reached]]] = top[reached] + np.log(sums[reached])
        sums[~reached] = 1
        chances[part] = shares / np.repeat(sums, sizes_in)
    return _keyed(end, sizes, names, chances)


def _keyed(end: np.ndarray, sizes: np.ndarray, names: np.ndarray, chances: np.ndarray) -> _Lattice:
    """Edges in the order of their ends, with their keys."""
    live = chances > 0
    end, sizes, names, chances = end[live], sizes[live], names[live], chances[live]
    first = np.append(True, end[1:] != end[:-1])
    summed = np.cumsum(chances)
    base = (summed - chances)[first][np.cumsum(first) - 1]
    keys = end + np.minimum(summed - base, 1)
    last = np.append(first[1:], True)
    keys[last] = end[last] + 1.0
    return _Lattice(keys, names, sizes)


def _edges_into(vocabulary: Vocabulary, data: np.ndarray, first: int, last: int):
    """Of one chunk: starts, ends, ids and weights of the edges that end after ``first`` and not
    after ``last``, by end. Both bounds are where characters begin."""
    low = max(0, first - vocabulary.longest)
    while low and data[low] & 0xC0 == 0x80:
        low -= 1
    at, sizes, names, weights = _edges(vocabulary, data[low:last], np.full(last - low, last - low))
    end = at + sizes + low
    into = np.flatnonzero(end > first)
    into = into[np.argsort(end[into], kind="stable")]
    return at[into] + low, end[into], names[into], weights[into]


def _forward_long(vocabulary: Vocabulary, data: np.ndarray, cuts: Sequence[int]) -> np.ndarray:
    """The logarithm of the weight of all paths to each node of one chunk."""
    logs = np.full(len(data) + 1, -np.inf)
    logs[0] = 0
    for first, last in zip(cuts[:-1], cuts[1:], strict=True):
        start, end, _, weights = _edges_into(vocabulary, data, first, last)
        low = int(start.min())
        near = logs[low : last + 1].tolist()
        starts, ends, weights = (start - low).tolist(), (end - low).tolist(), weights.tolist()
        k, n = 0, len(ends)
        while k < n:
            node, arrived = ends[k], []
            while k < n and ends[k] == node:
                arrived.append(near[starts[k]] + weights[k])
                k += 1
            top = max(arrived)
            if top > -math.inf:
                near[node] = top + math.log(sum([math.exp(x - top) for x in arrived]))
        logs[first + 1 : last + 1] = near[first + 1 - low :]
    return logs


def _sampled_long(vocabulary: Vocabulary, data: np.ndarray, state: np.ndarray) -> np.ndarray:
    """The pieces of one long chunk: drawn as ``_sampled`` does, with the bounded memory of a
    stretch and eight bytes a node."""
    cuts = [0]
    while cuts[-1] < len(data):
        cut = min(len(data), cuts[-1] + STRETCH)
        while cut < len(data) and data[cut] & 0xC0 == 0x80:
            cut += 1
        cuts.append(cut)
    logs = _forward_long(vocabulary, data, cuts)
    drawn, node, steps = [], len(data), 0
    for first, last in zip(cuts[-2::-1], cuts[:0:-1], strict=True):
        if node <= first:
            continue
        start, end, names, weights = _edges_into(vocabulary, data, first, last)
        known = np.flatnonzero((logs[start] > -np.inf) & (logs[end] > -np.inf))
        start, end, names, weights = start[known], end[known], names[known], weights[known]
        lattice = _keyed(end - first, end - start, names, np.exp(logs[start] + weights - logs[end]))
        with np.errstate(over="ignore"):
            bits = mix(state + np.arange(steps + 1, steps + 1 + last - first, dtype=np.uint64) * _STEP)
        chances = ((bits >> np.uint64(12)) * 2.0**-52).tolist()
        keys, sizes, edges, begin = lattice.keys.tolist(), lattice.sizes.tolist(), [], steps
        while node > first:
            here = node - first
            edge = bisect_right(keys, min(here + chances[steps - begin], math.nextafter(here + 1.0, 0)))
            edges.append(edge)
            node -= sizes[edge]
            steps += 1
        drawn.append(lattice.names[edges])
    return np.concatenate(drawn)[::-1].astype(np.int32)


def _chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the chunks: rows, white-space runs, and what stands before and after a line end."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    space, line = data == 0x20, data == 0x0A
    cut[1:n] = (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
    cut[offsets[:-1]] = True
    cut[n] = False
    starts = np.flatnonzero(cut)
    return starts, np.append(starts[1:], n)


def _prefixed(texts) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets with a space before every row that has text."""
    lengths = np.diff(texts.offsets)
    data = np.insert(texts.data, texts.offsets[:-1][lengths > 0], np.uint8(0x20))
    return data, np.concatenate([[0], np.cumsum(lengths + (lengths > 0))])


def encode_texts(
    vocabulary: Vocabulary, texts, keys: np.ndarray, seed: int = SEED
) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of all rows one after another, and each row's number of pieces."""
    data, offsets = _prefixed(texts)
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    starts, ends = _chunks(data, offsets)
    row = np.searchsorted(offsets, starts, "right") - 1
    place = np.arange(len(starts)) - np.searchsorted(starts, offsets[:-1])[row]
    with np.errstate(over="ignore"):
        states = mix(keys.view(np.uint64)[row] ^ mix(np.array([seed], np.int64).view(np.uint64)))
        states = mix(states + place.astype(np.uint64) * _PLACE)
    # A long text is taken a stretch of chunks at a time; what is drawn for a chunk depends on
    # its place and its bytes alone.
    found, taken, begin = [], np.zeros(len(starts), np.int64), 0
    long = np.append(np.flatnonzero(ends - starts > LONG_CHUNK), len(starts))
    while begin < len(starts):
        next_long = int(long[np.searchsorted(long, begin)])
        if begin == next_long:
            found.append(_sampled_long(vocabulary, data[starts[begin] : ends[begin]], states[begin : begin + 1]))
            taken[begin] = len(found[-1])
            begin += 1
            continue
        end = max(begin + 1, int(np.searchsorted(ends, starts[begin] + LATTICE_BYTES, "right")))
        end = min(end, next_long)
        part = slice(begin, end)
        ids, taken[part] = _sampled(
            vocabulary, data[starts[begin] : ends[end - 1]], starts[part] - starts[begin], states[part]
        )
        found.append(ids)
        begin = end
    return np.concatenate(found), np.bincount(row, taken, len(texts)).astype(np.int64)


def _sampled(
    vocabulary: Vocabulary, data: np.ndarray, starts: np.ndarray, states: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of the chunks that begin at ``starts``, and each chunk's number of pieces."""
    ends = np.append(starts[1:], len(data))
    _, first, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    sizes = (ends - starts)[first]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    own = np.arange(bounds[-1]) + np.repeat(starts[first] - bounds[:-1], sizes)
    lattice = forward(vocabulary, data[own], bounds)
    stop = (bounds[:-1] + np.arange(len(sizes)))[which]
    node = stop + sizes[which]
    taken = np.zeros(len(starts), np.int64)
    # In the order of the lattice, where neighbours are found fastest.
    active, drawn, step = np.argsort(node, kind="stable"), [], np.uint64(0)
    while len(active):
        with np.errstate(over="ignore"):
            step += np.uint64(1)
            bits = mix(states[active] + step * _STEP)
        chance = (bits >> np.uint64(12)) * 2.0**-52
        # A chance near 1 must not be rounded up to the next node.
        drawn_at = np.minimum(node[active] + chance, np.nextafter(node[active] + 1.0, 0))
        edge = np.searchsorted(lattice.keys, drawn_at, "right")
        taken[active] += 1
        drawn.append((active, lattice.names[edge]))
        node[active] -= lattice.sizes[edge]
        active = active[node[active] > stop[active]]
    last = np.cumsum(taken)
    ids = np.empty(last[-1], np.int32)
    for k, (which, names) in enumerate(drawn):
        ids[last[which] - 1 - k] = names
    return ids, taken


def decoded(
    vocabulary: Vocabulary, ids: np.ndarray, counts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts of rows of pieces, and where each row starts."""
    ends = np.cumsum(vocabulary.lengths[ids])
    data = np.empty(ends[-1] if len(ends) else 0, np.uint8)
    for first in range(0, len(ids), LATTICE_BYTES):
        part = ids[first : first + LATTICE_BYTES]
        sizes = vocabulary.lengths[part]
        upto = ends[first : first + LATTICE_BYTES]
        begin = upto[0] - sizes[0]
        from_ = np.repeat(vocabulary.at[part] - upto + sizes, sizes)
        data[begin : upto[-1]] = vocabulary.flat[np.arange(begin, upto[-1]) + from_]
    bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
    keep = np.ones(len(data), bool)
    keep[bounds[:-1][counts > 0]] = False
    return data[keep], (bounds - np.concatenate([[0], np.cumsum(counts > 0)])).astype(np.int64)


def joined(vocabulary: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The texts of rows of pieces."""
    data, offsets = decoded(vocabulary, ids, counts)
    texts = pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(offsets), pa.py_buffer(data))
    return texts.cast(pa.string())


def same_texts(vocabulary: Vocabulary, texts, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether each row's pieces decode to its bytes."""
    data, offsets = decoded(vocabulary, ids, counts)
    same = np.diff(offsets) == np.diff(texts.offsets)
    if len(data) == len(texts.data) and same.all():
        wrong = np.flatnonzero(data != texts.data)
        same[np.searchsorted(texts.offsets, wrong, "right") - 1] = False
        return same
    return np.array([data[a:b].tobytes() == texts.data[c:d].tobytes() for a, b, c, d in zip(
        offsets[:-1], offsets[1:], texts.offsets[:-1], texts.offsets[1:], strict=True)])


_MODELS: dict[tuple[str, float], Vocabulary] = {}


def _vocabulary(model_file: str, alpha: float) -> Vocabulary:
    """Read once by each worker process; the file is installed on every machine."""
    if (model_file, alpha) not in _MODELS:
        _MODELS[model_file, alpha] = Vocabulary(model_file, alpha)
    return _MODELS[model_file, alpha]


def encode(
    docs: DataFrame,
    model_file: str,
    id: str = "doc_id",
    text: str = "text",
    alpha: float = ALPHA,
    seed: int = SEED,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``row`` (all input columns, or those to ``keep``), ``pieces``, ``ids_crc32`` (of
    little-endian 32-bit ids) and ``lossless``: whether the pieces decode to the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(model_file, alpha)
        for batch in batches:
            keys = np.asarray(batch.column("key_"))
            for texts in pieces(batch.column("text_"), LATTICE_BYTES):
                ids, counts = encode_texts(vocabulary, texts, keys[texts.rows], seed)
                ends = np.cumsum(counts)
                raw = memoryview(ids.astype("<u4")).cast("B")
                sums = [zlib.crc32(raw[4 * (e - c) : 4 * e]) for c, e in zip(counts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(texts.rows.start, len(texts)),
                        lists(ids, counts, pa.int32()),
                        pa.array(sums, pa.int64()),
                        pa.array(same_texts(vocabulary, texts, ids, counts)),
                    ],
                    ["row", "pieces", "ids_crc32", "lossless"],
                )

    rows = docs.select(
        F.struct(*(keep or ["*"])).alias("row"), F.xxhash64(id).alias("key_"), F.col(text).alias("text_")
    )
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, pieces array<int>, ids_crc32 long, lossless boolean")


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """The same columns and ``decoded``, the text of ``pieces``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(model_file, ALPHA)
        for batch in batches:
            column = batch.column("pieces")
            counts = column.value_lengths().fill_null(0).to_numpy()
            ends = np.cumsum(counts)
            flat = np.asarray(column.flatten())
            first = 0
            while first < len(counts):
                start = int(ends[first] - counts[first])
                last = max(first + 1, int(np.searchsorted(ends, start + 250_000, "right")))
                part = joined(vocabulary, flat[start : ends[last - 1]], counts[first:last])
                arrays = [batch.column(c).slice(first, last - first) for c in range(batch.num_columns)]
                yield pa.RecordBatch.from_arrays([*arrays, part], [*batch.schema.names, "decoded"])
                first = last

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{kinds}, decoded string")
