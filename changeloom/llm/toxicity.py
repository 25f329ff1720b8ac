"""Toxicity scores by noisy-channel deobfuscation.

A written form may hide the word that is meant: letters are replaced by marks and digits,
repeated, or set apart. Every suspicious span of a text becomes a lattice of what may have
been meant: each cell, a run of one character, offers some readings (letters that it looks
like, one or two copies of a repeated letter, nothing or the end of a word for a mark or a
space between single letters) at a fixed cost. The path with the greatest chance under a
character language model is found exactly, by Viterbi's algorithm, and stands in for the span.
The restored text is scored.

* The language model is of four characters over ``SYMBOLS`` symbols, with counts from the words
  of all documents: a table of fixed size, however large the corpus.
* Words and word beginnings of restored texts that mark toxic documents form a lexicon, learned
  from at most ``SAMPLE`` labelled documents a class. A feature must be more common in toxic
  documents, and among their words, than chance allows for as many features as there are. It counts in
  as many documents as it has different neighbours there, so that words which merely stand in copies
  of one toxic document are left out. The lexicon has at most ``LEXICON`` features; the weight of
  one is the logarithm of how much more common it is in toxic documents.
* A document's score is a logistic regression on the weights of its words, each with its most telling
  feature: their sum, that sum against the length of the text, the greatest one, and the number of
  words that tell. ``predicted`` is 1 where the score reaches a half.

A span is suspicious if it holds a mark or digit among letters, three equal letters in a row, or
three single characters set apart. All other words have one reading and stay as they are.

Defined results: null and empty texts restore to ``""`` and get the score of a document without
words. Without labels of both classes the score is the share of toxic labels, 0 without
any. A document with several labels is toxic if one of them says so; labels with nulls
count for nothing. Of documents with equal ids the sample holds one text, chosen by hash. Ids can
be null (never held out) or repeated. Spans of more than ``MOST_CELLS`` cells are decoded in
stretches, each from the best end of the one before.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import stored
from .text import Texts, lists, mix, pieces, span_hashes

#: Characters of the language model: the end of a word, a-z, a digit, and classes of all others.
SYMBOLS, ORDER = 40, 4
_END, _DIGIT, _OTHER = 0, 27, 28
_STATES = SYMBOLS ** (ORDER - 1)
#: Weight of the shorter context, and the costs of readings, as natural logarithms.
BACKOFF, READ_AS, LEFT_OUT, KEPT_APART = 4.0, -0.5, -0.5, -0.5
MOST_CELLS, KNOWN = 4096, 200_000

SAMPLE, LEXICON, LEAST, CHANCE = 8000, 1 << 16, 3, 0.05
#: Occurrences in a document that count; least and greatest weight; penalty of the regression.
REPEATS, LIGHT, HEAVY, PENALTY = 3, math.log(3), 8.0, 1e-4
PREFIXES = (3, 4, 5, 6, 7, 8)

# Letters that a mark or digit is commonly written for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c",
}

_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[0x80:] = True
_LOOK = np.zeros(256, bool)
_LOOK[[ord(c) for c in LOOKS_LIKE]] = True
#: What a span may begin or end with; a closing exclamation mark is taken for one.
_FIRST = _LETTER | _LOOK
_LAST = _FIRST.copy()
_LAST[[ord("!"), ord("("), ord("<")]] = False
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[ord("a") : ord("z") + 1] = np.arange(1, 27)


def symbol(character: str) -> int:
    """The symbol of a lower-case character; all letters beyond a-z share some classes."""
    code = ord(character)
    if 97 <= code <= 122:
        return code - 96
    return _DIGIT if character.isdigit() else _OTHER + code % (SYMBOLS - _OTHER)


# The channel ----------------------------------------------------------------------------

#: A reading: its cost, its symbols and its characters.
Reading = tuple[float, tuple[int, ...], str]


def readings(span: str) -> list[list[Reading]]:
    """The cells of a lower-case span, each with what it may stand for."""

    def kind(c: str):
        return c if c in LOOKS_LIKE or c.isalnum() or ord(c) >= 0x80 and not c.isspace() else None

    runs = [(c, len(list(group))) for c, group in groupby(span, kind)]
    cells = []
    for place, (c, n) in enumerate(runs):
        if c is None:
            cells.append([(LEFT_OUT, (), ""), (KEPT_APART, (_END,), " ")])
            continue
        letters = LOOKS_LIKE.get(c, "" if c.isdigit() else c)
        read_as = READ_AS if c in LOOKS_LIKE else 0.0
        if n == 2 and not read_as:
            cell = [(0.0, (symbol(c),) * 2, c * 2)]  # ordinary doubles stay
        else:
            copies = (1, 2) if n > 1 else (1,)
            cell = [(read_as, (symbol(x),) * k, x * k) for x in letters for k in copies]
        edge = place in (0, len(runs) - 1)
        if c.isdigit():
            cell.append((0.0, (_DIGIT,) * min(n, 2), c * n))
        if read_as:
            cell.append((LEFT_OUT, (), "") if edge else (KEPT_APART, (_END,), " "))
        cells.append(cell)
    return cells


def best_path(cells: list[list[Reading]], losses) -> str:
    """The likeliest text: readings' costs plus the chance of their symbols, ended."""
    state, score, done = 0, 0.0, []
    for first in range(0, len(cells), MOST_CELLS):
        part = cells[first : first + MOST_CELLS]
        best, steps = {state: score}, []
        for cell in part:
            new: dict[int, float] = {}
            step: dict[int, tuple[int, str]] = {}
            for start, had in best.items():
                for cost, symbols, text in cell:
                    total, at = had + cost, start
                    for x in symbols:
                        at = at * SYMBOLS + x
                        total -= losses[at]
                        at = 0 if x == _END else at % _STATES
                    if total > new.get(at, -math.inf):
                        new[at] = total
                        step[at] = start, text
            best = new
            steps.append(step)
        if first + MOST_CELLS >= len(cells):
            state = max(best, key=lambda s: best[s] - losses[s * SYMBOLS + _END])
        else:
            state = max(best, key=best.get)
        score, at, texts = best[state], state, []
        for step in reversed(steps):
            at, text = step[at]
            texts.append(text)
        done.append("".join(reversed(texts)))
    return "".join(done)


# The language model ---------------------------------------------------------------------


def _spans(texts: Texts, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the maximal runs of the bytes in a table, within rows."""
    data, n = texts.data, len(texts.data)
    inside = which[data]
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = ~inside[:-1], ~inside[1:]
    edges = texts.offsets[(texts.offsets > 0) & (texts.offsets < n)]
    before[edges] = True
    after[edges - 1] = True
    starts = np.flatnonzero(inside & before)
    return starts, np.flatnonzero(inside & after) + 1, np.searchsorted(texts.offsets, starts, "right") - 1


def _symbols(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbol of the character that starts at each byte, and whether one does."""
    start = (data & 0xC0) != 0x80
    out = _SYMBOL[data]
    at = np.flatnonzero(data >= 0xC0)
    if len(at):
        padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int64)
        lead, a, b, c = (padded[at + k] for k in range(4))
        code = np.select(
            [lead < 0xE0, lead < 0xF0],
            [(lead & 0x1F) << 6 | a & 0x3F, (lead & 0x0F) << 12 | (a & 0x3F) << 6 | b & 0x3F],
            (lead & 0x07) << 18 | (a & 0x3F) << 12 | (b & 0x3F) << 6 | c & 0x3F,
        )
        out[at] = _OTHER + code % (SYMBOLS - _OTHER)
    return out, start


def _grams(texts: Texts) -> np.ndarray:
    """The codes of all runs of ``ORDER`` symbols in words, from their start to their end."""
    starts, ends, _ = _spans(texts, _LETTER)
    if not len(starts):
        return np.zeros(0, np.int64)
    symbols, lead = _symbols(texts.data)
    inside = np.zeros(len(texts.data) + 1, np.int64)
    inside[starts] += 1
    inside[ends] -= 1
    lead &= np.cumsum(inside[:-1]) > 0
    lengths = np.add.reduceat(lead, np.stack([starts, np.minimum(ends, len(lead) - 1)], 1).ravel())[::2]
    lengths = np.where(ends == len(lead), np.cumsum(lead)[-1] - np.concatenate([[0], np.cumsum(lead)])[starts], lengths)
    # Each word stands between ends: ORDER - 1 before, one after.
    gaps = ORDER
    place = np.arange(lengths.sum()) + np.repeat(np.arange(1, len(lengths) + 1) * gaps - 1, lengths)
    line = np.zeros(lengths.sum() + gaps * (len(lengths) + 1), np.int64)
    line[place] = symbols[lead]
    codes = line[: -ORDER + 1].copy()
    for k in range(1, ORDER):
        codes = codes * SYMBOLS + line[k : len(line) - ORDER + 1 + k]
    ends_at = np.cumsum(lengths + gaps) - 1  # the end after each word
    wanted = np.concatenate([place, ends_at]) - (ORDER - 1)
    return codes[wanted]


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(SYMBOLS**ORDER, np.int64)
    for batch in batches:
        for texts in pieces(_lower(batch.column("text"))):
            codes = np.sort(_grams(texts))
            if len(codes):
                cuts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
                counts[codes[cuts]] += np.diff(np.append(cuts, len(codes)))
    some = np.flatnonzero(counts)
    for first in range(0, len(some), 1 << 18):
        part = some[first : first + (1 << 18)]
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(counts[part])], ["gram", "n"])


def gram_losses(counts: np.ndarray) -> np.ndarray:
    """The loss (negative logarithm) of each symbol after the ones before, shorter contexts
    weighing ``BACKOFF`` in longer ones."""
    chance = np.full(SYMBOLS, 1 / SYMBOLS)
    for k in range(1, ORDER + 1):
        table = counts.reshape(-1, *[SYMBOLS] * k).sum(axis=0, dtype=np.float64)
        whole = table.sum(axis=-1, keepdims=True)
        chance = (table + BACKOFF * chance) / (whole + BACKOFF)
    return -np.log(chance).ravel().astype(np.float32)


def character_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Losses from the words of all documents: ``SYMBOLS ** ORDER`` numbers."""
    counted = docs.select(F.col(text).alias("text")).mapInArrow(_gram_counts, "gram int, n long")
    table = counted.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SYMBOLS**ORDER, np.int64)
    counts[table.column("gram").to_numpy()] = table.column("n").to_numpy()
    return gram_losses(counts)


# Restoring texts ------------------------------------------------------------------------


def _lower(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column)


def _suspicious(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the spans to decode, in order."""
    data, starts, ends = texts.data, texts.starts, texts.ends
    n = len(data)
    if not len(starts):
        return starts, ends
    # Without the marks around it.
    at = np.arange(n)
    first = np.minimum.accumulate(np.where(_FIRST[data], at, n)[::-1])[::-1]
    last = np.maximum.accumulate(np.where(_LAST[data], at, -1))
    core, stop = first[starts], last[ends - 1] + 1
    sums = {}
    for name, which in (("letters", _LETTER[data] & ((data & 0xC0) != 0x80)), ("looks", _LOOK[data])):
        sums[name] = np.concatenate([[0], np.cumsum(which)])
    again = np.zeros(n, bool)
    again[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & (data[2:] < 0x80) & _LETTER[data[2:]]
    if n >= 6:  # the same for letters of two bytes
        pair = (data[5:] == data[3:-2]) & (data[3:-2] == data[1:-4])
        lead = (data[4:-1] == data[2:-3]) & (data[2:-3] == data[:-5]) & (data[4:-1] >= 0xC0) & (data[4:-1] < 0xE0)
        again[5:] |= pair & lead
    sums["again"] = np.concatenate([[0], np.cumsum(again)])
    good = stop > core

    def count(name: str, edge: int = 0) -> np.ndarray:
        a, b = np.minimum(core + edge, n), np.maximum(stop, np.minimum(core + edge, n))
        return np.where(good, sums[name][b] - sums[name][a], 0)

    letters, looks = count("letters"), count("looks")
    wide = data >= 0x80
    sums["inner"] = np.concatenate([[0], np.cumsum(~_FIRST[data] & ~wide)])
    inner = count("inner")
    odd = good & (letters > 0) & ((looks > 0) | (count("again", 2) > 0))
    odd |= good & (letters > 0) & (inner > 0) & (letters + looks <= 3 * (inner + 1))
    # Single characters one space apart, three or more.
    characters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    single = (characters[ends] - characters[starts] == 1) & _FIRST[data[starts]]
    row = np.searchsorted(texts.offsets, starts, "right") - 1
    joined = np.zeros(len(starts), bool)  # with the word before
    joined[1:] = single[1:] & single[:-1] & (starts[1:] - ends[:-1] == 1) & (row[1:] == row[:-1])
    group = np.cumsum(~joined) - 1
    begins = np.flatnonzero(~joined)
    sizes = np.diff(np.append(begins, len(starts)))
    spaced = sizes >= 3
    letters_in = np.add.reduceat(single & _LETTER[data[starts]], begins)
    spaced &= letters_in > 0
    odd &= ~spaced[group]
    lone = np.flatnonzero(odd)
    many = begins[spaced]
    out_starts = np.concatenate([core[lone], starts[many]])
    out_ends = np.concatenate([stop[lone], ends[many + sizes[spaced] - 1]])
    order = np.argsort(out_starts, kind="stable")
    return out_starts[order], out_ends[order]


@dataclass
class Channel:
    """Restores texts; keeps a bounded number of decoded spans."""

    losses: np.ndarray
    known: dict[bytes, bytes] = field(default_factory=dict)

    def __post_init__(self):
        self.view = memoryview(np.ascontiguousarray(self.losses))

    def decode(self, span: bytes) -> bytes:
        found = self.known.get(span)
        if found is None:
            if len(self.known) >= KNOWN:
                self.known.clear()
            found = best_path(readings(span.decode("utf-8", "replace")), self.view).encode()
            if len(span) <= 256:
                self.known[span] = found
        return found

    def restored(self, texts: Texts) -> Texts:
        """The same rows with every suspicious span as it was meant."""
        starts, ends = _suspicious(texts)
        if not len(starts):
            return texts
        raw, parts, at = texts.data.tobytes(), [], 0
        grown = np.zeros(len(starts) + 1, np.int64)
        for k, (start, end) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
            found = self.decode(raw[start:end])
            parts += [raw[at:start], found]
            grown[k + 1] = grown[k] + len(found) - (end - start)
            at = end
        parts.append(raw[at:])
        offsets = texts.offsets + grown[np.searchsorted(starts, texts.offsets, "left")]
        return Texts(np.frombuffer(b"".join(parts), np.uint8), offsets, texts.rows)


# The lexicon ----------------------------------------------------------------------------


def _features(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature, row and word of the whole words and their beginnings."""
    starts, ends, row = _spans(texts, _LETTER)
    word = np.arange(len(starts))
    keys, rows, words = [span_hashes(texts.data, starts, ends)], [row], [word]
    for k in PREFIXES:
        long = ends - starts >= k
        hashes = span_hashes(texts.data, starts[long], starts[long] + k)
        keys.append(mix(hashes ^ np.uint64(0xA0761D6478BD642F)))
        rows.append(row[long])
        words.append(word[long])
    return np.concatenate(keys), np.concatenate(rows), np.concatenate(words)


def _document_features(channel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct features: in how many documents, and how often; no feature, all words."""
        own = Channel(channel.value)
        for batch in batches:
            toxic = batch.column("toxic").to_numpy()
            for texts in pieces(_lower(batch.column("text"))):
                texts = own.restored(texts)
                key, row, _ = _features(texts)
                order = np.lexsort((row, key))
                key, row = key[order], row[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
                first = np.flatnonzero(new)
                times = np.minimum(np.diff(np.append(first, len(key))), REPEATS)
                key, bad = key[first], toxic[texts.rows][row[first]]
                cuts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
                words = np.bincount(_spans(texts, _LETTER)[2], minlength=len(texts))
                counts = [np.array([0]), np.array([0]), np.array([words @ toxic[texts.rows]]), np.array([words.sum()])]
                if len(cuts):
                    sums = (bad, np.ones(len(key), np.int64), times * bad, times)
                    counts = [np.append(np.add.reduceat(x, cuts), c) for x, c in zip(sums, counts, strict=True)]
                names = np.append(key[cuts].view(np.int64), 0)
                none = np.append(np.zeros(len(cuts), bool), True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, mask=none), *(pa.array(x.astype(np.int64)) for x in counts)],
                    ["feature", *_COUNTS],
                )

    return run


_COUNTS = ("toxic", "n", "often_toxic", "often")


@dataclass
class Model:
    """Losses of the language model, telling features with their weights, and the regression's
    coefficients, or a score for all documents."""

    losses: np.ndarray
    features: np.ndarray  # sorted
    weights: np.ndarray
    coefficients: np.ndarray | None = None
    constant: float = 0.0

    def hits(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, word and feature wherever restored texts hold a telling feature."""
        key, row, word = _features(texts)
        if not len(self.features) or not len(key):
            return (np.zeros(0, np.int64),) * 3
        at = np.minimum(np.searchsorted(self.features, key), len(self.features) - 1)
        hit = np.flatnonzero(self.features[at] == key)
        return row[hit], word[hit], at[hit]

    def summary(self, texts: Texts) -> np.ndarray:
        """What the regression sees of each row."""
        n = len(texts)
        words = np.bincount(_spans(texts, _LETTER)[2], minlength=n)
        row, word, feature = self.hits(texts)
        order = np.lexsort((-self.weights[feature], word))
        row, word, weight = row[order], word[order], self.weights[feature[order]]
        best = np.append(True, word[1:] != word[:-1]) if len(word) else np.zeros(0, bool)
        row, weight = row[best], weight[best]
        total, most = np.bincount(row, weight, n), np.zeros(n)
        np.maximum.at(most, row, weight)
        return np.stack(
            [
                np.ones(n),
                np.minimum(total, 40) / 5,
                np.log1p(words),
                np.minimum(total / np.sqrt(words + 10), 5),
                most / 4,
                np.log1p(np.bincount(row, minlength=n)),
            ],
            axis=1,
        )

    def scores(self, texts: Texts) -> np.ndarray:
        if self.coefficients is None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.summary(texts) @ self.coefficients, -500, 500)))


def regression(rows: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Penalised logistic regression by Newton's method, halving steps that lead uphill."""
    weights = weights / weights.sum()

    def loss(b: np.ndarray) -> float:
        z = rows @ b
        return float(weights @ (np.logaddexp(0, z) - toxic * z) + PENALTY / 2 * (b @ b))

    b = np.zeros(rows.shape[1])
    for _ in range(100):
        chance = 1 / (1 + np.exp(-np.clip(rows @ b, -500, 500)))
        slope = rows.T @ (weights * (chance - toxic)) + PENALTY * b
        bend = (rows * (weights * chance * (1 - chance))[:, None]).T @ rows + PENALTY * np.eye(len(b))
        step, now = np.linalg.solve(bend, slope), loss(b)
        while loss(b - step) > now and np.abs(step).max() > 1e-12:
            step = step / 2
        b = b - step
        if np.abs(step).max() < 1e-10:
            break
    return b


def _significant(hits: Column, of: Column, share: float, features: int) -> Column:
    """Whether ``hits`` of so many are more than chance gives any of the features."""
    own = hits / of
    more = own * F.log(own / share)
    rest = F.when(own < 1, (1 - own) * F.log((1 - own) / (1 - share))).otherwise(0.0)
    return (own > share) & (of * (more + rest) > math.log(max(features, 1) / CHANCE))


def _neighbours(told):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Features of toxic documents with the words around them."""
        model: Model = told.value
        own = Channel(model.losses)
        for batch in batches:
            for texts in pieces(_lower(batch.column("text"))):
                texts = own.restored(texts)
                starts, ends, rows = _spans(texts, _LETTER)
                words = span_hashes(texts.data, starts, ends)
                before, after = np.zeros_like(words), np.zeros_like(words)
                same = rows[1:] == rows[:-1]
                before[1:][same], after[:-1][same] = words[:-1][same], words[1:][same]
                around = mix(mix(before) ^ words) ^ mix(~after)
                _, word, feature = model.hits(texts)
                codes = np.unique(np.stack([feature.astype(np.uint64), around[word]]), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes[0].astype(np.int32)), pa.array(codes[1].view(np.int64))], ["place", "around"]
                )

    return run


def held_out(id: str) -> Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, id: str, text: str, sample: int) -> tuple[DataFrame | None, dict]:
    """Labelled texts that may be learned from, as ``text`` and ``toxic``, and all labels' counts."""
    known = labels.select("doc_id", "toxic").dropna().filter(~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))
    counts = dict(known.groupBy("toxic").count().collect())
    if len(counts) < 2:
        return None, counts
    chosen = None
    for side in (0, 1):
        part = known.filter(F.col("toxic") == side).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.union(part)
    # At most two samples of two numbers a row.
    chosen = F.broadcast(chosen.select(F.col("doc_id").alias("rated"), "toxic"))
    rated = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).join(chosen, F.col("id") == F.col("rated"))
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), "text", "toxic")).alias("first")
    rated = rated.groupBy("id").agg(first).select("first.text", F.col("first.toxic").cast("int").alias("toxic"))
    return stored(rated, "toxic-sample"), counts


def fit(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", sample: int = SAMPLE
) -> Model:
    """``labels``: ``doc_id`` and ``toxic``, of which rows held out are left aside."""
    context = docs.sparkSession.sparkContext
    losses = character_model(docs, text)
    rated, counts = _sample(docs, labels, id, text, sample)
    total = sum(counts.values())
    nothing = Model(losses, np.zeros(0, np.uint64), np.zeros(0), None, counts.get(1, 0) / total if total else 0.0)
    found = dict(rated.groupBy("toxic").count().collect()) if rated is not None else {}
    if len(found) < 2:
        return nothing
    dealt = rated.repartition(max(2, sum(found.values()) // 500), F.xxhash64("text"))
    kinds = ", ".join(f"{c} long" for c in ("feature", *_COUNTS))
    features = dealt.mapInArrow(_document_features(context.broadcast(losses)), kinds)
    features = features.groupBy("feature").agg(*(F.sum(c).alias(c) for c in _COUNTS))
    features = stored(features.filter(F.col("feature").isNull() | (F.col("toxic") >= LEAST)), "toxic-features")
    words = features.filter(F.col("feature").isNull()).first()
    if not words.often_toxic or words.often == words.often_toxic:
        return nothing
    features = features.filter(F.col("feature").isNotNull())
    many, share = features.count(), found[1] / sum(found.values())
    rate = (F.col("often_toxic") + 0.5) / words.often_toxic
    other = (F.col("often") - F.col("often_toxic") + 0.5) / (words.often - words.often_toxic)
    telling = features.withColumn("weight", F.least(F.log(rate / other), F.lit(HEAVY))).filter(
        (F.col("weight") > LIGHT)
        & _significant(F.col("toxic"), F.col("n"), share, many)
        & _significant(F.col("often_toxic"), F.col("often"), words.often_toxic / words.often, many)
    )
    best = telling.orderBy(F.desc(F.col("toxic") * F.col("weight")), "feature").limit(LEXICON).toArrow()
    key = best.column("feature").to_numpy().view(np.uint64)
    order = np.argsort(key)
    model = Model(losses, key[order], best.column("weight").to_numpy()[order])
    # In how many places with different neighbours each feature stands: copies do not add to them.
    toxic = dealt.filter("toxic = 1").mapInArrow(_neighbours(context.broadcast(model)), "place int, around long")
    places = toxic.groupBy("place").agg(F.count_distinct("around").alias("places"))
    counted = np.zeros(len(best), np.int64)
    for row in places.collect():
        counted[row.place] = row.places
    hits, of = best.column("toxic").to_numpy()[order], best.column("n").to_numpy()[order]
    real = np.minimum(hits, counted)
    kept = (real >= LEAST) & _beyond_chance(real, real + of - hits, share, many)
    model = Model(losses, model.features[kept], model.weights[kept])

    def summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = told.value
        own = Channel(model.losses)
        for batch in batches:
            for texts in pieces(_lower(batch.column("text"))):
                rows = model.summary(own.restored(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        lists(rows.ravel(), np.full(len(rows), rows.shape[1]), pa.float64()),
                        batch.column("toxic").slice(texts.rows.start, len(texts)),
                    ],
                    ["x", "toxic"],
                )

    told = context.broadcast(model)
    table = dealt.mapInArrow(summarised, "x array<double>, toxic int").orderBy("toxic", "x").toArrow()
    rows = np.asarray(table.column("x").combine_chunks().flatten()).reshape(len(table), -1)
    toxic = table.column("toxic").to_numpy()
    # The sample's classes weigh as all labels do.
    side = np.array([counts[0] / found[0], counts[1] / found[1]])
    model.coefficients = regression(rows, toxic, side[toxic])
    return model


def _beyond_chance(hits: np.ndarray, of: np.ndarray, share: float, features: int) -> np.ndarray:
    """As ``_significant``, of numbers."""
    own = hits / np.maximum(of, 1)
    more = own * np.log(np.maximum(own, 1e-300) / share)
    rest = np.where(own < 1, (1 - own) * np.log(np.maximum(1 - own, 1e-300) / (1 - share)), 0)
    return (own > share) & (of * (more + rest) > math.log(max(features, 1) / CHANCE))


# Use ------------------------------------------------------------------------------------


def restore(docs: DataFrame, losses: np.ndarray, text: str = "text") -> DataFrame:
    """``row`` (all input columns) and ``restored``: the text in lower case, every suspicious
    span as it was meant."""
    table = docs.sparkSession.sparkContext.broadcast(losses)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Channel(table.value)
        for batch in batches:
            for texts in pieces(_lower(batch.column("text_"))):
                found = own.restored(texts)
                restored = [found.text(a, b) for a, b in zip(found.offsets[:-1], found.offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(texts.rows.start, len(texts)), pa.array(restored, pa.string())],
                    ["row", "restored"],
                )

    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text_"))
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, restored string")


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``row`` (all input columns), ``score`` and ``predicted``."""
    table = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = table.value
        own = Channel(model.losses)
        for batch in batches:
            for texts in pieces(_lower(batch.column("text_"))):
                found = model.scores(own.restored(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(texts.rows.start, len(texts)),
                        pa.array(found),
                        pa.array((found >= 0.5).astype(np.int32)),
                    ],
                    ["row", "score", "predicted"],
                )

    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text_"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, score double, predicted int")
