"""LM scoring by cross-entropy difference.

A target model (documents labelled good and clean) and a background model (all documents)
are matched: word bigrams over one vocabulary of every word that any text holds, one
smoothing. The loss of each word and of the text's end under the target model less its loss
under the background model is averaged over the document; the lower, the closer to the
target. Vocabulary and counts come from all documents, whole, and grow with them:

* Each task turns its texts into blocks: the distinct words of about ``BLOCK`` bytes of text
  and the texts as numbers of those words. Blocks are stored in buckets, so that flags and
  answers come to them and they stay where they are; texts are read once.
* A block asks for the counts of its distinct words and bigrams. The questions are dealt out
  by the leading bits of the n-gram's hash, so that each bucket sums some n-grams of all
  blocks. The most frequent n-gram stands once in a block, so no bucket is hot.
* The answers go back to the blocks, which score their texts. The driver sees three totals.

N-grams are told apart by leading bits of a 64-bit hash, as many as give one a chance of
``2 ** -GUARD`` to share them with another, however large the corpus is. What is sent is
packed: differences of sorted hashes, and counts, as compressed planes of bytes.

Defined results: a text without words (null, empty) has no tokens and a null score. Without
target documents the target model gives all tokens equal chances.
Labels with nulls count for nothing. Ids can be null or repeated, each row is scored.
"""

from __future__ import annotations

import secrets
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import scratch_dir, stored
from .text import mix, pieces

BLOCK = 1 << 21
#: N-grams asked for in one bucket, about.
QUESTIONS = 1 << 20
GUARD = 24
MASS = 50.0

_U = np.uint64
_ONE, _FACTOR = _U(1), _U(0xD6E8FEB86659FD93)
#: What stands before a text and after it.
START, END = _U(0x5851F42D4C957F2D), _U(0x14057B7EF767814F)

_BLOCK = "block long, ids array<{}>, counts binary, n_tokens long, words binary, tokens binary"
_QUESTION = "bucket int, block long, keys binary, n binary, target binary"
_ANSWER = "bucket int, block long, n binary, target binary, types long, tokens double, target_tokens double"


def packed(values: np.ndarray) -> bytes:
    """Whole numbers, none below 0."""
    width = (int(values.max(initial=0)).bit_length() + 7) // 8
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    head = np.array([len(values), width], "<u8").tobytes()
    return head + pa.compress(planes, "zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n, width = (int(x) for x in np.frombuffer(data, "<u8", 2))
    planes = pa.decompress(data[16:], n * width, "zstd", asbytes=True)
    values = np.zeros((n, 8), np.uint8)
    values[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return values.reshape(-1).view("<u8")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("id")
        for texts in pieces(batch.column("text"), BLOCK):
            words, tokens = np.unique(texts.words, return_inverse=True)
            some = ids.slice(texts.rows.start, len(texts))
            yield pa.RecordBatch.from_arrays(
                [
                    # Drawn once: the blocks are stored before they are used.
                    pa.array([secrets.randbits(62)], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some),
                    pa.array([packed(texts.counts)]),
                    pa.array([len(tokens)], pa.int64()),
                    pa.array([words.tobytes()]),
                    pa.array([packed(tokens)]),
                ],
                ["block", "ids", "counts", "n_tokens", "words", "tokens"],
            )


def word_keys(words: np.ndarray, width: int) -> np.ndarray:
    return words >> _U(64 - width) << _ONE | _ONE


def bigram_keys(before: np.ndarray, after: np.ndarray, width: int) -> np.ndarray:
    return mix(before * _FACTOR + after) >> _U(64 - width) << _ONE


def transitions(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What stands before each word and each end of a text, the word or end, and its row."""
    rows = np.flatnonzero(counts)
    sizes = counts[rows].astype(np.int64) + 1
    ends = np.cumsum(sizes)
    after = np.empty(int(sizes.sum()), _U)
    last = np.zeros(len(after), bool)
    last[ends - 1] = True
    after[last], after[~last] = END, words
    before = np.empty_like(after)
    before[1:] = after[:-1]
    before[ends - sizes] = START
    return before, after, np.repeat(rows, sizes)


def _block(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    counts, words, tokens = (table.column(x)[0].as_py() for x in ("counts", "words", "tokens"))
    counts = unpacked(counts).astype(np.int64)
    return *transitions(np.frombuffer(words, _U)[unpacked(tokens)], counts), counts


def _asked(before: np.ndarray, after: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of a block, sorted, and where those of its words and then of its
    bigrams stand there."""
    keys = np.concatenate([word_keys(after, width), bigram_keys(before, after, width)])
    return np.unique(keys, return_inverse=True)


def _questions(bits: int, width: int):
    edges = np.arange(1, 1 << bits, dtype=_U) << _U(width + 1 - bits)

    def run(block: pa.Table, targets: pa.Table) -> pa.Table:
        out = {name: [] for name in ("bucket", "block", "keys", "n", "target")}
        before, after, row, counts = _block(block)
        hit = np.zeros(len(counts), bool)
        hit[targets.column("pos").to_numpy()] = True
        keys, at = _asked(before, after, width)
        n = np.bincount(at, minlength=len(keys))
        target = np.bincount(at, np.tile(hit[row], 2), len(keys)).astype(np.int64)
        bounds = np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
        for bucket in np.flatnonzero(np.diff(bounds)):
            part = slice(bounds[bucket], bounds[bucket + 1])
            out["bucket"].append(int(bucket))
            out["block"].append(block.column("block")[0].as_py())
            out["keys"].append(packed(np.diff(keys[part], prepend=_U(0))))
            out["n"].append(packed(n[part]))
            out["target"].append(packed(target[part]))
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.table([pa.array(out[name], kind) for name, kind in zip(out, kinds)], list(out))

    return run


def _answers(asked: pa.Table) -> pa.Table:
    """The sums of every n-gram of a bucket, for each block in the order of its question.
    The first row also holds how many words the bucket has and how often they occur."""
    parts = [np.cumsum(unpacked(x.as_py()), dtype=_U) for x in asked.column("keys")]
    bounds = np.cumsum([0, *map(len, parts)])
    keys, at = np.unique(np.concatenate(parts), return_inverse=True)
    is_word = (keys & _ONE).astype(bool)
    sums, totals = [], []
    for name in ("n", "target"):
        one = np.concatenate([unpacked(x.as_py()) for x in asked.column(name)])
        whole = np.bincount(at, one, len(keys))
        found = whole.astype(np.int64)[at]
        sums.append(pa.array([packed(found[a:b]) for a, b in zip(bounds, bounds[1:])], pa.binary()))
        totals.append(float(whole[is_word].sum()))
    rest = [0] * (len(parts) - 1)
    return pa.table(
        [
            asked.column("bucket"),
            asked.column("block"),
            *sums,
            pa.array([int(is_word.sum()), *rest], pa.int64()),
            *(pa.array([x, *rest], pa.float64()) for x in totals),
        ],
        ["bucket", "block", "n", "target", "types", "tokens", "target_tokens"],
    )


def losses(pair, before, after, total: float, types: int):
    """The loss of a token, for the counts of its bigram, of what stands before it and of
    itself, in a corpus of ``total`` tokens of ``types`` kinds."""
    single = (after + 1.0) / (total + types)
    return np.log(before + MASS) - np.log(pair + MASS * single)


def _scores(width: int, types: int, totals: tuple[float, float]):
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        before, after, row, counts = _block(block)
        keys, at = _asked(before, after, width)
        words, bigrams = at[: len(after)], at[len(after) :]
        # A text's start is seen as often as its end, and a word before as often as after.
        context = np.searchsorted(keys, word_keys(np.where(before == START, END, before), width))
        answers = answers.sort_by("bucket")
        loss = []
        for name, total in zip(("n", "target"), totals):
            n = np.concatenate([np.zeros(0), *(unpacked(x.as_py()) for x in answers.column(name))])
            loss.append(losses(n[bigrams], n[context], n[words], total, types))
        sums = np.bincount(row, loss[1] - loss[0], len(counts))
        ids = block.column("ids").combine_chunks().flatten()
        score = pa.array(sums / (counts + 1.0), mask=counts == 0)
        return pa.table([ids, pa.array(counts.astype(np.int64)), score], ["id", "n_tokens", "score"])

    return run


def _in_buckets(blocks: DataFrame) -> DataFrame:
    """Stored by the hash of ``block``: no exchange moves them when they are grouped by it."""
    spark, name = blocks.sparkSession, f"lm_blocks_{uuid.uuid4().hex}"
    writer = blocks.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block")
    writer.option("path", scratch_dir(spark, "lm-blocks")).saveAsTable(name)
    return spark.table(name)


def score(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``n_tokens`` (words) and ``score`` of every row."""
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    blocks = _in_buckets(rows.mapInArrow(_blocks, _BLOCK.format(kind)))
    words = blocks.agg(F.sum("n_tokens").alias("n")).first().n or 0
    bits = (words // QUESTIONS).bit_length()
    width = min(63, (2 * words).bit_length() + GUARD)

    good = labels.filter("quality = 1 AND toxic = 0").select(F.col("doc_id").alias("id")).distinct()
    targets = blocks.select("block", F.posexplode("ids").alias("pos", "id"))
    targets = targets.join(good.hint("merge"), "id").select(F.col("block").alias("home"), "pos")
    questions = (
        blocks.groupBy("block").cogroup(targets.groupBy("home")).applyInArrow(_questions(bits, width), _QUESTION)
    )
    answers = stored(questions.groupBy("bucket").applyInArrow(_answers, _ANSWER), "lm-answers")
    sums = answers.agg(*(F.sum(x).alias(x) for x in ("types", "tokens", "target_tokens"))).first()
    scores = _scores(width, sums.types or 0, (sums.tokens or 0.0, sums.target_tokens or 0.0))
    found = answers.select("block", "bucket", "n", "target")
    return (
        blocks.groupBy("block")
        .cogroup(found.groupBy("block"))
        .applyInArrow(scores, f"id {kind}, n_tokens long, score double")
    )
