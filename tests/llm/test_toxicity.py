import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from changeloom.llm import toxicity
from changeloom.llm.text import pieces
from changeloom.llm.toxicity import ORDER, SYMBOLS, Channel, best_path, gram_losses, readings, symbol

WORDS = "the idiot was a moron but clown never met pathetic loser in stupid town asshole roost feel".split()
SYLLABLES = "ba ke lo mi tu ra sen vor dal pi ko ner zu fa gol het".split()


def texts_of(*rows):
    return next(pieces(toxicity._lower(pa.array(rows, pa.string()))))


def grams(text):
    out = []
    for word in re.findall(r"[a-z\u0080-\U0010ffff]+", text.lower()):
        line = [0] * (ORDER - 1) + [symbol(c) for c in word] + [0]
        for k in range(len(line) - ORDER + 1):
            code = 0
            for x in line[k : k + ORDER]:
                code = code * SYMBOLS + x
            out.append(code)
    return sorted(out)


@pytest.fixture(scope="module")
def losses():
    counts = np.zeros(SYMBOLS**ORDER, np.int64)
    for word in WORDS * 5:
        np.add.at(counts, grams(word), 1)
    return gram_losses(counts)


@pytest.mark.parametrize("row", ["Hello wörld, it's", "", "é", "ab é你好 😀x", "A-b_c 12 d3e"])
def test_runs_of_symbols_equal_brute_force(row):
    assert sorted(toxicity._grams(texts_of("before", row, "after")).tolist()) == sorted(
        grams("before") + grams(row) + grams("after")
    )


def test_losses_are_those_of_a_distribution(losses):
    sums = np.exp(-losses.astype(np.float64)).reshape(-1, SYMBOLS).sum(axis=1)
    assert np.allclose(sums, 1, atol=1e-4)


def cost(path, losses):
    total, at = 0.0, 0
    for reading_cost, symbols, _ in path:
        total += reading_cost
        for x in symbols:
            at = at * SYMBOLS + x
            total -= losses[at]
            at = 0 if x == 0 else at % SYMBOLS ** (ORDER - 1)
    return total - losses[at * SYMBOLS]


@pytest.mark.parametrize("span", ["1d10t", "m0r0n", "i d i o t", "$tup1d", "l00o0ser", "p.a.t.h", "x!!y", "aaa", "11a", "clöön1"])
def test_the_best_path_is_the_best_of_all(losses, span):
    cells = readings(span)
    every = max(itertools.product(*cells), key=lambda path: cost(path, losses))
    found = best_path(cells, losses)
    paths = [p for p in itertools.product(*cells) if "".join(x[2] for x in p) == found]
    assert max(cost(p, losses) for p in paths) == pytest.approx(cost(every, losses), abs=1e-4)


def test_long_spans_are_decoded_in_stretches(losses, monkeypatch):
    whole = best_path(readings("1d10t.m0r0n"), losses)
    monkeypatch.setattr(toxicity, "MOST_CELLS", 4)
    assert len(best_path(readings("1d10t" * 50), losses)) > 100
    assert best_path(readings("clown"), losses) == "clown" and whole == "idiot moron"


@pytest.mark.parametrize(
    ("written", "meant"),
    [
        ("You 1D10T!", "you idiot!"), ("what an i d i o t", "what an idiot"), ("i_d_i_o_t", "idiot"),
        ("cl0wn, m0r0n", "clown, moron"), ("$tuuuupid", "stupid"), ("lo$er p4th3tic", "loser pathetic"),
        ("roost feel", "roost feel"), ("in 2024", "in 2024"), ("m o r o n\ni d i o t", "moron idiot"),
        ("", ""), ("the", "the"), ("...", "..."), ("asssshole", "asshole"),
    ],
)
def test_texts_are_restored(losses, written, meant):
    found = Channel(losses).restored(texts_of("x", written, "y"))
    rows = [found.text(a, b) for a, b in zip(found.offsets[:-1], found.offsets[1:])]
    assert rows == ["x", meant, "y"]


def disguised(rng, word):
    leet = {"o": "0", "i": "1", "e": "3", "a": "4", "s": "$"}
    how = rng.randrange(3)
    if how == 0:
        return "".join(leet.get(c, c) for c in word)
    if how == 1:
        return " ".join(word)
    k = rng.randrange(len(word))
    return word[:k] + word[k] * 4 + word[k + 1 :]


def corpus(n, seed, hidden=False):
    """Texts of invented words, of which a tenth holds some bad ones."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices(SYLLABLES, k=rng.randrange(1, 4))) for _ in range(900)]
    bad = ["idiot", "moron", "clown", "loser", "scum"]
    rows = []
    for k in range(n):
        words = rng.choices(vocabulary, k=rng.randrange(30, 120))
        toxic = int(rng.random() < 0.15)
        for word in rng.sample(bad, 2) if toxic else []:
            words.insert(rng.randrange(len(words)), disguised(rng, word) if hidden else word)
        rows.append((seed * 100_000 + k, " ".join(words), toxic))
    return rows


def test_hidden_words_are_found_where_plain_ones_were_learned(spark):
    rows, new = corpus(900, 1), corpus(300, 2, hidden=True)
    # A toxic text and two hundred copies of it, all labelled: its other words say nothing.
    copy = next(t for _, t, bad in rows if bad)
    rows += [(700_000 + k, copy, 1) for k in range(200)]
    innocent = [w for w in copy.split() if w not in ("idiot", "moron", "clown", "loser", "scum")]
    schema = "doc_id LONG, text STRING, toxic INT"
    known = spark.createDataFrame(rows, schema)
    docs = known.drop("toxic").union(spark.createDataFrame(new, schema).drop("toxic"))
    model = toxicity.fit(docs, known.drop("text"))
    scored = {r["doc_id"]: r for r in toxicity.score(docs, model).select("row.doc_id", "score", "predicted").collect()}
    truth = {i: t for i, _, t in new}
    right = sum(scored[i]["predicted"] == t for i, t in truth.items())
    caught = sum(scored[i]["predicted"] for i, t in truth.items() if t)
    assert right >= 0.97 * len(truth) and caught >= 0.9 * sum(truth.values())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in scored.values())
    clean = spark.createDataFrame([(1, " ".join(innocent))], "doc_id LONG, text STRING")
    assert toxicity.score(clean, model).first()["predicted"] == 0
    again = toxicity.fit(docs.repartition(7).orderBy(F.rand(3)), known.drop("text").orderBy(F.rand(4)))
    assert (again.features == model.features).all() and np.array_equal(again.coefficients, model.coefficients)


def test_labels_of_held_out_rows_are_not_learned_from(spark):
    rows = corpus(500, 3)
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING, toxic INT")
    asked = df.select(toxicity.held_out("doc_id").alias("h"), "doc_id").filter("h").collect()
    assert sorted(r["doc_id"] for r in asked) == sorted(held)
    wrong = df.withColumn("toxic", F.when(F.col("doc_id").isin(held), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    model, other = (toxicity.fit(df.drop("toxic"), x.drop("text")) for x in (df, wrong))
    assert np.array_equal(model.features, other.features) and np.array_equal(model.coefficients, other.coefficients)


def test_regression_is_at_the_least_loss():
    rng = np.random.default_rng(1)
    rows = np.column_stack([np.ones(80), rng.normal(size=(80, 2))])
    toxic = (rows[:, 1] + rng.normal(size=80) > 0).astype(int)
    weights = np.where(toxic, 2.0, 1.0)
    b = toxicity.regression(rows, toxic, weights)

    def loss(b):
        z = rows @ b
        return weights @ (np.logaddexp(0, z) - toxic * z) / weights.sum() + toxicity.PENALTY / 2 * b @ b

    for k in range(3):
        step = np.eye(3)[k] * 1e-5
        assert abs(loss(b + step) - loss(b - step)) / 2e-5 < 1e-6


def test_rows_of_all_kinds(spark, docs, empty):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, None), (None, 1), (3, 0), (999, 1)], "doc_id LONG, toxic INT"
    )
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model)
    assert rows.count() == docs.count() and not rows.filter("score IS NULL OR score < 0 OR score > 1").count()
    assert toxicity.score(empty, model).count() == 0 and toxicity.restore(empty, model.losses).count() == 0
    none = toxicity.fit(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.score(docs, none).select("score").collect()} == {0.0}
    assert toxicity.fit(empty, labels).coefficients is None
    restored = toxicity.restore(docs, model.losses).select("row.text", "restored").collect()
    assert all((r["restored"] == "") == (not r["text"]) for r in restored)


def test_a_long_word_and_a_long_run_of_characters(losses):
    rng = random.Random(4)
    text = "".join(rng.choices("abc013", k=200_000)) + " " + " ".join("ab" * 5000)
    found = Channel(losses).restored(texts_of(text))
    assert len(found) == 1 and len(found.data) > 100_000
