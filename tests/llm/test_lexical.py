import math
import random
import re

import numpy as np
import pytest

from changeloom.llm import lexical
from tests.llm.conftest import sentence

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, places=50):
    """(item_id, rank, doc_id, score) of distinct items."""
    lists = [(i, terms(t)) for i, t in docs]
    lists = [(i, w) for i, w in lists if w]
    n_docs, total = len(lists), sum(len(w) for _, w in lists)
    df = {}
    for _, words in lists:
        for w in set(words):
            df[w] = df.get(w, 0) + 1
    weight = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for w, n in df.items()}
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, words in lists:
            m = 50 + 50 * len(words) * n_docs // total
            score = sum(
                weight[w] * (1_000_000_000 * words.count(w) // (1000 * words.count(w) + 20 * m))
                for w in set(terms(text)) if w in words
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        scored.sort()
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(scored[:places])]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "id", "score").collect()), key=repr)


ITEMS = "item_id LONG, text STRING"


@pytest.fixture(scope="module")
def items(texts):
    rng = random.Random(8)
    rows = [(k, " ".join(rng.sample((t or "a b c").split() or ["x"], 1) * 2 + sentence(rng, 6).split())) for k, t in enumerate(texts)]
    return [*rows, rows[0], (2, "w1 W2 w1"), (50, None), (51, ""), (52, "É é你好 w3-w4"), (None, "w5"), (53, "nowhere")]


def test_ranks_equal_brute_force(spark, docs, rows_of, items):
    benchmark = spark.createDataFrame(items, ITEMS).selectExpr("*", "1 AS id", "2 AS score")
    assert found(lexical.search(docs, benchmark)) == brute(rows_of, items)


def test_blocks_of_items_and_small_buckets_change_nothing(spark, docs, rows_of, items, monkeypatch):
    benchmark = spark.createDataFrame(items, ITEMS)
    monkeypatch.setattr(lexical, "TERMS", 60)
    monkeypatch.setattr(lexical, "SEEDS", 5)
    blocks = list(lexical._items(benchmark, "item_id", "text"))
    assert len(blocks) > 2
    assert found(lexical.search(docs, benchmark)) == brute(rows_of, items)


def test_buckets_are_passed_over_and_ties_stand_by_id(spark):
    """Many copies with equal scores, in any order of ids, and most vectors never scored."""
    rng = random.Random(3)
    rows = [(k, "hot cold warm") for k in rng.sample(range(10_000), 300)]
    rows += [(20_000 + k, f"cold filler{k} " + " ".join(["pad"] * 30)) for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    items = [(1, "hot cold"), (2, "pad"), (3, "warm hot")]
    assert found(lexical.search(docs, spark.createDataFrame(items, ITEMS))) == brute(rows, items)
    weights = np.array([3000, 10], np.int64)
    queries = lexical.Queries([np.array([0, 1])], weights)
    best = lexical._Best(1, np.zeros(1, np.int64))
    ids, missing = np.arange(1024), np.zeros(1024, bool)
    row, term = np.arange(1024), np.zeros(1024, np.int64)

    def bucket(impact, term):
        lengths = np.sqrt(weights[term]) * impact
        return lexical.search_bucket(queries, best, ids, missing, lengths, row, term, impact.astype(np.int64))

    assert bucket(np.full(1024, 900_000), term) == 1024
    assert bucket(np.full(1024, 800_000), term) == 0  # too short
    assert bucket(np.full(1024, 10_000_000), term + 1) == 0  # long, but not where it counts


def test_terms_with_bytes_alike_are_told_apart():
    from changeloom.llm.text import span_hashes

    known = lexical.Terms.of([b"ab", b"abc", "é".encode()])
    data = np.frombuffer("ab abc é abd".encode(), np.uint8)
    starts, ends = np.array([0, 3, 7, 10]), np.array([2, 6, 9, 13])
    place = known.find(data, starts, ends)
    assert (place[:3] >= 0).all() and len(set(place[:3].tolist())) == 3 and place[3] == -1
    known.hashes = np.sort(span_hashes(data, starts, ends))  # the hash of another term
    assert (known.find(data, starts[3:], ends[3:]) == -1).all()


def test_empty_tables(spark, docs, empty):
    items = spark.createDataFrame([(1, "w1 w2")], ITEMS)
    assert lexical.search(empty, items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0
    assert lexical.search(docs.filter("text IS NULL"), items).count() == 0
    schema = lexical.search(docs, items).dtypes
    assert schema == [("item_id", "bigint"), ("rank", "int"), ("id", "bigint"), ("score", "bigint")]
    assert lexical.search(docs, items.limit(0)).dtypes == schema
