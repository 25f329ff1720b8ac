import hashlib
import random
import re
import zlib

import pytest

from changeloom.llm import tries
from changeloom.llm.tries import SpillingQueue, prefix_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id LONG, turn LONG, role STRING, text STRING"


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))

    def key(t):
        return (*t[:3], t[3][:64], hashlib.sha256(t[3].encode()).hexdigest())

    turns = {c: [(r, t) for _, _, r, t in sorted(own[c], key=key)] for c in own}
    out = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        remainder = abs(c) % 20 * (1 if c >= 0 else -1)
        out[c] = turns.get(c - remainder, [])[:h] + turns[c][h:]
    return out


def brute(rows):
    convs = rebuilt(rows)
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, members in nodes.items():
        below = [x for x in nodes if x[: len(node)] == node]
        kids = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in nodes)]
        saved = sum((len(nodes[x]) - 1) * len(WORD.findall(x[-1][1])) for x in below if x)
        ends = sorted(c for c in members if len(convs[c]) == len(node))
        out.append(
            (
                min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members), len(kids),
                len(leaves), saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    """Shared heads, copies, prefixes of others, ties, nulls, gaps, and one long conversation."""
    rng = random.Random(9)
    talk = [[(rng.choice(["user", "assistant"]), f"word{rng.randrange(4)} a\tb {k}") for k in range(6)] for _ in range(3)]
    out = []
    for c in rng.sample(range(-60, 400), 150):
        turns = rng.choice(talk)[: rng.randrange(7)] + [("user", f"own {rng.randrange(9)}")] * rng.randrange(3)
        out += [(c, k if k else None, role, text) for k, (role, text) in enumerate(turns)]
    out += [(1000, 5, "b", "same turn"), (1000, 5, "a", "same turn"), (1000, 5, None, None), (1000, None, "a", "x" * 70 + "1")]
    out += [(1000, None, "a", "x" * 70 + "0"), (1001, 1, "a", "t"), (1001, 1, "a", "t"), (None, 1, "a", "no id")]
    for c in (2000, 2020, 9_223_372_036_854_775_807, -9_223_372_036_854_775_808):
        out += [(c, k, "user", f"long {k % 7}") for k in range(300)]
    out += [(2040, k, "user", f"long {k % 7}") for k in range(299)]
    return out


def test_nodes_equal_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    df = df.selectExpr("*", "1 AS depth", "2 AS n1", "3 AS conv")
    assert found(prefix_trie(df)) == brute(rows)


def test_small_shards_chunks_and_queues_change_nothing(spark, rows, monkeypatch):
    for name, value in (("LEAST_LIMIT", 2), ("CHUNK", 10)):
        monkeypatch.setattr(tries, name, value)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        some = [r for r in rows if r[0] is None or abs(r[0]) < 1500 or r[1] < 60]
        assert found(prefix_trie(spark.createDataFrame(some, SCHEMA), in_memory=4)) == brute(some)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_no_conversations_and_turnless_ones(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie(empty).count() == 0
    assert prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0
    # Heads of conversations whose source is not there are taken off without anything instead.
    some = [(c, 0, "user", "hello") for c in range(1, 20)]
    assert any(not t for t in rebuilt(some).values())
    assert found(prefix_trie(spark.createDataFrame(some, SCHEMA))) == brute(some)


def test_a_queue_that_spills_gives_back_all_in_order():
    rng = random.Random(2)
    queue, items, out = SpillingQueue(most=8), [], []
    for k in range(500):
        if rng.random() < 0.7 or not items:
            item = (rng.randrange(1000), k)
            queue.push(item)
            items.append(item)
        else:
            assert queue.peek() == min(items)
            out.append(queue.pop())
            items.remove(out[-1])
    rest = [queue.pop() for _ in items]
    assert rest == sorted(items) and queue.peek() is None and len(queue.files) > 3
