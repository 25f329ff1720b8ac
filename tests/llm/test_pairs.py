"""Operators on pairs of documents, words and vectors, against brute force."""

import gc
import random
import weakref
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from changeloom.llm import jaccard, substring
from changeloom.llm.components import components
from changeloom.llm.embeddings import embedding_links
from changeloom.llm.jaccard import common_runs, jaccard_join, runs_for
from changeloom.llm.substring import dedup_substrings
from changeloom.llm.text import pieces
from tests.llm import brute
from tests.llm.conftest import SCHEMA, sentence


def least(ids):
    return min(ids, key=lambda x: (x is not None, x or 0))


def test_jaccard_join_equals_brute_force(docs, rows_of):
    links = brute.links([t for _, t in rows_of])
    label = brute.reach(links)
    expected = Counter()
    for k, (doc_id, _) in enumerate(rows_of):
        group = [i for j, (i, _) in enumerate(rows_of) if label[j] == label[k]]
        expected[doc_id, len(links[k]), least(group)] += 1
    found = jaccard_join(docs).select("id", "n_links", "class_id").collect()
    assert Counter(map(tuple, found)) == expected


@pytest.mark.parametrize("small", [True, False])
def test_large_similar_nodes_are_split_or_compared_in_blocks(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(jaccard, "NODE", 8)
        monkeypatch.setattr(jaccard, "BLOCK_SETS", 7)
    rng = random.Random(2)
    base, passage = sentence(rng, 100), sentence(rng, 50)
    texts = [f"{base} e{k}" for k in range(60)]
    texts += [f"{passage} {sentence(rng, 60)}" for _ in range(60)]
    df = spark.createDataFrame([(k, t, "", "", 0) for k, t in enumerate(texts)], SCHEMA)
    links = brute.links(texts)
    label = brute.reach(links)
    found = {r["id"]: (r["n_links"], r["class_id"]) for r in jaccard_join(df).collect()}
    assert found == {k: (len(links[k]), label[k]) for k in range(len(texts))}


def test_runs_reach_the_recall():
    more = jaccard.MORE_RUNS
    assert runs_for(0.9999, 0.8) == 15 + more and runs_for(0.5, 0.8) < 3 + more


def test_common_runs():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.int64)) for _ in range(90)]
    shared = common_runs(sets)
    assert all(shared[i, j] == len(np.intersect1d(a, b)) for i, a in enumerate(sets) for j, b in enumerate(sets))


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(500, 560)]
    label = {x: x for p in pairs for x in p}
    for _ in range(300):
        for u, v in pairs:
            label[u] = label[v] = min(label[u], label[v])
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "u LONG, v LONG")).collect()}
    linked = {x for u, v in pairs if u != v for x in (u, v)}
    assert found.keys() == linked
    groups = {}
    for node, root in found.items():
        groups.setdefault(root, set()).add(node)
    expected = {}
    for node in linked:
        expected.setdefault(label[node], set()).add(node)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))
    assert components(spark.createDataFrame([], "u LONG, v LONG")).count() == 0


def test_substrings_equal_brute_force(docs, rows_of):
    expected = Counter((i, *x) for (i, _), x in zip(rows_of, brute.kept([t for _, t in rows_of])))
    found = dedup_substrings(docs)
    rows = found.select("row.doc_id", "n_words", "n_removed", "kept").collect()
    assert Counter(map(tuple, rows)) == expected
    spans = found.selectExpr("n_removed", "aggregate(spans, 0L, (a, s) -> a + s.length) AS n").collect()
    assert all(r["n"] == r["n_removed"] for r in spans)
    assert found.select("row.*").columns == docs.columns


def test_windows_of_a_piece_go_before_the_next_without_a_collection(monkeypatch):
    """Arrays are few objects, so that a task sees no collection for hundreds of pieces."""
    made = []

    class Counted(substring._Windows):
        def __init__(self, *args):
            super().__init__(*args)
            made.append(weakref.ref(self))

    monkeypatch.setattr(substring, "_Windows", Counted)
    monkeypatch.setattr(substring, "pieces", lambda column: pieces(column, 500))
    rng = random.Random(6)
    texts = pa.array([sentence(rng, 120) for _ in range(12)])
    none = pa.array([[]] * len(texts), pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts))), texts, pa.StructArray.from_arrays([texts], ["text"]), none, none],
        ["key", "text", "row", "lone_anchors", "lone_windows"],
    )
    runs = (substring._anchors(35), substring._candidates(35, 0), substring._remove(35, 0))
    gc.collect()
    gc.disable()
    try:
        for run in runs:
            made.clear()
            alive = [sum(w() is not None for w in made) for _ in run(iter([batch]))]
            assert len(alive) == len(made) == len(texts) and max(alive) == 1
    finally:
        gc.enable()


VECTORS = [
    (1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (3, [2.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None),
    (6, [0.0, 0.0], 1), (7, None, 1), (8, [1.0, None], 1), (9, [float("nan"), 1.0], 1), (10, [float("inf"), 1.0], 1),
    (11, [1.0], 1), (12, [0.0, -1.0], 1), (13, [1.0, 0.0], 1), (None, [0.0, -3.0], 1), (15, [], 1),
    (16, [3e-30, 0.0], 1), (16, [0.0, 5.0], 1),
]


def test_vectors_of_every_kind(spark):
    df = spark.createDataFrame(VECTORS, "vec_id LONG, embedding ARRAY<FLOAT>, label INT")
    df = df.selectExpr("*", "1 AS id", "2 AS vector", "3 AS cell")
    found = Counter(map(tuple, embedding_links(df).collect()))
    east = {1: 4, 2: 4, 3: 4, 13: 4, 16: 4}
    expected = Counter({(i, n, 1, i == 1): 1 for i, n in east.items()})
    expected[12, 1, 12, True] += 1
    expected[None, 1, 12, False] += 1
    for alone in (4, 5, 6, 7, 8, 9, 10, 11, 15, 16):
        expected[alone, 0, alone, True] += 1
    assert found == expected
    assert embedding_links(df.limit(0)).count() == 0


@pytest.mark.parametrize("per_cell, askers, others, part", [(40, 16, 16, 128), (400, 100, 64, 7), (20, 16, 400, 5)])
def test_links_in_cells_equal_brute_force(spark, monkeypatch, per_cell, askers, others, part):
    from changeloom.llm import embeddings

    for name, value in (("PER_CELL", per_cell), ("ASKERS", askers), ("OTHERS", others), ("PART", part)):
        monkeypatch.setattr(embeddings, name, value)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 8))
    x = (centres[rng.integers(0, 40, 400)] + rng.normal(size=(400, 8)) * 0.12).astype(np.float32)
    labels = rng.integers(0, 2, 400)
    df = spark.createDataFrame(
        [(k, x[k].tolist(), int(labels[k])) for k in range(400)], "vec_id LONG, embedding ARRAY<FLOAT>, label INT"
    )
    unit = x.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.98) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    assert near.sum() > 100
    label = brute.reach([set(np.flatnonzero(r)) for r in near])
    expected = {k: (int(near[k].sum()), int(label[k])) for k in range(400)}
    assert {r["id"]: (r["n_links"], r["component_id"]) for r in embedding_links(df).collect()} == expected


@pytest.mark.parametrize("operator", [jaccard_join, dedup_substrings])
def test_empty_tables(empty, operator):
    assert operator(empty).count() == 0


def test_runs_meet_the_recall_through_all_further_splits():
    """Pairs at the threshold whose nodes go through every further split, by the scheme itself:
    tokens of a run are those of its path, and further ones are taken from the other runs."""
    rng = np.random.default_rng(4)
    runs, pairs = jaccard.runs_for(0.9999, 0.8), 200_000
    depth, n = jaccard.DEPTH, jaccard.runs_for(0.9999, 0.8) * jaccard.DEPTH
    equal = rng.random((pairs, n)) < 0.8
    met = np.zeros(pairs, bool)
    for run in range(runs):
        alive = equal[:, run * depth : (run + 1) * depth].all(axis=1)
        paths = [alive]
        for _ in range(jaccard.FURTHER):
            children = []
            for path in paths:
                for _child in (0, 1):
                    place = (rng.integers(0, n - depth, pairs) + (run + 1) * depth) % n
                    children.append(path & equal[np.arange(pairs), place])
            paths = children
        met |= np.logical_or.reduce(paths)
    assert met.mean() >= 0.9999
