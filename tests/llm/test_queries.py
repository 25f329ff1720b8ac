"""The registered queries on the given tables, against SQL, and the pipeline."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from changeloom.llm import jaccard, quality
from changeloom.llm.oracles import ORACLES
from changeloom.llm.queries import QUERIES
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", QUERIES)
def test_queries_return_every_row_and_equal_their_sql(spark, sql, name):
    result = QUERIES[name](spark, FOLDER)
    columns = sorted(result.columns)
    actual = sorted((tuple(r) for r in result.select(*columns).collect()), key=repr)
    table = {"op4": "embeddings", "op6": "pages"}.get(name.split("_")[0], "documents")
    if name.split("_")[0] not in ("op5", "op12", "op13"):
        assert len(actual) == sql.execute(f"SELECT count(*) FROM {table}").fetchone()[0]
    if name in ORACLES:
        expected = sql.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]}) AS q").fetchall()
        assert actual == sorted(expected, key=repr)


def test_leaks_of_the_given_tables(spark, sql):
    """Each document that holds a benchmark text as it stands, and no other."""
    expected = sql.execute(
        "SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)"
    ).fetchall()
    found = QUERIES["op5_benchmark_decontamination"](spark, FOLDER)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == set(expected)


def test_stages_are_the_dealt_ones_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "substring dedup", "benchmark decontamination", "sentencepiece",
    ]


def test_pipeline_equals_brute_force(spark, sql):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = quality.graded(spark.read.parquet(f"{FOLDER}/labels.parquet"))
    good = quality.score(docs, quality.fit(docs, labels)).filter("p_top >= 0.5")
    rows = sorted((r["doc_id"], r["text"]) for r in good.select("row.doc_id", "row.text").collect())
    label = brute.reach(brute.links([t for _, t in rows]))
    rows = [row for k, row in enumerate(rows) if label[k] == k]
    cleaned = brute.kept([t for _, t in rows])
    rows = [(i, kept if gone else t) for (i, t), (_, gone, kept) in zip(rows, cleaned)]
    items = [r[0].split() for r in sql.execute("SELECT text FROM benchmark").fetchall()]
    marks = {tuple(w[k : k + 8]) for w in items for k in range(len(w) - 7)}
    clean = {
        i: t for i, t in rows
        if not any(tuple(w[k : k + 8]) in marks for w in [t.split()] for k in range(len(w) - 7))
    }
    result = corpus_pipeline.run(spark, FOLDER)
    assert result.columns == ["doc_id", "pieces", "n_pieces", "lossless"]
    found = {r["doc_id"]: r for r in result.collect()}
    assert found.keys() == clean.keys()
    assert all(r["lossless"] and r["n_pieces"] == len(r["pieces"]) for r in found.values())


def test_stages_keep_the_columns_of_documents_and_every_kind_of_row(spark, docs):
    base = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for df in (base, base.limit(0)):
            out = stage(spark, df, FOLDER)
            assert out.schema == base.schema, name
            kept = out.count()
            assert kept <= df.count() and (kept == 0) == (df.count() == 0)
    _, jaccard_stage = corpus_pipeline.STAGES[1]
    once = jaccard_stage(spark, base, FOLDER)
    assert once.groupBy("doc_id", "text").count().filter("count > 1 AND text <> ''").isEmpty()
    links = jaccard.jaccard_join(once).agg(F.sum("n_links")).first()[0]
    assert links == 0
