import random
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changeloom.plans.serving import find, find_indexed, recent, recent_indexed
from changeloom.sources.fileindex import FileIndex
from changeloom.sources.filesystem import below, put

SCHEMA = "id STRING, user STRING, number INT, day DATE, at STRING, x DOUBLE"
FILES, EACH = 200, 50


def table(spark, path, files=FILES):
    """Files over disjoint times; users and numbers lie anywhere."""
    rng = random.Random(5)
    rows = [
        (
            f"t{i:06d}",
            None if i % 97 == 0 else f"u{rng.randrange(6000)}",
            rng.randrange(-5000, 5000),
            date(2024, 1, 1 + rng.randrange(28)),
            None if i % 101 == 0 else f"2024-01-01 00:{i // EACH:06d}.{i % EACH // 2:06d}",
            rng.random(),
        )
        for i in range(files * EACH)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    df.repartitionByRange(files, "id").write.parquet(str(path))
    return spark.read.schema(SCHEMA).parquet(str(path))


@pytest.fixture(scope="module")
def held(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("index table")
    path = root / "a+b %20c"
    df = table(spark, path)
    index = FileIndex(spark, str(root / "index"), df.schema, ["id", "user", "number"], ["day", "at"])
    index.add(str(path))
    return path, df.cache(), index


def spoil(path, keep):
    """Make every other file unreadable; what is left tells what a read opens."""
    for file in path.glob("part-*"):
        if not any(x.endswith(file.name) for x in keep):
            file.write_bytes(b"no table")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)


@pytest.mark.parametrize(
    "wanted",
    [
        {"id": "t004321"},
        {"user": "u17"},
        {"user": ["u1", "u2", "none"], "number": list(range(-100, 100))},
        {"number": 42},
        {"user": "u17", "day": date(2024, 1, 3)},
        {"id": "nobody"},
        {"user": None},
        {"user": []},
        {"number": "42"},
        {"number": 1 << 40},
        {"x": 0.5},
        {"id": "t004321", "user": "u1"},
    ],
    ids=str,
)
def test_find_equals_a_scan(held, rows, wanted):
    _, df, index = held
    assert rows(find_indexed(index, **wanted)) == rows(find(df, **wanted))


def test_a_lookup_opens_the_files_of_its_rows(held):
    _, df, index = held
    assert len(below(index.spark, str(held[0]))) == FILES
    opened = sum(len(index.candidates(user=f"u{k}")) for k in range(30))
    holding = df.filter(F.col("user").isin([f"u{k}" for k in range(30)]))
    useful = holding.groupBy("user", F.floor(F.substring("id", 2, 6).cast("int") / EACH)).count().count()
    assert opened <= useful * 1.3 + 8
    assert len(index.candidates(id="t004321")) <= 2


def test_other_files_are_not_opened(spark, tmp_path):
    df = table(spark, tmp_path / "table", 40)
    index = FileIndex(spark, str(tmp_path / "index"), df.schema, ["id"], ["at"])
    index.add(str(tmp_path / "table"))
    span = ("at", "2024-01-01 00:000003", "2024-01-01 00:000030", 60, "id")
    one, newest = find(df, id="t000777").collect(), recent(df, *span).collect()
    keep = [*index.candidates(id="t000777"), *index.newest(*span[:4])]
    assert len(keep) <= 6
    spoil(tmp_path / "table", keep)
    assert find_indexed(index, id="t000777").collect() == one
    assert recent_indexed(index, *span).collect() == newest


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(0, 220), st.integers(0, 220), st.integers(0, 400))
def test_recent_equals_a_scan(held, start, end, limit):
    _, df, index = held
    span = ("at", f"2024-01-01 00:{start:06d}.000007", f"2024-01-01 00:{end:06d}.000007", limit, "id")
    assert recent_indexed(index, *span).collect() == recent(df, *span).collect()


def test_recent_of_an_open_range_opens_the_newest_files(held):
    _, _, index = held
    assert len(index.newest("at", "0", "9", 100)) <= 4
    assert len(index.newest("at", "0", "9", FILES * EACH)) == FILES


def test_unsorted_files_are_all_read(spark, tmp_path, rows):
    """Where every file spans all times none can be left out."""
    df = table(spark, tmp_path / "sorted", 8)
    df.repartition(6, "user").write.parquet(str(tmp_path / "table"))
    index = FileIndex(spark, str(tmp_path / "index"), df.schema, [], ["at"])
    index.add(str(tmp_path / "table"))
    span = ("at", "0", "9", 30, "id")
    assert recent_indexed(index, *span).collect() == recent(df, *span).collect()


def test_later_files_get_an_entry_of_their_own(spark, tmp_path, rows):
    df = table(spark, tmp_path / "all", 12)
    early = F.col("id") < "t000300"
    df.filter(early).write.parquet(str(tmp_path / "a"))
    df.filter(~early).write.parquet(str(tmp_path / "b"))
    index = FileIndex(spark, str(tmp_path / "index"), df.schema, ["id", "user"], ["at"])
    assert find_indexed(index, id="t000001").count() == 0 and index.newest("at", "0", "9", 3) == []
    index.add(str(tmp_path / "a"))
    assert find_indexed(index, id="t000500").count() == 0
    index.add(below(spark, str(tmp_path / "b")))
    for wanted in ({"id": "t000500"}, {"user": ["u5", "u50", "u500"]}, {"id": "t000001"}):
        assert rows(find_indexed(index, **wanted)) == rows(find(df, **wanted))
    span = ("at", "0", "9", 70, "id")
    assert recent_indexed(index, *span).collect() == recent(df, *span).collect()


def test_words_lie_in_slots(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr("changeloom.sources.fileindex.SLOT", 30)
    df = table(spark, tmp_path / "table", 10)
    index = FileIndex(spark, str(tmp_path / "index"), df.schema, ["id", "number"])
    index.add(str(tmp_path / "table"))
    assert len(list((tmp_path / "index").glob("bits-*/column=id/slot=*"))) > 1
    for wanted in ({"id": "t000123"}, {"number": list(range(50))}, {"id": "t000123", "number": 3}):
        assert rows(find_indexed(index, **wanted)) == rows(find(df, **wanted))


def test_empty_tables_and_columns_of_nulls(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    empty.write.parquet(str(tmp_path / "empty"))
    index = FileIndex(spark, str(tmp_path / "i"), empty.schema, ["id"], ["at"])
    index.add(str(tmp_path / "empty"))
    assert find_indexed(index, id="a").count() == 0 and recent_indexed(index, "at", "0", "9", 5, "id").count() == 0
    nulls = spark.createDataFrame([(None,) * 6], SCHEMA)
    nulls.write.parquet(str(tmp_path / "nulls"))
    index.add(str(tmp_path / "nulls"))
    assert find_indexed(index, id="a").count() == 0 and recent_indexed(index, "at", "0", "9", 5, "id").count() == 0


def test_fractions_are_no_keys(spark):
    with pytest.raises(ValueError):
        FileIndex(spark, "/nowhere", spark.createDataFrame([], SCHEMA).schema, ["x"])


def test_a_value_makes_one_row_in_a_wide_filter(spark, tmp_path):
    """Building grows with the values, not with the bits set for them."""
    path = str(tmp_path / "table")
    spark.range(5000).selectExpr("'u' || id AS user").coalesce(1).write.parquet(path)
    spark.createDataFrame([("one",)], "user STRING").write.mode("append").parquet(path)
    index = FileIndex(spark, str(tmp_path / "index"), spark.read.parquet(path).schema, ["user"])
    index.add(path)
    words = spark.read.parquet(*map(str, (tmp_path / "index").glob("bits-*"))).groupBy("file").count()
    assert min(r["count"] for r in words.collect()) == 1
    assert len(index.candidates(user="one")) == 1 and len(index.candidates(user="u77")) == 1


def test_an_index_of_another_layout_is_refused(spark, tmp_path):
    put(spark, str(tmp_path / "entry-000000000.json"), '{"name": "x", "shape": {}}')
    with pytest.raises(ValueError, match="layout"):
        FileIndex(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema, ["id"]).candidates(id="a")
