"""Tables in segments by day: against the batch form, and what folding and expiry write."""

import datetime
import glob
import os

import pytest
from pyspark.sql import functions as F

from changeloom.entities import USERS
from changeloom.functions import with_date
from changeloom.operators import latest, retained_latest
from changeloom.sources import FileLog
from changeloom.sources.filesystem import below
from changeloom.streaming import (
    clean_segments,
    drain,
    expire,
    fold_segments,
    merge_segments,
    read_segments,
    start_upserts,
)
from changeloom.streaming.lifecycle import ONCE
from tests.test_live import AS_OF, ORDERS, TRICKY, Changes, at, order

COLUMNS = ["id", "kind", "n", "last_modified_ts", "status", "off", "date"]
DAY = datetime.timedelta(days=1)


class Table:
    def __init__(self, spark, path):
        self.spark, self.root, self.path = spark, str(path / "table"), path
        self.changes = Changes(spark, path / "in")

    def arrive(self, rows):
        self.changes.add(rows)
        stream = with_date(self.changes.stream())
        drain([start_upserts(stream, ORDERS, order(), self.root, str(self.path / "c"), ONCE)])

    def fold(self, as_of=None):
        return fold_segments(self.spark, self.root, ORDERS, order(), as_of, buckets=4)

    def read(self, **options):
        return read_segments(self.spark, self.root, ORDERS, order(), **options)

    def whole(self):
        return with_date(self.changes.batch())

    def stored(self):
        return set(below(self.spark, f"{self.root}/segments"))


@pytest.fixture
def table(spark, tmp_path):
    return Table(spark, tmp_path)


@pytest.mark.parametrize("batches", [(0, 1, 2), (1, 2, 0), (2, 0, 1)], ids=str)
@pytest.mark.parametrize("folded", ["each", "some"])
def test_segments_equal_retained_latest_in_any_order(spark, rows, table, batches, folded):
    for place, k in enumerate(batches):
        table.arrive(TRICKY[k])
        if folded == "each" or place == 1:
            table.fold(AS_OF)
            clean_segments(spark, table.root)
        expected = retained_latest(table.whole(), ORDERS, order(), AS_OF)
        assert rows(table.read(as_of=AS_OF), "id", "kind") == rows(expected, "id", "kind")
    assert rows(table.read(as_of=AS_OF), "id") == [("b",)]
    with pytest.raises(ValueError, match="gone"):
        table.read(as_of=AS_OF - DAY)
    with pytest.raises(ValueError, match="gone"):
        table.fold(AS_OF - DAY)


def test_a_moving_window_over_random_histories(spark, rows, table):
    times = F.concat(F.lit("2024-01-0"), F.pmod(F.xxhash64("off"), F.lit(9)) + 1, F.lit(" 10:00:00"))
    history = spark.range(400).select(
        F.concat(F.lit("k"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(40))).alias("id"),
        F.col("id").cast("string").alias("kind"),
        F.col("id").cast("int").alias("n"),
        F.col("id").alias("off"),
    )
    fraction = F.when(F.col("n") % 5 == 0, "").otherwise(F.concat(F.lit("."), F.lpad(F.col("n") % 7, 6, "0")))
    history = history.withColumn("last_modified_ts", F.concat(times, fraction)).withColumn("status", F.lit("I"))
    lines = history.select("id", "kind", "n", "last_modified_ts", "status", "off").collect()
    for number in range(5):
        as_of = datetime.date(2024, 1, 6 + number)
        table.arrive(lines[number::5])
        assert table.fold(as_of) > 0
        if number % 2:
            merge_segments(spark, table.root, ORDERS, crowded=2)
            clean_segments(spark, table.root)
        expected = rows(retained_latest(table.whole(), ORDERS, order(), as_of).select(*COLUMNS))
        assert rows(table.read(as_of=as_of).select(*COLUMNS)) == expected
        assert rows(table.read().select(*COLUMNS)) == expected
        some = [key for key in ("k1", "k2", "k3") if any(key == row[0] for row in expected)]
        found = rows(table.read(keys=["k1", "k2", "k3", "none"]).select("id"))
        assert found == [(key,) for key in some]


def test_expiry_deletes_folders_and_writes_no_row(spark, rows, table):
    for day in (1, 2, 3, 4):
        table.arrive([(f"k{day}-{i}", "x", i, at(day), "I", 100 * day + i) for i in range(20)])
        table.fold()
    table.arrive([("k1-0", "moved", 1, at(4), "U", 999)])
    table.fold()
    before = {p: os.stat(p.removeprefix("file:")).st_mtime_ns for p in table.stored()}
    version = expire(spark, table.root, ORDERS, AS_OF)
    assert expire(spark, table.root, ORDERS, AS_OF) == version
    assert table.stored() == set(before)
    assert rows(table.read().select("id")) == sorted([("k1-0",), *((f"k{d}-{i}",) for d in (3, 4) for i in range(20))])
    clean_segments(spark, table.root)
    left = {p: os.stat(p.removeprefix("file:")).st_mtime_ns for p in table.stored()}
    assert left == {p: t for p, t in before.items() if "2024-01-03" in p or "2024-01-04" in p}
    folders = glob.glob(f"{table.root}/segments/*/*/segment_day=*")
    assert {f[-10:] for f in folders} == {"2024-01-03", "2024-01-04"}
    # A late change of a key whose row has expired is out of the window itself.
    table.arrive([("k2-1", "late", 1, at(2), "I", 1), ("k3-1", "late", 1, at(3), "I", 1)])
    assert rows(table.read().filter("kind = 'late'")) == []
    table.fold()
    assert rows(table.read().filter("kind = 'late'")) == []
    assert {p for p in table.stored() if p not in left} == set()


def test_an_update_across_segments_adds_one_row_and_one_mark(spark, rows, table):
    table.arrive([(f"k{i}", "x", i, at(1 + i % 3), "I", i) for i in range(60)])
    table.fold()
    first = table.stored()
    table.arrive([("k4", "new", 4, at(3), "U", 900), ("k5", "old", 5, at(1), "U", 901)])
    table.fold()
    added = sorted(table.stored() - first)
    assert [p.split("segment_kind=")[1][:27] for p in added] == ["gone/segment_day=2024-01-02", "rows/segment_day=2024-01-03"]
    assert first < table.stored()
    assert rows(table.read().select(*COLUMNS)) == rows(latest(table.whole(), "id", order()).select(*COLUMNS))
    assert table.fold() == 2 and table.stored() == first | set(added)
    one = table.read(keys=["k4"])
    assert rows(one, "id", "kind") == [("k4", "new")]
    assert len({p.split("segment_bucket=")[1][:1] for p in one.inputFiles()}) == 1
    # Repeated changes change nothing.
    table.arrive([("k4", "new", 4, at(3), "U", 900)])
    table.fold()
    assert table.stored() == first | set(added)


def test_merging_applies_marks_and_touches_crowded_parts_only(spark, rows, table):
    for number in range(3):
        table.arrive([(f"k{i}", str(number), i, at(2, f"0{number}:00:00.000000"), "U", 10 * number + i) for i in (1, 2)])
        table.fold()
    table.arrive([("quiet", "x", 0, at(4), "I", 99)])
    version = table.fold()
    quiet = {p for p in table.stored() if "2024-01-04" in p}
    expected = rows(table.read().select(*COLUMNS))
    assert merge_segments(spark, table.root, ORDERS, crowded=50) == version
    assert merge_segments(spark, table.root, ORDERS, crowded=3) == version + 1
    clean_segments(spark, table.root)
    log = FileLog(spark, table.root)
    live = {(r.kind, r.part.split("/")[0]) for r in log.held(log.state()).collect()}
    assert live == {("rows", "2024-01-02"), ("rows", "2024-01-04")} and quiet < table.stored()
    assert rows(table.read().select(*COLUMNS)) == expected
    table.arrive([("k1", "newest", 1, at(4), "U", 500)])
    table.fold()
    assert rows(table.read(), "id", "kind") == [("k1", "newest"), ("k2", "2"), ("quiet", "x")]


def test_an_empty_table_and_one_without_retention(spark, rows, table, tmp_path):
    assert table.fold() == 0 and rows(table.read()) == []
    table.arrive([("a", "x", 1, None, "I", 1), ("b", "x", 1, "zzz", "I", 2)])
    assert table.fold() == 1 and rows(table.read()) == [] and table.stored() == set()
    with pytest.raises(ValueError, match="no retention"):
        expire(spark, str(tmp_path / "users"), USERS, AS_OF)
