"""Tables that are kept up to date by streams: batches in every order against the batch form."""

import datetime
import glob
import json
from types import SimpleNamespace

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from changeloom.entities import STRING, INT, USERS, Entity
from changeloom.functions import change_order, with_date
from changeloom.operators import latest, retained_latest, serving_table, split, stamp_status, to_key_value
from changeloom.plans import feeds
from changeloom.plans.queries import QUERIES, _in_orders, served
from changeloom.plans.serving import star_revenue
from changeloom.sources import FileLog, clean_archive, merge_archive, read_archive, read_key_values
from changeloom.sources.filelog import State
from changeloom.sources.filesystem import below, put
from changeloom.sources.kafka import clean_records, position_headers
from changeloom.sources.layout import write_bucketed
from changeloom.streaming import (
    FileSink,
    ProgressListener,
    compact,
    compact_rollup,
    compact_serving,
    compact_status,
    drain,
    follow_records,
    progress_table,
    read_rollup,
    read_serving,
    read_status,
    read_upserts,
    start_archive,
    start_key_values,
    start_rollup,
    start_status,
    start_upserts,
    vacuum,
)
from changeloom.streaming.lifecycle import ONCE
from changeloom.streaming.tables import bucket
from tests.conftest import plan_of

ORDERS = Entity(
    name="orders",
    key="id",
    columns={"id": STRING, "kind": STRING, "n": INT, "last_modified_ts": STRING, "status": STRING},
    metrics=("n",),
    retention_days=3,
)
SCHEMA = "id STRING, kind STRING, n INT, last_modified_ts STRING, status STRING, off BIGINT"


def order():
    return change_order("last_modified_ts", "off")


class Changes:
    """Batches of changes that arrive in a folder, as a stream."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, str(path)

    def add(self, rows):
        df = self.spark.createDataFrame(rows, SCHEMA)
        df.coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return self.spark.readStream.schema(SCHEMA).parquet(self.path)

    def batch(self):
        return self.spark.read.schema(SCHEMA).parquet(self.path)


def at(day, time="00:00:00.000000"):
    return f"2024-01-{day:02d} {time}"


#: A newest change without a date hides an older dated one; times without sense are oldest.
TRICKY = [
    [("a", "x", 1, at(4, "10:00:00"), "I", 10), ("b", "x", 2, at(1), "I", 11), ("c", "x", 3, "zzz", "I", 12)],
    [("a", "y", 4, at(3), "I", 5), ("b", "y", 5, at(4), "I", 6), ("c", "y", 6, None, "I", 7)],
    [("a", "z", 7, at(1), "I", 1), ("b", "z", 8, at(2), "I", 2), ("d", "z", 9, at(1, "09:00:00"), "I", 3)],
]
AS_OF = datetime.date(2024, 1, 5)


@pytest.mark.parametrize("batches", [(0, 1, 2), (1, 2, 0)], ids=str)
def test_retention_in_compaction_lets_no_replaced_row_win(spark, rows, tmp_path, batches):
    changes, table = Changes(spark, tmp_path / "in"), str(tmp_path / "table")
    for k in batches:
        changes.add(TRICKY[k])
        drain([start_upserts(with_date(changes.stream()), ORDERS, order(), table, str(tmp_path / "c"), ONCE)])
        compact(spark, table, ORDERS, order(), AS_OF, buckets=2)
        vacuum(spark, table, ORDERS)
        expected = retained_latest(with_date(changes.batch()), ORDERS, order(), AS_OF)
        found = read_upserts(spark, table, ORDERS, order(), AS_OF)
        assert rows(found, "id", "kind") == rows(expected, "id", "kind")
    assert rows(found, "id") == [("b",)]
    with pytest.raises(ValueError, match="gone"):
        read_upserts(spark, table, ORDERS, order(), AS_OF - datetime.timedelta(days=1))


def test_a_compaction_writes_only_the_buckets_that_changed(spark, rows, tmp_path):
    changes, table = Changes(spark, tmp_path / "in"), str(tmp_path / "table")

    def fold():
        drain([start_upserts(with_date(changes.stream()), ORDERS, order(), table, str(tmp_path / "c"), ONCE)])
        return compact(spark, table, ORDERS, order(), buckets=16)

    changes.add([(f"k{i}", "x", i, at(1), "I", i) for i in range(400)])
    assert fold() == 1
    first = below(spark, f"{table}/snapshots")
    assert len(first) == 16
    changes.add([("k7", "new", 1, at(2), "U", 1000), ("k7", "old", 1, at(1), "U", 1)])
    assert fold() == 2
    written = set(below(spark, f"{table}/snapshots")) - set(first)
    number = spark.createDataFrame([("k7",)], "id STRING").select(bucket("id", 16)).first()[0]
    assert [f"/version=2/bucket={number}/" in name for name in written] == [True]
    assert fold() == 2 and set(below(spark, f"{table}/snapshots")) - set(first) == written
    log = FileLog(spark, table)
    live = {r.path for r in log.held(log.state()).filter("kind = 'snapshot'").collect()}
    assert len(live) == 16 and written < live
    one = read_upserts(spark, table, ORDERS, order(), keys=["k7"])
    assert rows(one, "id", "kind") == [("k7", "new")]
    assert len(one.inputFiles()) == 1
    expected = rows(latest(with_date(changes.batch()), "id", order()))
    columns = [*SCHEMA.replace(",", "").split()[::2], "date"]
    assert rows(read_upserts(spark, table, ORDERS, order()).select(*columns)) == expected
    vacuum(spark, table, ORDERS)
    assert set(below(spark, f"{table}/snapshots")) == live
    assert rows(read_upserts(spark, table, ORDERS, order()).select(*columns)) == expected


def test_reading_one_day_opens_that_days_files_only(spark, rows, tmp_path):
    changes, path = Changes(spark, tmp_path / "in"), str(tmp_path / "archive")
    for k in range(6):
        changes.add([(f"k{k}-{d}", "x", k, at(d) if d else "undated", "I", 10 * k + d) for d in range(4)])
        drain([start_archive(with_date(changes.stream()), ORDERS, path, str(tmp_path / "c"), ONCE)])
    root = f"{path}/orders"
    expected = rows(with_date(changes.batch()))
    columns = [*SCHEMA.replace(",", "").split()[::2], "date"]

    def all_rows():
        return rows(read_archive(spark, root, ORDERS).select(*columns))

    def day(d):
        return read_archive(spark, root, ORDERS, datetime.date(2024, 1, d), datetime.date(2024, 1, d + 1))

    assert all_rows() == expected
    assert len(day(2).inputFiles()) == 6 and all("date=2024-01-02" in f for f in day(2).inputFiles())
    before = read_archive(spark, root, ORDERS).select(*columns)
    assert merge_archive(spark, root, ORDERS, crowded=7) == 0
    assert merge_archive(spark, root, ORDERS, crowded=4) == 1
    # A reader that started before the merge, and one that starts after it.
    assert rows(before) == expected and all_rows() == expected
    assert len(day(2).inputFiles()) == 1
    changes.add([("more", "x", 1, at(2), "I", 99)])
    drain([start_archive(with_date(changes.stream()), ORDERS, path, str(tmp_path / "c"), ONCE)])
    clean_archive(spark, root)
    expected = rows(with_date(changes.batch()))
    assert all_rows() == expected
    assert len(below(spark, root)) == 5  # one a day and undated, and the new one
    assert merge_archive(spark, root, ORDERS, crowded=2) == 2
    clean_archive(spark, root)
    assert all_rows() == expected and len(day(2).inputFiles()) == 1


def test_ten_thousand_batches_in_the_log(spark, tmp_path):
    """One day is found among the files of 10,000 batches without opening a data folder."""
    log = FileLog(spark, str(tmp_path)).open()
    day = "CAST(date_add(DATE '2024-01-01', CAST(id % 1000 AS INT)) AS STRING)"
    path = f"concat('file:///x/run=r/batch_id=', id, '/date=', {day}, '/part-0')"
    batches = spark.range(10_000).selectExpr("'archive' AS kind", f"{day} AS part", f"{path} AS path")
    log.replace(State(1, {"r": 9_999}), batches)
    put(spark, log._entry("r", 9_999), json.dumps({"run": "r", "batch": 9_999, "kind": "archive", "part": "2024-02-01", "path": "file:///twice"}))
    put(spark, log._entry("r", 10_000), json.dumps({"run": "r", "batch": 10_000, "kind": "archive", "part": "2024-02-01", "path": "file:///x/new"}))
    found = log.paths("archive", F.col("part") == "2024-02-01")
    assert len(found) == 11 and all("date=2024-02-01" in p or p == "file:///x/new" for p in found)
    assert log.committed("r", 17) and log.committed("r", 10_000) and not log.committed("r", 10_001)


def test_the_serving_table_follows_records_batch_by_batch(spark, rows, tmp_path):
    changes, sink = Changes(spark, tmp_path / "in"), FileSink(str(tmp_path / "kv"))
    table = str(tmp_path / "table")
    batches = [TRICKY[2], TRICKY[0], [("b", "tie", 1, at(4), "I", 40), ("e", None, None, at(2), None, 41)]]
    for k, batch in enumerate(batches):
        changes.add(batch)
        drain([start_key_values(with_date(changes.stream()), ORDERS, sink, str(tmp_path / "c"), ONCE)])
        if k == 1:
            continue  # the second hop is down, and takes two batches the next time
        ends = (sink.root(ORDERS), ORDERS, table, str(tmp_path / "hop"), ONCE)
        drain([follow_records(spark, *ends)])
        drain([follow_records(spark, *ends)])
        records = read_key_values(spark, sink.root(ORDERS))
        assert rows(read_serving(spark, table, ORDERS)) == rows(serving_table(records, ORDERS, ["off"]))
        compact_serving(spark, table, ORDERS, 2)
        assert rows(read_serving(spark, table, ORDERS)) == rows(serving_table(records, ORDERS, ["off"]))
    assert rows(read_serving(spark, table, ORDERS, keys=["e"]), "kind", "n") == [("null", 0)]


HISTORY = [
    ("a", "1", 1, at(3), "I", 3), ("a", "2", 1, at(2), "I", 2), ("a", "2", 1, at(2), "I", 2),
    ("a", "3", 1, at(1), None, 1), ("b", "4", 1, None, "I", 4), ("b", "5", 1, "bad", "I", 5),
    ("b", "6", 1, at(1), "I", 6), ("c", "7", 1, at(9), "I", 7),
]


@pytest.mark.parametrize("parts", [(1, 2, 0)], ids=str)
def test_live_status_stamps_equal_the_batch_form(spark, rows, tmp_path, parts):
    changes, table = Changes(spark, tmp_path / "in"), str(tmp_path / "table")
    pieces = [HISTORY[:2], HISTORY[2:5], HISTORY[5:]]
    for number, k in enumerate(parts):
        changes.add(pieces[k])
        drain([start_status(changes.stream(), ORDERS, table, str(tmp_path / "c"), ONCE)])
        expected = rows(stamp_status(changes.batch(), "id", order()))
        assert rows(read_status(spark, table, ORDERS)) == expected
        if number != 1:
            compact_status(spark, table, ORDERS, 2)
            assert rows(read_status(spark, table, ORDERS)) == expected


@pytest.mark.parametrize("parts", [(1, 0, 2)], ids=str)
def test_live_rollups_equal_the_aggregate_of_latest_state(spark, rows, tmp_path, parts):
    changes, table = Changes(spark, tmp_path / "in"), str(tmp_path / "table")
    by, sums = {"kind": F.col("kind")}, {"n": F.col("n")}
    for number, k in enumerate(parts):
        changes.add(TRICKY[k])
        dated = with_date(changes.stream())
        drain([start_rollup(dated, ORDERS, order(), by, sums, table, str(tmp_path / "c"), ONCE)])
        state = latest(changes.batch(), "id", order())
        expected = state.groupBy("kind").agg(F.count("*").alias("rows"), F.sum("n").alias("n"))
        assert rows(read_rollup(spark, table, ["kind"], ["n"])) == rows(expected)
        if number:
            compact_rollup(spark, table, ORDERS, order(), ["kind"], ["n"], 2)
            assert rows(read_rollup(spark, table, ["kind"], ["n"])) == rows(expected)


def test_a_batch_counts_when_all_its_parts_do(spark, rows, tmp_path, monkeypatch):
    """A failure before the log entry shows nothing of the batch; the repeat shows it once."""
    changes, table = Changes(spark, tmp_path / "in"), str(tmp_path / "table")
    changes.add(HISTORY)
    commit = FileLog.commit
    monkeypatch.setattr(FileLog, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("down")))
    with pytest.raises(StreamingQueryException):
        drain([start_status(changes.stream(), ORDERS, table, str(tmp_path / "c"), ONCE)])
    assert below(spark, f"{table}/stamped") and not rows(read_status(spark, table, ORDERS))
    monkeypatch.setattr(FileLog, "commit", commit)
    drain([start_status(changes.stream(), ORDERS, table, str(tmp_path / "c"), ONCE)])
    assert rows(read_status(spark, table, ORDERS)) == rows(stamp_status(changes.batch(), "id", order()))


def test_one_to_one_tables_in_equal_buckets_join_without_an_exchange(spark, rows, tmp_path):
    facts = spark.range(500).selectExpr("concat('s', id) AS shipping_id", "id AS n")
    costs = spark.range(0, 500, 2).selectExpr("concat('s', id) AS shipping_id", "id * 2 AS cost")
    tables = [write_bucketed(df, str(tmp_path / name), "shipping_id", 4) for name, df in (("f", facts), ("c", costs))]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = tables[0].join(tables[1], "shipping_id", "left")
        plan = plan_of(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert rows(joined) == rows(facts.join(costs, "shipping_id", "left"))


def test_served_tables_follow_their_input(spark, tmp_path):
    import shutil

    for name in ("part", "lineitem", "orders", "customer", "nation"):
        shutil.copyfile(f"/root/testdata/sf0.001/{name}.parquet", tmp_path / f"{name}.parquet")
    folder = str(tmp_path)
    before = served(spark, folder, "products").count()
    part = spark.read.parquet(f"{folder}/part.parquet").filter("p_partkey > 50").toPandas()
    part.to_parquet(f"{folder}/part.parquet")
    assert served(spark, folder, "products").count() == part.p_partkey.nunique() < before


def test_clean_records_keep_the_position_of_their_change(spark, rows):
    df = spark.createDataFrame([("k", "v", 7, 100), ("k", "w", None, 101)], "key STRING, value STRING, off BIGINT, offset BIGINT")
    sent = df.withColumn("headers", F.when(F.col("off").isNotNull(), position_headers()))
    sent = sent.drop("off").withColumn("key", F.col("key").cast("binary")).withColumn("value", F.col("value").cast("binary"))
    assert rows(clean_records(sent)) == [("k", "v", 7), ("k", "w", 101)]


def report(k):
    progress = SimpleNamespace(json=json.dumps({"name": "many", "runId": "r", "batchId": k, "numInputRows": 1}))
    return SimpleNamespace(progress=progress)


def test_reports_share_files_and_none_is_lost(spark, tmp_path):
    path = str(tmp_path / "metrics")
    listener = ProgressListener(spark, path, waiting=64, pause=30)
    for k in range(1000):
        listener.onQueryProgress(report(k))  # waits while the queue is full
    listener.close()
    listener.close()
    table = progress_table(spark, path)
    assert table.select("batch_id").distinct().count() == table.count() == 1000
    assert len(glob.glob(f"{path}/*.json")) <= 60


def test_reports_outlive_a_store_that_is_down(spark, tmp_path, monkeypatch):
    import changeloom.streaming.progress as module

    path, put = str(tmp_path / "metrics"), module.put
    listener = ProgressListener(spark, path, pause=0.05)
    monkeypatch.setattr(module, "put", lambda *a: (_ for _ in ()).throw(OSError("down")))
    for k in range(5):
        listener.onQueryProgress(report(k))
    with pytest.raises(OSError):
        listener.flush()
    monkeypatch.setattr(module, "put", put)
    listener.close()
    assert progress_table(spark, path).count() == 5


def test_a_large_bucket_is_written_by_several_tasks(spark, rows, tmp_path):
    """The rows of one task follow a size, not the number of buckets."""
    changes, table = Changes(spark, tmp_path / "in"), str(tmp_path / "table")
    # A size of 4 kB; several tasks must hand over rows for that.
    sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    changes.add([(f"k{i}", f"x{i * i}", i, at(1), "I", i) for i in range(4000)])
    drain([start_upserts(with_date(changes.stream()), ORDERS, order(), table, str(tmp_path / "c"), ONCE)])
    for name, value in sizes.items():
        spark.conf.set(name, value)
    try:
        compact(spark, table, ORDERS, order(), buckets=1)
    finally:
        for name in sizes:
            spark.conf.unset(name)
    assert len(below(spark, f"{table}/snapshots")) > 1
    assert rows(read_upserts(spark, table, ORDERS, order()), "id") == rows(changes.batch(), "id")
    assert rows(read_upserts(spark, table, ORDERS, order(), keys=["k7"]), "kind") == [("x49",)]


def lines_and_orders(spark, folder, count=60):
    """Small tables of the transactions feed, some keys and positions null."""
    lines = spark.range(count).selectExpr(
        "id DIV 2 AS l_orderkey",
        "IF(id IN (7, 30), NULL, id % 23) AS l_partkey",
        "id % 5 AS l_suppkey",
        "CAST(id % 2 AS INT) AS l_linenumber",
        "CAST(id % 9 AS DOUBLE) AS l_quantity",
        "0.04D AS l_discount",
        "TIMESTAMP_NTZ '2001-11-03 00:00:00' AS l_shipdate",
    )
    orders = spark.range(count // 2).selectExpr(
        "id AS o_orderkey", "id % 4 AS o_custkey", "'1-URGENT' AS o_orderpriority"
    )
    lines.write.parquet(f"{folder}/lineitem.parquet")
    orders.write.parquet(f"{folder}/orders.parquet")
    return str(folder)


@pytest.mark.parametrize(
    "name",
    ["stream_upsert_transactions", "stream_upsert_undated", "stream_upsert_segments"],
)
def test_messages_that_arrive_in_parts_are_made_once(spark, tmp_path, monkeypatch, name):
    folder, made = lines_and_orders(spark, tmp_path), []
    raw = feeds.Feed.raw.fget
    monkeypatch.setattr(feeds.Feed, "raw", property(lambda feed: made.append(feed) or raw(feed)))
    assert QUERIES[name](spark, folder).count() > 0
    assert len(made) == 1


def test_parts_arrive_in_order_and_whole(spark, rows, tmp_path):
    feed = feeds.transactions(spark, lines_and_orders(spark, tmp_path))
    third = F.pmod(F.xxhash64("off"), F.lit(3)).alias("third")
    sent = rows(split(feed.raw, feed.entity, ["off"])[0].select(third, "transaction_id", "off"))
    numbered = [row for row in sent if row[2] is not None]
    expected = {
        "thirds": [[row for row in sent if row[0] == n] for n in (2, 0, 1)],
        "halves": [[row for row in numbered if row[2] % 2 == n] for n in (1, 0)],
    }
    assert all(sum(expected.values(), [])) and len(numbered) < len(sent)
    for name, run, batches in _in_orders(spark, feed, "parts_arrive"):
        for number, stream in enumerate(batches):
            taken = stream.select(third, "transaction_id", "off").writeStream.format("parquet")
            drain([taken.option("checkpointLocation", f"{run}/c").trigger(**ONCE).start(f"{run}/seen")])
            so_far = rows(spark.read.parquet(f"{run}/seen"))
            assert so_far == sorted(sum(expected[name][: number + 1], []), key=repr)
        assert number + 1 == len(expected[name])
