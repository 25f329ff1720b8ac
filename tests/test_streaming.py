import datetime
import json
import os
from dataclasses import dataclass, replace

import pytest
from pyspark.errors import StreamingQueryException

from changeloom.entities import USERS
from changeloom.functions import change_order, with_date
from changeloom.operators import latest, serving_table, split
from changeloom.sources import (
    FileLog,
    read_archive,
    read_dead_letters,
    read_key_values,
)
from changeloom.sources.filesystem import below
from changeloom.streaming import sinks
from changeloom.streaming import (
    FanOutTargets,
    FileSink,
    await_all,
    compact,
    drain,
    fan_out,
    progress_table,
    read_upserts,
    recorded,
    start_archive,
    start_dead_letters,
    start_key_values,
    start_upserts,
    vacuum,
)
from changeloom.streaming.job import start_fan_outs, start_separate
from changeloom.streaming.lifecycle import ONCE

RAW = "value STRING, off BIGINT"
DAY = "2024-01-{:02d} 00:00:00.000000"


def image(key, job, ts):
    return json.dumps({"user_id": key, "job": job, "last_modified_ts": ts, "status": "INSERT"})


def message(after):
    return json.dumps({"payload": {"after": after}})


FIRST = [
    (message(image("a", "j1", DAY.format(1))), 1),
    (message(image("b", "j1", DAY.format(2))), 2),
    (message("{cut"), 3),
    (message(None), 4),
    (None, 5),
]
SECOND = [
    (message(image("a", "j2", DAY.format(3))), 6),
    (message(image("b", "late", DAY.format(1))), 7),
    (message(image("c", "j1", "undated")), 8),
    (message('{"job":"x"}'), 9),
]


class Inbox:
    """A folder of message files, read as a batch or one file per batch as a stream."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, path

    def add(self, messages):
        df = self.spark.createDataFrame(messages, RAW)
        df.coalesce(1).write.mode("append").parquet(self.path)

    def batch(self):
        return self.spark.read.schema(RAW).parquet(self.path)

    def stream(self):
        reader = self.spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1)
        return reader.parquet(self.path)


@pytest.fixture
def inbox(spark, tmp_path):
    box = Inbox(spark, str(tmp_path / "inbox"))
    box.add(FIRST)
    return box


@pytest.fixture
def targets(tmp_path):
    return FanOutTargets(
        *(str(tmp_path / name) for name in ("archive", "dlq")),
        FileSink(str(tmp_path / "kv")),
        str(tmp_path / "checkpoints"),
    )


def order():
    return change_order("last_modified_ts", "off")


def published(spark, targets):
    archived = read_archive(spark, f"{targets.archive}/users", USERS)
    records = read_key_values(spark, f"{targets.key_values.path}/users")
    return archived, records, read_dead_letters(spark, f"{targets.dead_letters}/users")


def check_outputs(spark, rows, inbox, targets):
    good, dead = split(inbox.batch(), USERS, ["off"])
    archived, records, dead_letters = published(spark, targets)
    assert rows(archived) == rows(with_date(good))
    assert rows(dead_letters) == rows(dead)
    assert sorted(row["key"] for row in records.collect()) == sorted(
        row["user_id"] for row in good.collect()
    )
    for row in records.collect():
        value = json.loads(row["value"])
        assert value["user_id"] == row["key"] and "off" not in value


@pytest.mark.parametrize("start", [start_fan_outs, start_separate])
def test_outputs_equal_the_batch_split_and_survive_a_restart(spark, rows, inbox, targets, start):
    for more in ([], SECOND, []):
        if more:
            inbox.add(more)
        drain(start(lambda entity: inbox.stream(), [USERS], targets, trigger=ONCE))
        check_outputs(spark, rows, inbox, targets)


def test_archive_keeps_undated_rows_and_bounds_by_date(spark, rows, inbox, targets):
    inbox.add(SECOND)
    good, _ = split(inbox.stream(), USERS, ["off"])
    drain([start_archive(with_date(good), USERS, targets.archive, targets.checkpoints, ONCE)])
    path = f"{targets.archive}/users"
    assert len(rows(read_archive(spark, path, USERS))) == 5
    until = datetime.date(2024, 1, 2)
    early = rows(read_archive(spark, path, USERS, until=until), "off")
    late = rows(read_archive(spark, path, USERS, since=until), "off")
    assert (early, late) == ([(1,), (7,), (8,)], [(2,), (6,)])
    folders = [folder for folder, _, _ in os.walk(path)]
    assert any("batch_id=" in name and name.endswith("date=2024-01-01") for name in folders)


def test_checkpoints_are_separate_per_output(inbox, targets):
    good, dead = split(inbox.stream(), USERS, ["off"])
    dated = with_date(good)
    queries = [
        start_archive(dated, USERS, targets.archive, targets.checkpoints, ONCE),
        start_key_values(dated, USERS, targets.key_values, targets.checkpoints, ONCE),
        start_dead_letters(dead, USERS, targets.dead_letters, targets.checkpoints, ONCE),
    ]
    drain(queries)
    names = [query.name for query in queries]
    assert len(set(names)) == 3 and sorted(os.listdir(targets.checkpoints)) == sorted(names)


def test_a_lost_checkpoint_loses_no_history(spark, rows, inbox, targets, tmp_path):
    drain([fan_out(inbox.stream(), USERS, targets, ["off"], ONCE)])
    late = Inbox(spark, str(tmp_path / "late"))
    late.add(SECOND)
    fresh = replace(targets, checkpoints=str(tmp_path / "fresh"))
    drain([fan_out(late.stream(), USERS, fresh, ["off"], ONCE)])
    inbox.add(SECOND)
    check_outputs(spark, rows, inbox, targets)


def test_modes_can_follow_each_other_on_the_same_targets(spark, rows, inbox, targets, tmp_path):
    drain(start_separate(lambda entity: inbox.stream(), [USERS], targets, trigger=ONCE))
    late = Inbox(spark, str(tmp_path / "late"))
    late.add(SECOND)
    drain(start_fan_outs(lambda entity: late.stream(), [USERS], targets, trigger=ONCE))
    inbox.add(SECOND)
    check_outputs(spark, rows, inbox, targets)


@dataclass(frozen=True)
class BrokenOnce(FileSink):
    """Fails after the archive of the batch has been written."""

    def save(self, records, entity, run, batch_id):
        marker = f"{self.path}-failed"
        if not os.path.exists(marker):
            open(marker, "w").close()
            raise RuntimeError("sink is down")
        super().save(records, entity, run, batch_id)


def test_a_batch_repeated_after_a_failure_adds_nothing(spark, rows, inbox, targets, tmp_path):
    inbox.add(SECOND)
    broken = FanOutTargets(
        targets.archive, targets.dead_letters, BrokenOnce(targets.key_values.path), targets.checkpoints
    )
    with pytest.raises(StreamingQueryException):
        drain([fan_out(inbox.stream(), USERS, broken, ["off"], ONCE)])
    # The archive of the batch is written, but the batch does not count.
    assert below(spark, f"{targets.archive}/users")
    assert not any(rows(output) for output in published(spark, targets))
    drain([fan_out(inbox.stream(), USERS, broken, ["off"], ONCE)])
    check_outputs(spark, rows, inbox, targets)


LATER = [(message(image("b", "j3", DAY.format(9))), 10)]


def test_a_maintained_table_ends_in_the_batch_state(spark, rows, inbox, tmp_path):
    table, checkpoints = str(tmp_path / "table"), str(tmp_path / "checkpoints")
    for number, more in enumerate(([], SECOND, LATER)):
        if more:
            inbox.add(more)
        good, _ = split(inbox.stream(), USERS, ["off"])
        drain([start_upserts(with_date(good), USERS, order(), table, checkpoints, ONCE)])
        expected = latest(with_date(split(inbox.batch(), USERS, ["off"])[0]), "user_id", order())

        def current(columns=tuple(expected.columns)):
            return rows(read_upserts(spark, table, USERS, order()).select(*columns))

        assert current() == rows(expected)
        assert compact(spark, table, USERS, order(), buckets=4) == number + 1
        assert current() == rows(expected)
        files = below(spark, table)
        assert compact(spark, table, USERS, order()) == number + 1 and below(spark, table) == files
        vacuum(spark, table, USERS)
        assert current() == rows(expected)
        assert rows(read_upserts(spark, table, USERS, order(), keys=["a", "zz"]), "user_id") == [("a",)]
    log = FileLog(spark, table)
    live = sorted(r.path for r in log.held(log.state()).collect())
    assert below(spark, f"{table}/snapshots") == live and not below(spark, f"{table}/changes")


def test_an_unfinished_snapshot_does_not_count(spark, rows, inbox, tmp_path):
    table = str(tmp_path / "table")
    good, _ = split(inbox.stream(), USERS, ["off"])
    drain([start_upserts(with_date(good), USERS, order(), table, str(tmp_path / "c"), ONCE)])
    before = rows(read_upserts(spark, table, USERS, order()))
    spark.range(3).write.parquet(f"{table}/snapshots/version=1")
    assert rows(read_upserts(spark, table, USERS, order())) == before
    compact(spark, table, USERS, order())
    assert rows(read_upserts(spark, table, USERS, order())) == before


def test_equal_times_are_settled_by_position_in_either_order(spark, inbox, tmp_path):
    pairs = [(message(image("x", job, DAY.format(5))), off) for job, off in (("old", 20), ("new", 21))]
    for name, batch in (("forward", pairs), ("backward", pairs[::-1])):
        box = Inbox(spark, str(tmp_path / name))
        box.add(batch)
        sink = FileSink(str(tmp_path / f"{name}-kv"))
        good, _ = split(box.stream(), USERS, ["off"])
        drain([start_key_values(with_date(good), USERS, sink, str(tmp_path / f"{name}-c"), ONCE)])
        records = read_key_values(spark, f"{sink.path}/users")
        assert serving_table(records, USERS, ["off"]).first()["job"] == "new"
    with pytest.raises(ValueError):
        serving_table(records, USERS, [])


def test_every_report_is_kept(spark, inbox, tmp_path):
    batches = 130
    folder = str(tmp_path / "many")
    rows_in = spark.range(batches).selectExpr("CAST(NULL AS STRING) AS value", "id AS off")
    rows_in.repartitionByRange(batches, "off").write.parquet(folder)
    reader = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1)
    with recorded(spark, str(tmp_path / "metrics")):
        writer = reader.parquet(folder).writeStream.queryName("many").foreachBatch(lambda df, k: None)
        writer = writer.option("checkpointLocation", str(tmp_path / "checkpoint"))
        drain([writer.trigger(**ONCE).start()])
    table = progress_table(spark, str(tmp_path / "metrics")).filter("query = 'many'")
    files = len([f for f in os.listdir(folder) if f.endswith(".parquet")])
    assert table.filter("batch_id IS NOT NULL").count() >= files
    assert table.select("batch_id").distinct().count() >= files
    first = table.orderBy("batch_id").first()
    assert first.watermark is None and first.batch_duration_ms > 0 and first.started_at


def test_a_failed_query_fails_the_job(spark, inbox, tmp_path):
    def fail(batch, batch_id):
        raise RuntimeError("broken output")

    spark.streams.resetTerminated()
    writer = inbox.stream().writeStream.foreachBatch(fail).trigger(**ONCE)
    writer.option("checkpointLocation", str(tmp_path / "checkpoint")).start()
    with pytest.raises(StreamingQueryException, match="broken output"):
        await_all(spark)
    spark.streams.resetTerminated()


def test_missing_reports_are_an_error(tmp_path):
    from types import SimpleNamespace

    kept = []
    streams = SimpleNamespace(active=[], addListener=kept.append, removeListener=kept.remove)
    with pytest.raises(TimeoutError, match="lost"):
        with recorded(SimpleNamespace(streams=streams), str(tmp_path), patience=0.2):
            kept[0].running.add("lost")
    assert not kept
    with recorded(SimpleNamespace(streams=streams), str(tmp_path), patience=0.2):
        pass


def test_fan_out_holds_text_of_dead_letters_only_and_parses_dates_once(spark, inbox, targets, monkeypatch):
    held, persist = [], type(inbox.stream()).persist

    def keep(df, *level):
        good = df.filter("route = 'good'")
        held.append((df.columns, good.count(), good.filter("after IS NOT NULL").count()))
        return persist(df, *level)

    monkeypatch.setattr(type(inbox.stream()), "persist", keep)
    drain([fan_out(inbox.stream(), USERS, targets, ["off"], ONCE)])
    [(columns, good, texts)] = held
    assert "date" in columns and good == 2 and texts == 0
    assert [r.raw_value for r in read_dead_letters(spark, f"{targets.dead_letters}/users").collect()] == ["{cut"]


def test_fan_out_holds_a_batch_on_disk_in_small_parts(spark, inbox, targets, monkeypatch):
    """Stored in memory, a large batch fills the heap; Java's streams hold a hundred parts of each task."""
    size, held, save = "spark.sql.inMemoryColumnarStorage.batchSize", [], sinks.save_dead_letters
    before = spark.conf.get(size, None)
    stored = spark.sparkContext._jsc.sc().getRDDStorageInfo
    others = {i.id() for i in stored()}

    def keep(dead, *ends):
        kept = [(i.memSize(), i.diskSize() > 0) for i in stored() if i.id() not in others]
        held.append((kept, int(dead.sparkSession.conf.get(size))))
        return save(dead, *ends)

    monkeypatch.setattr(sinks, "save_dead_letters", keep)
    drain([fan_out(inbox.stream(), USERS, targets, ["off"], ONCE)])
    assert held == [([(0, True)], sinks.HELD_ROWS)] and sinks.HELD_ROWS <= 1000
    assert spark.conf.get(size, None) == before
