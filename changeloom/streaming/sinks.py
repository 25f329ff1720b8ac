"""Streaming outputs: archive, key/value records and dead letters.

Each entity can be published by three independent queries (``start_*``), or by
``fan_out``, which reads and parses the source once for all three. Both write the
same layout, so that either can follow the other on the same targets::

    archive/<entity>/run=<query id>/batch_id=<n>/date=<day>/
    key values, dead letters: <root>/<entity>/run=<query id>/batch_id=<n>/

The query id lives in the checkpoint. A batch counts once it stands in the log, which
is written after all its outputs: readers see the whole batch or none of it. A batch
that is repeated after a failure replaces its own folders, or does nothing if it stands
in the log already; a query with a fresh checkpoint has another id and adds to what is
there. ``fan_out`` keeps one log for its three outputs, below the archive, to which the
others point; the ``start_*`` queries keep one below each output.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeloom.entities import DATE_COLUMN, Entity
from changeloom.functions.time import with_date
from changeloom.operators.envelope import DEAD, dead_letters, good_rows, route
from changeloom.operators.keyvalue import to_key_value
from changeloom.sources.filelog import FileLog
from changeloom.sources.kafka import Broker, position_headers, sink_options

Trigger = Mapping[str, object]
#: Writes a batch and returns the folders that it wrote, by kind.
Publish = Callable[[DataFrame, str, int], Mapping[str, str]]

#: The position in the log, which settles equal times.
POSITION = ("off",)

#: Rows of a column batch in which a fan-out holds its rows. Java's object streams keep a hundred
#: column batches in memory until they are reset, written or read, for each task.
HELD_ROWS = 500


def query_of(batch: DataFrame) -> str:
    """The id of the query that a ``foreachBatch`` batch belongs to."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise RuntimeError("not within a streaming batch")
    return found


def batch_folder(root: str, run: str, batch_id: int) -> str:
    return f"{root}/run={run}/batch_id={batch_id}"


@dataclass(frozen=True)
class KafkaSink:
    """Key/value records to the entity's clean topic. Delivers at least once."""

    broker: Broker

    def save(self, records: DataFrame, entity: Entity, run: str, batch_id: int) -> None:
        headers = [position_headers()] if "off" in records.columns else []
        pairs = records.select("key", "value", *headers).write.format("kafka")
        pairs.options(**sink_options(self.broker, entity)).save()

    def root(self, entity: Entity) -> None:
        """No files of its own."""


@dataclass(frozen=True)
class FileSink:
    """Key/value records, with their log position, as Parquet files below ``path``."""

    path: str

    def save(self, records: DataFrame, entity: Entity, run: str, batch_id: int) -> None:
        folder = batch_folder(self.root(entity), run, batch_id)
        records.write.mode("overwrite").parquet(folder)

    def root(self, entity: Entity) -> str:
        return f"{self.path}/{entity.name}"


def save_archive(dated: DataFrame, root: str, run: str, batch_id: int) -> str:
    """Rebalanced by date first: a quiet batch ends in few files instead of one per task,
    a backlog in a few per date, and a crowded date is split again by its size."""
    folder = batch_folder(root, run, batch_id)
    writer = dated.hint("rebalance", DATE_COLUMN).write.mode("overwrite")
    writer.partitionBy(DATE_COLUMN).parquet(folder)
    return folder


def save_dead_letters(dead: DataFrame, root: str, run: str, batch_id: int) -> str:
    folder = batch_folder(root, run, batch_id)
    dead.hint("rebalance").write.mode("overwrite").json(folder)
    return folder


def start(
    rows: DataFrame, publish: Publish, log: FileLog, name: str, checkpoint: str, trigger: Trigger | None
) -> StreamingQuery:
    """A query that hands every batch to ``publish`` with its query id and number, and then
    enters what that wrote in the log, all at once."""
    log.open()

    def take(batch: DataFrame, batch_id: int) -> None:
        run = query_of(batch)
        if not log.committed(run, batch_id):
            log.commit(run, batch_id, publish(batch, run, batch_id))

    writer = rows.writeStream.foreachBatch(take)
    writer = writer.queryName(name).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_archive(
    dated: DataFrame, entity: Entity, path: str, checkpoints: str, trigger: Trigger | None = None
) -> StreamingQuery:
    """Every good change as Parquet, one folder per date."""
    root, name = f"{path}/{entity.name}", f"{entity.name}-history"

    def publish(batch: DataFrame, run: str, batch_id: int) -> dict[str, str]:
        return {"archive": save_archive(batch, root, run, batch_id)}

    log = FileLog(dated.sparkSession, root)
    return start(dated, publish, log, name, f"{checkpoints}/{name}", trigger)


def start_key_values(
    dated: DataFrame,
    entity: Entity,
    sink: KafkaSink | FileSink,
    checkpoints: str,
    trigger: Trigger | None = None,
    carry: Sequence[str] = POSITION,
) -> StreamingQuery:
    """Every good change as a key/value record."""
    name = f"{entity.name}-records"
    checkpoint, root = f"{checkpoints}/{name}", sink.root(entity)

    def publish(batch: DataFrame, run: str, batch_id: int) -> dict[str, str]:
        sink.save(to_key_value(batch, entity.key, carry), entity, run, batch_id)
        return {"key_value": batch_folder(root, run, batch_id)} if root else {}

    # Records in a topic need no log to be found; it only tells which batches are done.
    log = FileLog(dated.sparkSession, root or f"{checkpoint}-log")
    return start(dated, publish, log, name, checkpoint, trigger)


def start_dead_letters(
    dead: DataFrame, entity: Entity, path: str, checkpoints: str, trigger: Trigger | None = None
) -> StreamingQuery:
    """Every dead letter as a JSON line."""
    root, name = f"{path}/{entity.name}", f"{entity.name}-rejects"

    def publish(batch: DataFrame, run: str, batch_id: int) -> dict[str, str]:
        return {"dead_letter": save_dead_letters(batch, root, run, batch_id)}

    log = FileLog(dead.sparkSession, root)
    return start(dead, publish, log, name, f"{checkpoints}/{name}", trigger)


@dataclass(frozen=True)
class FanOutTargets:
    archive: str
    dead_letters: str
    key_values: KafkaSink | FileSink
    checkpoints: str


def fan_out(
    raw: DataFrame,
    entity: Entity,
    targets: FanOutTargets,
    carry: Sequence[str] = POSITION,
    trigger: Trigger | None = None,
) -> StreamingQuery:
    """All three outputs of an entity from one query, a batch at once.

    Each batch is parsed once and held on the executors' disks while it is written
    three times; one entry in the log then makes all three count. Kafka may see records
    again after a failure, which a keyed newest-wins reader absorbs. Memory does not grow
    with the batch; bound it at the source for the disks' sake.
    """
    archive, letters = f"{targets.archive}/{entity.name}", f"{targets.dead_letters}/{entity.name}"
    records, name = targets.key_values.root(entity), f"{entity.name}-all"
    log = FileLog(raw.sparkSession, archive)
    for root in (letters, records) if records else (letters,):
        FileLog(raw.sparkSession, root).follow(archive)

    def publish(batch: DataFrame, run: str, batch_id: int) -> dict[str, str]:
        routed = route(batch, entity, carry).filter("after IS NOT NULL")
        # Held are the date, which two outputs need, and the text only where it stays text.
        text = F.when(F.col("route") == DEAD, F.col("after"))
        dated = with_date(routed, f"data.{entity.modified_at}").withColumn("after", text)
        # The session of a batch is its query's own.
        batch.sparkSession.conf.set("spark.sql.inMemoryColumnarStorage.batchSize", HELD_ROWS)
        held = dated.persist(StorageLevel.DISK_ONLY)
        try:
            good = good_rows(held, [*carry, DATE_COLUMN])
            folders = {"archive": save_archive(good, archive, run, batch_id)}
            targets.key_values.save(to_key_value(good, entity.key, carry), entity, run, batch_id)
            if records:
                folders["key_value"] = batch_folder(records, run, batch_id)
            dead = dead_letters(held, entity)
            return {**folders, "dead_letter": save_dead_letters(dead, letters, run, batch_id)}
        finally:
            held.unpersist()

    return start(raw, publish, log, name, f"{targets.checkpoints}/{name}", trigger)
