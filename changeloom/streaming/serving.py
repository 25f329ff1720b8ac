"""The second hop: clean records as a stream into the maintained serving table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from changeloom.entities import Entity
from changeloom.functions.time import change_order
from changeloom.operators.keyvalue import from_key_value
from changeloom.operators.serving import null_defaults
from changeloom.operators.upsert import latest
from changeloom.sources.filelog import FileLog, read_files
from changeloom.sources.files import KEY_VALUE, OFFSET
from changeloom.streaming.sinks import Trigger, start
from changeloom.streaming.tables import BUCKETS, CHANGES, compact, read_upserts, write_changes

#: Batches of records that one batch of the table takes in at most.
MOST_BATCHES = 64


def _schema(entity: Entity) -> StructType:
    return StructType([*entity.serving_schema, OFFSET])


def _order(entity: Entity):
    return change_order(entity.modified_at, OFFSET.name)


def _newest(records: DataFrame, entity: Entity) -> DataFrame:
    return latest(from_key_value(records, entity, [OFFSET.name]), entity.key, _order(entity))


def start_serving(
    records: DataFrame, entity: Entity, root: str, checkpoints: str, trigger: Trigger | None = None
) -> StreamingQuery:
    """Keep the table from a stream of (key, value, off), such as ``read_clean`` gives."""
    name = f"{entity.name}-serving"

    def publish(batch: DataFrame, run: str, batch_id: int) -> dict[str, str]:
        return {CHANGES: write_changes(_newest(batch, entity), root, run, batch_id)}

    log = FileLog(records.sparkSession, root)
    return start(records, publish, log, name, f"{checkpoints}/{name}", trigger)


def follow_records(
    spark: SparkSession,
    path: str,
    entity: Entity,
    root: str,
    checkpoints: str,
    trigger: Trigger | None = None,
    most: int = MOST_BATCHES,
) -> StreamingQuery:
    """Keep the table from the record files below ``path``, batch by committed batch.

    The stream reads the log of the records, not their folders, so that it never meets a
    batch that is still being written or is written again.
    """
    name = f"{entity.name}-serving"
    lines = FileLog(spark, path).stream(most).filter("kind = 'key_value'")

    def publish(batch: DataFrame, run: str, batch_id: int) -> dict[str, str]:
        paths = sorted(r.path for r in batch.select("path").distinct().collect())
        records = read_files(batch.sparkSession, paths, KEY_VALUE)
        return {CHANGES: write_changes(_newest(records, entity), root, run, batch_id)}

    return start(lines, publish, FileLog(spark, root), name, f"{checkpoints}/{name}", trigger)


def compact_serving(spark: SparkSession, root: str, entity: Entity, buckets: int = BUCKETS) -> int:
    return compact(spark, root, entity, _order(entity), buckets=buckets, schema=_schema(entity))


def read_serving(spark: SparkSession, root: str, entity: Entity, keys: Sequence[str] | None = None) -> DataFrame:
    """The table a reader sees, as ``serving_table`` gives it for the same records."""
    rows = read_upserts(spark, root, entity, _order(entity), keys=keys, schema=_schema(entity))
    return null_defaults(rows.select(*(F.col(f.name) for f in entity.serving_schema)), entity)
