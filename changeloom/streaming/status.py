"""Status stamps on live changes.

Every change but the first of its key is stamped, as in ``stamp_status``, but changes come
in batches and in any order. What is known of a key is the moment of its first change so
far, kept as a table of its own with oldest-wins rows. A batch stamps its changes against
that moment; if it brings an older one, the change that was first until now is revised.
Nothing is written twice: a revision is a key and a moment, which readers take into account.

::

    <root>/stamped/run=<query id>/batch_id=<n>/       the changes of a batch, stamped
    <root>/revised/run=<query id>/batch_id=<n>/       moments that are no longer first
    <root>/changes, <root>/snapshots                  first moments, see ``tables``

One entry in the log makes all parts of a batch count at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from changeloom.entities import Entity
from changeloom.functions.time import change_order
from changeloom.operators.status import STAMP
from changeloom.sources.filelog import FileLog
from changeloom.sources.files import OFFSET
from changeloom.streaming.sinks import Trigger, batch_folder, start
from changeloom.streaming.tables import (
    BUCKETS,
    CHANGES,
    buckets_of,
    compact,
    stored_rows,
    touched,
    write_changes,
)


def earliest(changes: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The oldest row per key: at most one row per key leaves a task."""
    oldest_first = Window.partitionBy(key).orderBy(*(o.asc_nulls_first() for o in order))
    ranked = changes.withColumn("_rank", F.row_number().over(oldest_first))
    return ranked.filter("_rank = 1").drop("_rank")


def _firsts(entity: Entity) -> Entity:
    return replace(entity.only(), retention_days=None)


def _moments(entity: Entity) -> StructType:
    return StructType([*_firsts(entity).schema, OFFSET])


def _order(entity: Entity) -> list[Column]:
    return change_order(entity.modified_at, OFFSET.name)


def _moment(entity: Entity) -> Column:
    return F.struct(*(column.alias(f"o{i}") for i, column in enumerate(_order(entity))))


def start_status(
    changes: DataFrame,
    entity: Entity,
    root: str,
    checkpoints: str,
    trigger: Trigger | None = None,
    stamp: str = STAMP,
) -> StreamingQuery:
    """Stamp a stream of good changes with ``off``; read them with ``read_status``."""
    spark, name, key = changes.sparkSession, f"{entity.name}-status", entity.key
    log, moments = FileLog(spark, root), _moments(entity)
    columns = moments.fieldNames()

    def publish(batch: DataFrame, run: str, batch_id: int) -> dict[str, str]:
        spark = batch.sparkSession
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        now = earliest(held.select(*columns), key, _order(entity)).persist(StorageLevel.MEMORY_AND_DISK)
        both = now
        try:
            state = FileLog(spark, root).state()
            within = touched(now, key, buckets_of(state))
            known = earliest(stored_rows(spark, root, moments, within, key), key, _order(entity))
            known = known.select(
                F.col(key).alias("_key"), _moment(entity).alias("_was"), *(F.col(c).alias(f"_{c}") for c in columns[1:])
            )
            both = now.withColumn("_now", _moment(entity)).join(known, F.col(key) == F.col("_key"), "left")
            both = both.persist(StorageLevel.MEMORY_AND_DISK)
            folders = {kind: batch_folder(f"{root}/{kind}", run, batch_id) for kind in ("stamped", "revised")}
            # Joined on key and moment, so that the changes of a crowded key stay spread.
            first = both.select(F.col(key).alias("_key"), F.least("_now", "_was").alias("_first"))
            is_first = (F.col(key) == F.col("_key")) & _moment(entity).eqNullSafe(F.col("_first"))
            stamped = held.join(first, is_first, "left").withColumn(
                "status", F.when(F.col("_key").isNull(), F.lit(stamp)).otherwise(F.col("status"))
            )
            stamped.select(*held.columns).write.mode("overwrite").parquet(folders["stamped"])
            older = both.filter(F.col("_was").isNull() | (F.col("_now") < F.col("_was")))
            revised = older.filter(F.col("_was").isNotNull())
            revised = revised.select(key, *(F.col(f"_{c}").alias(c) for c in columns[1:]))
            revised.write.mode("overwrite").parquet(folders["revised"])
            return {**folders, CHANGES: write_changes(older.select(*columns), root, run, batch_id)}
        finally:
            for frame in (held, now, both):
                frame.unpersist()

    return start(changes, publish, log, name, f"{checkpoints}/{name}", trigger)


def compact_status(spark: SparkSession, root: str, entity: Entity, buckets: int = BUCKETS) -> int:
    """Fold the first moments; stamped changes stay where they are."""
    return compact(
        spark, root, _firsts(entity), _order(entity), buckets=buckets, schema=_moments(entity), pick=earliest
    )


def read_status(spark: SparkSession, root: str, entity: Entity, stamp: str = STAMP) -> DataFrame:
    """All changes so far, entity columns and ``off``, each with its status."""
    log = FileLog(spark, root)
    changes = log.read("stamped", StructType([*entity.schema, OFFSET])).select(*entity.columns, OFFSET.name)
    revised = log.read("revised", _moments(entity)).select(*_moments(entity).fieldNames()).distinct()
    revised = revised.select(F.col(entity.key).alias("_key"), _moment(entity).alias("_was"))
    same = (F.col(entity.key) == F.col("_key")) & _moment(entity).eqNullSafe(F.col("_was"))
    status = F.when(F.col("_key").isNotNull(), F.lit(stamp)).otherwise(F.col("status"))
    return changes.join(revised, same, "left").withColumn("status", status).select(*changes.columns)
