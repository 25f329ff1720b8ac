"""Aggregates over latest state, kept up to date with the changes.

A batch takes away what the rows that it replaces had added, and adds the new rows. Only
keys of the batch are looked up, in the buckets they fall into; the aggregate itself is the
sum of small tables of differences.

::

    <root>/changes, <root>/snapshots                  latest state, see ``tables``
    <root>/differences/run=<query id>/batch_id=<n>/   per combination: rows and sums, signed

One entry in the log makes state and differences count at once, so they always agree.
Counts and sums can be taken back, and averages follow from them. For a least or greatest
value, make the column one of ``by`` and take it over the combinations that are left.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeloom.entities import Entity
from changeloom.operators.upsert import latest
from changeloom.sources.filelog import FileLog, read_files
from changeloom.sources.filesystem import below
from changeloom.streaming.sinks import Trigger, batch_folder, start
from changeloom.streaming.tables import (
    BUCKETS,
    CHANGES,
    buckets_of,
    compact,
    stored_rows,
    table_schema,
    touched,
    write_changes,
)

DIFFERENCES, ROWS = "differences", "rows"


def _summed(differences: DataFrame, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    names = [ROWS, *sums]
    table = differences.groupBy(*by).agg(*(F.sum(n).alias(n) for n in names))
    return table.filter(" OR ".join(f"`{n}` <> 0" for n in names))


def start_rollup(
    dated: DataFrame,
    entity: Entity,
    order: Sequence[Column],
    by: Mapping[str, Column],
    sums: Mapping[str, Column],
    root: str,
    checkpoints: str,
    trigger: Trigger | None = None,
) -> StreamingQuery:
    """Keep rows and sums per combination of ``by`` over the newest row of each key.

    ``sums`` should be whole numbers or decimals: sums of floating-point numbers
    do not come back to zero when they are taken back.
    """
    name, schema, key = f"{entity.name}-rollup", table_schema(entity), entity.key

    def contribution(rows: DataFrame, sign: int) -> DataFrame:
        parts = [F.coalesce(value, F.lit(0)) * sign for value in sums.values()]
        return rows.select(
            *(column.alias(n) for n, column in by.items()),
            F.lit(sign).cast("bigint").alias(ROWS),
            *(part.cast("bigint").alias(n) for n, part in zip(sums, parts, strict=True)),
        )

    def publish(batch: DataFrame, run: str, batch_id: int) -> dict[str, str]:
        spark = batch.sparkSession
        newest = latest(batch.select(*schema.fieldNames()), key, order).persist(StorageLevel.MEMORY_AND_DISK)
        was = newest
        try:
            within = touched(newest, key, buckets_of(FileLog(spark, root).state()))
            stored = stored_rows(spark, root, schema, within, key)
            was = latest(stored.join(newest.select(key), key, "left_semi").select(*schema.fieldNames()), key, order)
            was = was.persist(StorageLevel.MEMORY_AND_DISK)
            now = latest(was.unionByName(newest), key, order)
            both = contribution(now, 1).unionByName(contribution(was, -1))
            folder = batch_folder(f"{root}/differences", run, batch_id)
            _summed(both, list(by), list(sums)).write.mode("overwrite").parquet(folder)
            return {DIFFERENCES: folder, CHANGES: write_changes(newest, root, run, batch_id)}
        finally:
            newest.unpersist()
            was.unpersist()

    log = FileLog(dated.sparkSession, root)
    return start(dated, publish, log, name, f"{checkpoints}/{name}", trigger)


def _read(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    # Every batch writes the same columns; their types are those of ``by`` and ``sums``.
    return read_files(spark, paths, spark.read.parquet(paths[0]).schema)


def read_rollup(spark: SparkSession, root: str, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """``by``, ``rows`` and ``sums`` over latest state as of the last committed batch."""
    paths = FileLog(spark, root).paths(DIFFERENCES)
    if not paths:
        raise ValueError("no batch has been committed")
    return _summed(_read(spark, paths), by, sums).filter(F.col(ROWS) > 0)


def compact_rollup(
    spark: SparkSession,
    root: str,
    entity: Entity,
    order: Sequence[Column],
    by: Sequence[str],
    sums: Sequence[str],
    buckets: int = BUCKETS,
) -> int:
    """Fold state as ``compact`` does, and all differences into one table."""

    def one(files: DataFrame, version: int) -> DataFrame:
        paths = sorted(r.path for r in files.filter(F.col("kind") == DIFFERENCES).select("path").collect())
        rest = files.filter(F.col("kind") != DIFFERENCES)
        if not paths:
            return rest
        folder = f"{root}/differences/version={version}"
        _summed(_read(spark, paths), by, sums).write.mode("overwrite").parquet(folder)
        new = [(DIFFERENCES, None, p) for p in below(spark, folder)]
        return rest.union(spark.createDataFrame(new, rest.schema))

    return compact(spark, root, entity, order, buckets=buckets, others=one)
