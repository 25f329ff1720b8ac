"""A maintained newest-wins table in segments by day, which retention drops whole.

::

    <root>/changes/run=<query id>/batch_id=<n>/      newest row per key of each batch (``start_upserts``)
    <root>/segments/version=<v>/segment_kind=rows/segment_day=<d>/segment_bucket=<b>/
    <root>/segments/version=<v>/segment_kind=gone/segment_day=<d>/segment_bucket=<b>/
    <root>/_log/                                     which files are the table

A row lies in the segment of its change's day, in the hash bucket of its key. A change that
replaces a row of any segment adds a row to its own segment and a mark (key and the version
that wrote the replaced row) beside the replaced one; no stored row is written again. Keys,
times and positions of the rows themselves say which segment holds a key: folding reads these
columns of the buckets that a batch touches. Marks go with the segment that they speak of.

``expire`` takes the segments that retention ends out of the log, and writes no row.
``clean_segments`` then deletes their folders. ``merge_segments`` rewrites a day's bucket that
has become many files, and applies its marks.

A row without a readable time has no day. Retention drops such rows, and they outrank no row
that has one: they are not kept. A row with a time but no date (see ``with_date``) takes its
place in the segment of its time, hides older rows of its key, and is not shown.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from changeloom.entities import DATE_COLUMN, Entity
from changeloom.operators.upsert import latest, retain, retained_latest
from changeloom.sources.filelog import FileLog, State, part_of, read_files
from changeloom.sources.filesystem import below, delete
from changeloom.streaming.tables import (
    BUCKETS,
    CHANGES,
    bucket,
    buckets_of,
    drop_folded,
    not_before,
    table_schema,
    touched,
)

ROWS, GONE = "rows", "gone"
KIND, DAY, BUCKET, FOLD = "segment_kind", "segment_day", "segment_bucket", "segment_fold"
#: Files of one day's bucket from which on they are merged.
CROWDED = 8


def _cutoff(entity: Entity, as_of: date) -> date:
    if entity.retention_days is None:
        raise ValueError(f"{entity.name} has no retention; keep it with compact")
    return as_of - timedelta(days=entity.retention_days)


def _noted(state: State) -> date | None:
    return date.fromisoformat(state.notes["as_of"]) if "as_of" in state.notes else None


def _day(entity: Entity) -> Column:
    """The segment of a row: its date, else the day of its time."""
    return F.coalesce(F.col(DATE_COLUMN), F.col(entity.modified_at).try_cast("timestamp_ntz").cast("date"))


def _paths(files: DataFrame, kind: str) -> list[str]:
    return sorted(r.path for r in files.filter(F.col("kind") == kind).select("path").collect())


def _within(files: DataFrame, buckets: Collection[int]) -> DataFrame:
    return files.filter(F.substring_index("part", "/", -1).isin([str(b) for b in buckets]))


def _unexpired(files: DataFrame, entity: Entity, as_of: date) -> DataFrame:
    return files.filter(F.substring_index("part", "/", 1).cast("date") > F.lit(_cutoff(entity, as_of)))


def _standing(spark: SparkSession, files: DataFrame, entity: Entity, schema: StructType) -> DataFrame:
    """The rows in the files of segments that no mark takes out: one per key."""
    fold = StructType().add(FOLD, IntegerType())
    rows = read_files(spark, _paths(files, ROWS), StructType([*schema, *fold]))
    gone = _paths(files, GONE)
    if not gone:
        return rows
    marks = read_files(spark, gone, StructType([schema[entity.key], *fold]))
    return rows.join(marks, [entity.key, FOLD], "left_anti").select(*rows.columns)


def _write(rows: DataFrame, root: str, version: int) -> list[tuple[str, str, str]]:
    """Store rows and marks, and list (kind, part, path) of their files."""
    folder = f"{root}/segments/version={version}"
    dealt = rows.repartition(KIND, DAY, BUCKET)
    dealt.write.mode("overwrite").partitionBy(KIND, DAY, BUCKET).parquet(folder)
    return [
        (part_of(p, KIND), f"{part_of(p, DAY)}/{part_of(p, BUCKET)}", p) for p in below(rows.sparkSession, folder)
    ]


def fold_segments(
    spark: SparkSession,
    root: str,
    entity: Entity,
    order: Sequence[Column],
    as_of: date | None = None,
    buckets: int = BUCKETS,
) -> int:
    """Deal the committed batches into segments, and return the version.

    Written are the batches' winning rows and a mark for each row that they replace, nothing
    else; without new batches, nothing at all. With ``as_of``, segments out of retention are
    dropped as ``expire`` does, and changes out of it are not taken. ``buckets`` counts for a
    new table. One process at a time may fold, merge or expire a table; streams may go on.
    """
    log, schema = FileLog(spark, root), table_schema(entity)
    state = log.state()
    not_before(state, as_of)
    fresh = log.fresh(state)
    bounds = {r.run: r.last for r in fresh.groupBy("run").agg(F.max("batch").alias("last")).collect()}
    if not bounds:
        return state.version if as_of is None else expire(spark, root, entity, as_of)
    n, version, as_of = buckets_of(state, buckets), state.version + 1, as_of or _noted(state)
    taken, held = read_files(spark, _paths(fresh, CHANGES), schema).withColumn(DAY, _day(entity)), log.held(state)
    taken = taken.filter(F.col(DAY).isNotNull())
    notes = {**state.notes, "buckets": str(n)}
    if as_of is not None:
        taken, held = taken.filter(F.col(DAY) > F.lit(_cutoff(entity, as_of))), _unexpired(held, entity, as_of)
        notes["as_of"] = as_of.isoformat()
    names = [f"segment_order{i}" for i in range(len(order))]
    orders = [o.alias(name) for o, name in zip(order, names, strict=True)]
    newest = latest(taken, entity.key, order).select("*", *orders)
    stored = _standing(spark, _within(held, touched(taken, entity.key, n)), entity, schema)
    places = stored.select(entity.key, FOLD, _day(entity).alias(DAY), *orders)
    places = places.join(newest.select(entity.key), entity.key, "left_semi")
    both = newest.withColumn(FOLD, F.lit(None).cast("int")).unionByName(places, allowMissingColumns=True)
    # Of equal changes the stored one stays.
    first = Window.partitionBy(entity.key).orderBy(
        *(F.col(name).desc_nulls_last() for name in names), F.col(FOLD).asc_nulls_last()
    )
    ranked = both.withColumn("segment_rank", F.row_number().over(first))
    new, wins = F.col(FOLD).isNull(), F.col("segment_rank") == 1
    settled = ranked.filter((new & wins) | (~new & ~wins)).select(
        *schema.fieldNames(),
        F.coalesce(F.col(FOLD), F.lit(version)).alias(FOLD),
        F.when(new, ROWS).otherwise(GONE).alias(KIND),
        DAY,
        bucket(entity.key, n).alias(BUCKET),
    )
    written = spark.createDataFrame(_write(settled, root, version), held.schema)
    covered = {**state.covered, **bounds}
    log.replace(State(version, covered, notes), held.union(written))
    return version


def expire(spark: SparkSession, root: str, entity: Entity, as_of: date) -> int:
    """Drop the segments that are out of retention as of a day, for good, and return the
    version. Only the list of files is written; ``as_of`` must not go back."""
    log = FileLog(spark, root)
    state = log.state()
    not_before(state, as_of)
    if as_of == _noted(state):
        return state.version
    kept = _unexpired(log.held(state), entity, as_of)
    version = state.version + 1
    log.replace(State(version, state.covered, {**state.notes, "as_of": as_of.isoformat()}), kept)
    return version


def merge_segments(spark: SparkSession, root: str, entity: Entity, crowded: int = CROWDED) -> int:
    """Rewrite each day's buckets of ``crowded`` files or more, without the rows that marks take
    out, and return the version. Without a crowded one nothing is written."""
    log = FileLog(spark, root)
    state = log.state()
    held, schema = log.held(state), table_schema(entity)
    crowds = held.groupBy("part").agg(F.count(F.lit(1)).alias("files")).filter(F.col("files") >= crowded)
    parts = crowds.select("part")
    sources = held.join(parts, "part", "left_semi").select("kind", "part", "path")
    if sources.isEmpty():
        return state.version
    rows = _standing(spark, sources, entity, schema).select(
        "*",
        F.lit(ROWS).alias(KIND),
        _day(entity).alias(DAY),
        bucket(entity.key, buckets_of(state)).alias(BUCKET),
    )
    version = state.version + 1
    written = spark.createDataFrame(_write(rows, root, version), held.schema)
    kept = held.join(parts, "part", "left_anti").select("kind", "part", "path")
    log.replace(State(version, state.covered, state.notes), kept.union(written))
    return version


def read_segments(
    spark: SparkSession,
    root: str,
    entity: Entity,
    order: Sequence[Column],
    as_of: date | None = None,
    keys: Collection[str] | None = None,
) -> DataFrame:
    """The table as of now: entity columns, ``off`` and ``date``, one row per key.

    ``as_of`` is by default what ``expire`` was last given; without either, all days and
    undated rows are shown. With ``keys``, only the files of their buckets are opened. Stored
    rows need no settling among themselves; batches not yet folded do.
    """
    log, schema = FileLog(spark, root), table_schema(entity)
    state = log.state()
    not_before(state, as_of)
    as_of = as_of or _noted(state)
    files = log.held(state)
    if as_of is not None:
        files = _unexpired(files, entity, as_of)
    if keys is not None:
        wanted = spark.createDataFrame([(k,) for k in keys], f"`{entity.key}` STRING")
        files = _within(files, touched(wanted, entity.key, buckets_of(state)))
    rows = _standing(spark, files, entity, schema).select(*schema.fieldNames())
    new = _paths(log.fresh(state), CHANGES)
    if new:
        late = read_files(spark, new, schema)
        rows = rows.unionByName(late.filter(_day(entity).isNotNull()))
    if keys is not None:
        rows = rows.filter(F.col(entity.key).isin(list(keys)))
    if as_of is None:
        return latest(rows, entity.key, order) if new else rows
    return retained_latest(rows, entity, order, as_of) if new else retain(rows, as_of, entity.retention_days)


def clean_segments(spark: SparkSession, root: str) -> None:
    """Delete folded batches and the folders of segments that are no longer in the log: a whole
    day at a time where nothing of it is. Readers that started before may fail and have to
    start again."""
    log = FileLog(spark, root)
    state = log.state()
    drop_folded(log, state)
    live = {p.rsplit("/", 1)[0] for kind in (ROWS, GONE) for p in _paths(log.held(state), kind)}
    days = {folder.rsplit("/", 1)[0] for folder in live}
    there = {p.rsplit("/", 1)[0] for p in below(spark, f"{root}/segments")}
    ready = {f for f in there - live if int(part_of(f"{f}/", "version")) <= state.version}
    ended = {folder.rsplit("/", 1)[0] for folder in ready} - days
    for folder in sorted(ended | {f for f in ready if f.rsplit("/", 1)[0] not in ended}):
        delete(spark, folder)
    log.forget(state)
