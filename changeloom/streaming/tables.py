"""A maintained newest-wins table: batches of changes, folded into buckets by key.

::

    <root>/changes/run=<query id>/batch_id=<n>/       newest row per key of each batch
    <root>/snapshots/version=<v>/bucket=<b>/          what compaction v wrote, sorted by key
    <root>/_log/                                      which files are the table

No stream state is kept: newest-wins is associative, so each batch sends only its
own newest rows and readers settle the rest. ``compact`` keeps that short: it rewrites
the buckets that new batches touch and leaves all others where they are.

A row that retention drops must not let an older one win later. Such a late change is as
old or older, hence out of the window as well, unless the dropped row has a time but no date
and lies within the window. Compaction keeps those rows, and readers leave them out.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from changeloom.entities import DATE_COLUMN, Entity
from changeloom.operators.upsert import latest, retained_latest
from changeloom.sources.filelog import FileLog, State, part_of, read_files
from changeloom.sources.files import OFFSET
from changeloom.sources.filesystem import below, delete
from changeloom.streaming.sinks import Trigger, batch_folder, start

#: Buckets of a new table; choose so many that one of them is a good size for a file.
BUCKETS = 64
CHANGES, SNAPSHOT = "changes", "snapshot"

#: ``latest`` or its like: one row per key from (rows, key, order).
Pick = Callable[[DataFrame, str, Sequence[Column]], DataFrame]


def bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def table_schema(entity: Entity) -> StructType:
    return StructType([*entity.schema, OFFSET, *entity.dated_schema.fields[len(entity.columns) :]])


def write_changes(newest: DataFrame, root: str, run: str, batch_id: int) -> str:
    """Rows for the next batch of a table; they count when the log has the folder."""
    folder = batch_folder(f"{root}/changes", run, batch_id)
    newest.write.mode("overwrite").parquet(folder)
    return folder


def start_upserts(
    dated: DataFrame,
    entity: Entity,
    order: Sequence[Column],
    root: str,
    checkpoints: str,
    trigger: Trigger | None = None,
) -> StreamingQuery:
    """Publish the newest row per key of every batch."""
    name = f"{entity.name}-table"

    def publish(batch: DataFrame, run: str, batch_id: int) -> dict[str, str]:
        return {CHANGES: write_changes(latest(batch, entity.key, order), root, run, batch_id)}

    log = FileLog(dated.sparkSession, root)
    return start(dated, publish, log, name, f"{checkpoints}/{name}", trigger)


def buckets_of(state: State, otherwise: int = BUCKETS) -> int:
    """Of a table: as its first compaction set them."""
    return int(state.notes.get("buckets", otherwise))


def touched(rows: DataFrame, key: str, buckets: int) -> list[int]:
    """The buckets that rows fall into: at most as many numbers as there are buckets."""
    found = rows.select(bucket(key, buckets).alias("bucket")).distinct().collect()
    return sorted(r.bucket for r in found)


def not_before(state: State, as_of: date | None) -> None:
    gone = state.notes.get("as_of")
    if as_of is not None and gone is not None and as_of < date.fromisoformat(gone):
        raise ValueError(f"retention was applied as of {gone}; rows before are gone")


def stored_rows(
    spark: SparkSession, root: str, schema: StructType, within: Collection[int] | None = None, key: str | None = None
) -> DataFrame:
    """All rows that may decide: the snapshot's and those of batches not yet folded. With
    ``within``, only the files of those buckets are opened."""
    log = FileLog(spark, root)
    state = log.state()
    held = log.held(state).filter(F.col("kind") == SNAPSHOT)
    if within is not None:
        held = held.filter(F.col("part").isin([str(b) for b in within]))
    fresh = log.fresh(state).filter(F.col("kind") == CHANGES)
    parts = [read_files(spark, sorted(r.path for r in f.select("path").collect()), schema) for f in (held, fresh)]
    rows = parts[0].unionByName(parts[1])
    if within is not None and key is not None:
        rows = rows.filter(bucket(key, buckets_of(state)).isin(list(within)))
    return rows


def read_upserts(
    spark: SparkSession,
    root: str,
    entity: Entity,
    order: Sequence[Column],
    as_of: date | None = None,
    keys: Collection[str] | None = None,
    schema: StructType | None = None,
    pick: Pick = latest,
) -> DataFrame:
    """The table as of now: entity columns, ``off`` and ``date``, one row per key.

    With ``as_of``, rows past the entity's retention are left out. With ``keys``, only these
    are looked up, in the files of their buckets.
    """
    state, schema = FileLog(spark, root).state(), schema or table_schema(entity)
    not_before(state, as_of)
    if keys is None:
        rows = stored_rows(spark, root, schema)
    else:
        wanted = spark.createDataFrame([(k,) for k in keys], f"`{entity.key}` STRING")
        within = touched(wanted, entity.key, buckets_of(state))
        rows = stored_rows(spark, root, schema, within, entity.key).filter(F.col(entity.key).isin(list(keys)))
    if as_of is None:
        return pick(rows, entity.key, order)
    return retained_latest(rows, entity, order, as_of)


def _decisive(rows: DataFrame, entity: Entity, order: Sequence[Column], as_of: date) -> DataFrame:
    """The newest rows per key without those that can go for good (see above)."""
    if entity.retention_days is None:
        return latest(rows, entity.key, order)
    cutoff, day = F.lit(as_of - timedelta(days=entity.retention_days)), F.col(DATE_COLUMN)
    candidates = rows.filter((day > cutoff) | day.isNull())
    time = F.col(entity.modified_at).try_cast("timestamp_ntz").cast("date")
    newest = latest(candidates, entity.key, order)
    return newest.filter(F.coalesce(day, time) > cutoff)


#: What becomes of the files of other kinds in a compaction: (files, version) -> files.
Others = Callable[[DataFrame, int], DataFrame]


def compact(
    spark: SparkSession,
    root: str,
    entity: Entity,
    order: Sequence[Column],
    as_of: date | None = None,
    buckets: int = BUCKETS,
    schema: StructType | None = None,
    pick: Pick = latest,
    others: Others | None = None,
) -> int:
    """Fold the committed batches into the buckets that they touch, and return the version.

    Without new batches nothing is read or written. With ``as_of``, retention is applied to
    those buckets, for good; it must not go back. ``buckets`` counts for a new table. One
    process at a time may compact a table; streams may go on meanwhile.
    """
    log, schema = FileLog(spark, root), schema or table_schema(entity)
    state = log.state()
    not_before(state, as_of)
    fresh = log.fresh(state)
    bounds = {r.run: r.last for r in fresh.groupBy("run").agg(F.max("batch").alias("last")).collect()}
    if not bounds:
        return state.version
    n, version = buckets_of(state, buckets), state.version + 1
    covered = {**state.covered, **bounds}
    new = sorted(r.path for r in fresh.filter(F.col("kind") == CHANGES).select("path").collect())
    taken = read_files(spark, new, schema)
    hit = touched(taken, entity.key, n)
    held = log.held(state)
    old = held.filter((F.col("kind") == SNAPSHOT) & F.col("part").isin([str(b) for b in hit]))
    rows = read_files(spark, sorted(r.path for r in old.select("path").collect()), schema).unionByName(taken)
    table = pick(rows, entity.key, order) if as_of is None else _decisive(rows, entity, order, as_of)
    folder = f"{root}/snapshots/version={version}"
    table = table.withColumn("bucket", bucket(entity.key, n))
    # Rebalanced, so that a bucket of any size is written by as many tasks as its size asks for.
    dealt = table.hint("rebalance", "bucket").sortWithinPartitions("bucket", entity.key)
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(folder)
    written = [(SNAPSHOT, part_of(p, "bucket"), p) for p in below(spark, folder)]
    kept = held.join(old.select("path"), "path", "left_anti").select("kind", "part", "path")
    kinds = (CHANGES, "batch")
    more = fresh.filter(~F.col("kind").isin(*kinds)).select("kind", "part", "path")
    if others:
        snapshots = F.col("kind") == SNAPSHOT
        more = others(kept.filter(~snapshots).union(more), version)
        kept = kept.filter(snapshots)
    files = kept.union(more.select("kind", "part", "path")).union(spark.createDataFrame(written, kept.schema))
    notes = {**state.notes, "buckets": str(n)}
    if as_of is not None:
        notes["as_of"] = max(as_of.isoformat(), notes.get("as_of", ""))
    log.replace(State(version, covered, notes), files)
    return version


def drop_folded(log: FileLog, state: State) -> None:
    """Delete the batches that a version holds."""
    stale = log.stale(state).filter(F.col("kind") == CHANGES)
    for row in stale.select("run", "batch").distinct().toLocalIterator():
        delete(log.spark, batch_folder(f"{log.root}/changes", row.run, row.batch))


def vacuum(spark: SparkSession, root: str, entity: Entity) -> None:
    """Delete the batches that the newest version holds, and buckets that it has replaced.
    Readers that started before may fail and have to start again."""
    log = FileLog(spark, root)
    state = log.state()
    live = {r.path.rsplit("/", 1)[0] for r in log.held(state).filter(F.col("kind") == SNAPSHOT).select("path").collect()}
    drop_folded(log, state)
    there = {p.rsplit("/", 1)[0] for p in below(spark, f"{root}/snapshots")}
    for folder in sorted(there - live):
        if int(part_of(f"{folder}/", "version")) <= state.version:
            delete(spark, folder)
    log.forget(state)
