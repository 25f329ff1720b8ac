"""Keeping an archive in few files a day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from changeloom.entities import DATE_COLUMN, Entity
from changeloom.sources.filelog import FileLog, State, part_of, read_files
from changeloom.sources.files import OFFSET
from changeloom.sources.filesystem import below, delete, path_of

#: Files of a day from which on they are merged.
CROWDED = 8


def _days(files: DataFrame) -> DataFrame:
    return files.groupBy("part").agg(F.count(F.lit(1)).alias("files"))


def merge_archive(spark: SparkSession, path: str, entity: Entity, crowded: int = CROWDED) -> int:
    """Rewrite the days that lie in ``crowded`` files or more in few, and return the version.

    Only those days are read and written; one entry in the log then puts the new files in
    the place of the old, so that a reader sees either. The old files stay until
    ``clean_archive``. Without a crowded day nothing is written.
    """
    log = FileLog(spark, path)
    state = log.state()
    fresh, held = log.fresh(state), log.held(state)
    live = held.union(fresh.filter("kind <> 'batch'").select("kind", "part", "path"))
    history = live.filter("kind = 'archive'")
    crowds = _days(history).filter(F.col("files") >= crowded).select(F.col("part").alias("day"))
    merged = history.join(crowds, F.col("part").eqNullSafe(F.col("day")), "left_semi").select("path")
    sources = sorted(r.path for r in merged.collect())
    if not sources:
        return state.version
    version = state.version + 1
    folder = f"{path}/run=merged/batch_id={version}"
    schema = entity.schema.add(OFFSET).add(DATE_COLUMN, DateType())
    rows = read_files(spark, sources, schema, path).select(*schema.fieldNames())
    writer = rows.hint("rebalance", DATE_COLUMN).write.mode("overwrite")
    writer.partitionBy(DATE_COLUMN).parquet(folder)
    new = [("archive", part_of(p, DATE_COLUMN), p) for p in below(spark, folder)]
    files = live.join(merged.distinct(), "path", "left_anti").select("kind", "part", "path")
    files = files.union(spark.createDataFrame(new, files.schema))
    bounds = {r.run: r.last for r in fresh.groupBy("run").agg(F.max("batch").alias("last")).collect()}
    log.replace(State(version, {**state.covered, **bounds}, state.notes), files)
    return version


def clean_archive(spark: SparkSession, path: str) -> None:
    """Delete the files that merges have replaced, and older versions of the log. Readers that
    started before may fail and have to start again. Entries of covered batches stay, for
    streams that read them."""
    log = FileLog(spark, path)
    state = log.state()
    own = F.contains("path", F.lit(f"{path_of(spark, path)}/"))
    live = log.held(state).filter(own).select("path")
    stale = log.stale(state).filter("kind = 'archive'").select("path")
    for version in log.older(state):
        stale = stale.union(log.held(State(version)).filter("kind = 'archive'").select("path"))
    for row in stale.distinct().join(live, "path", "left_anti").toLocalIterator():
        delete(spark, row.path)
    log.forget_older(state)
