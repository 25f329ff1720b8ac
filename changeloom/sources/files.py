"""Files in: relational tables, and what the streaming outputs wrote."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from changeloom.entities import DATE_COLUMN, Entity
from changeloom.sources.filelog import FileLog
from changeloom.sources.filesystem import delete

__all__ = [
    "delete",
    "read_archive",
    "read_dead_letters",
    "read_key_values",
    "read_table",
    "stream_table",
]

DEAD_LETTER = StructType(
    [StructField("raw_value", StringType()), StructField("entity", StringType())]
)
OFFSET = StructField("off", LongType())
KEY_VALUE = StructType(
    [StructField("key", StringType()), StructField("value", StringType()), OFFSET]
)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream_table(
    spark: SparkSession, folder: str, name: str, max_files_per_trigger: int = 1000
) -> DataFrame:
    """The same table as a stream, whether it is stored as one file or as a folder.

    The file source wants a directory unless the path is a pattern. The number of
    files per batch is bounded, so that a backlog does not become one giant batch.
    """
    return (
        spark.readStream.schema(read_table(spark, folder, name).schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(f"{folder}/{{{name}.parquet}}")
    )


def read_archive(
    spark: SparkSession,
    path: str,
    entity: Entity,
    since: date | None = None,
    until: date | None = None,
) -> DataFrame:
    """Archived changes, every version: entity columns, ``off`` and ``date``.

    ``since`` (inclusive) and ``until`` (exclusive) bound the date. The archive's log names
    the files of those days, and only they are opened; a folder without a log is listed.
    Undated rows belong to no interval, so they are returned only together with the
    oldest, that is when ``since`` is not given.
    """
    schema = entity.schema.add(OFFSET).add(DATE_COLUMN, DateType())
    log = FileLog(spark, path)
    rows = log.read("archive", schema, _within("part", since, until)) if log.exists() else None
    if rows is None:
        rows = spark.read.schema(schema).parquet(path)
    wanted = _within(DATE_COLUMN, since, until)
    rows = rows if wanted is None else rows.filter(wanted)
    return rows.select(*entity.columns, OFFSET.name, DATE_COLUMN)


def _within(column: str, since: date | None, until: date | None) -> Column | None:
    if since is None and until is None:
        return None
    day = F.col(column).cast("date")
    late = F.lit(True) if since is None else day >= F.lit(since)
    early = F.lit(True) if until is None else day < F.lit(until)
    return (late & early) | day.isNull() if since is None else late & early


def _committed(spark: SparkSession, path: str, kind: str, schema: StructType, format: str) -> DataFrame:
    log = FileLog(spark, path)
    if log.exists():
        rows = log.read(kind, schema, format=format)
    else:
        rows = spark.read.schema(schema).format(format).load(path)
    return rows.select(*schema.fieldNames())


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """Dead letters of the committed batches; a folder without a log is read as a whole."""
    return _committed(spark, path, "dead_letter", DEAD_LETTER, "json")


def read_key_values(spark: SparkSession, path: str) -> DataFrame:
    """Records of the committed batches; a folder without a log is read as a whole."""
    return _committed(spark, path, "key_value", KEY_VALUE, "parquet")
