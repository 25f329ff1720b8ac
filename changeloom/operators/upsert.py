"""Newest-wins tables: one live row per key, replaced as a whole.

``order`` is the list of columns from ``change_order``. Latest state is
associative: the latest of (latest of A, latest of B) is the latest of A and B.
That is what lets each task cut its input down before the shuffle, and what lets
a stored table take in new changes without its history.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.entities import DATE_COLUMN, Entity


def latest(changes: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The newest row per key, for batch input.

    ``row_number() = 1`` compiles to a group limit on both sides of the exchange:
    each task sends at most one row per key, however many changes a key has.
    Unlike an aggregate over whole-row structs it also lets unused columns be
    pruned down to the scan.
    """
    newest_first = Window.partitionBy(key).orderBy(*(o.desc_nulls_last() for o in order))
    return (
        changes.withColumn("_rank", F.row_number().over(newest_first))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def latest_stream(changes: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The newest row per key, for streaming input (update or complete mode).

    The aggregate form of ``latest``: windows do not run on streams. Partial
    aggregation keeps at most one row per key and task here too.
    """
    newest = F.max_by(F.struct("*"), F.struct(*order)).alias("row")
    return changes.groupBy(key).agg(newest).select("row.*")


def fold(
    table: DataFrame, changes: DataFrame, key: str, order: Sequence[Column]
) -> DataFrame:
    """A latest-state table brought up to date with further changes, in any overlap."""
    return latest(table.unionByName(changes), key, order)


def retain(dated: DataFrame, as_of: date, days: int) -> DataFrame:
    """Rows dated within the last ``days`` days up to ``as_of``."""
    return dated.filter(F.col(DATE_COLUMN) > F.lit(as_of - timedelta(days=days)))


def retained_latest(
    dated: DataFrame, entity: Entity, order: Sequence[Column], as_of: date
) -> DataFrame:
    """``retain(latest(...))``, reading only what can survive it.

    A change dated before the window can only win its key if no newer one exists,
    and then the key is dropped anyway, so old dates are filtered ahead of the
    shuffle (on an archive: whole partitions are skipped). Undated changes must
    stay until the winner is known, since they may be the newest.
    """
    if entity.retention_days is None:
        return latest(dated, entity.key, order)
    cutoff = F.lit(as_of - timedelta(days=entity.retention_days))
    candidates = dated.filter((F.col(DATE_COLUMN) > cutoff) | F.col(DATE_COLUMN).isNull())
    return retain(latest(candidates, entity.key, order), as_of, entity.retention_days)
