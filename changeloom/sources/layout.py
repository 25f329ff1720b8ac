"""Physical layout of stored tables: sorted files and bloom filters."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from changeloom.entities import Entity


def _with_bloom(writer: DataFrameWriter, entity: Entity, distinct_keys: int | None):
    for name in entity.bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        if distinct_keys is not None:
            writer = writer.option(
                f"parquet.bloom.filter.expected.ndv#{name}", str(distinct_keys)
            )
    return writer.option("parquet.bloom.filter.adaptive.enabled", "true")


def write_sorted(
    rows: DataFrame,
    path: str,
    entity: Entity,
    distinct_keys: int | None = None,
    files: int | None = None,
) -> None:
    """Write with globally sorted files, so that a time range touches few of them.

    Range partitioning on the sort columns plus the key splits a crowded day, or
    one bulk load with a single timestamp, while every file still covers one narrow
    range of min/max statistics. ``files`` is how many the table should have: its
    size over the wanted size of a file (``files_for``); without it, as many as the
    session has shuffle partitions. The ranges are found by sampling ``rows``, which
    are read twice: pass a stored table.
    """
    order = [*entity.sorted_by, entity.key]
    by = [F.col(name) for name in order]
    laid_out = rows.repartitionByRange(files, *by) if files else rows.repartitionByRange(*by)
    laid_out = laid_out.sortWithinPartitions(*order)
    _with_bloom(laid_out.write.mode("overwrite"), entity, distinct_keys).parquet(path)


def files_for(table_bytes: int, file_bytes: int = 512 << 20) -> int:
    return max(1, -(-table_bytes // file_bytes))


def write_indexed(
    rows: DataFrame, path: str, entity: Entity, distinct_keys: int | None = None
) -> None:
    """Write as is, with bloom filters on the lookup columns and no shuffle.

    ``distinct_keys`` is the expected number per row group; without it the
    writer sizes the filters itself.
    """
    _with_bloom(rows.write.mode("overwrite"), entity, distinct_keys).parquet(path)


def write_bucketed(rows: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Write dealt out and sorted by ``key`` and return the stored table.

    Two tables written so, by equal keys and into equally many buckets, are joined on them
    without an exchange on either side. Choose ``buckets`` so that one is a good size for a file.
    """
    name = f"bucketed_{uuid.uuid4().hex}"
    # The same hash deals out rows and names buckets, so that each task writes one of them.
    dealt = rows.repartition(buckets, key)
    writer = dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    writer.option("path", path).saveAsTable(name)
    return rows.sparkSession.table(name)
