from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.entities import DATE_COLUMN

# Fixed value: producers write modification times as text in this pattern.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def with_date(
    df: DataFrame, ts_col: str = "last_modified_ts", ts_format: str = TIMESTAMP_FORMAT
) -> DataFrame:
    """Add the calendar date of a text timestamp; NULL when it does not match.

    The ``try_`` form keeps one malformed value from failing the job under ANSI mode.
    """
    parsed = F.try_to_timestamp(F.col(ts_col), F.lit(ts_format))
    return df.withColumn(DATE_COLUMN, parsed.cast("date"))


def change_order(ts_col: str = "last_modified_ts", *ties: str) -> list[Column]:
    """Columns that put the changes of one key in order, oldest first.

    Compares the time the text stands for before the text itself, because text
    with and without a fraction does not sort by time. The parse is lenient
    (NULL sorts oldest), so a whole-second time that has no date still takes its
    place. ``ties`` settles equal times, e.g. by log offset.
    """
    return [
        F.col(ts_col).try_cast("timestamp_ntz"),
        F.col(ts_col),
        *(F.col(tie) for tie in ties),
    ]
