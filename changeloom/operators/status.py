from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: what readers of the tables expect.
STAMP = "UPDATED"


def stamp_status(
    changes: DataFrame, key: str, order: Sequence[Column], stamp: str = STAMP
) -> DataFrame:
    """Set ``status`` on every change of a key but its first.

    Numbering the versions in a window would bring the whole history of a key
    into one task. Instead the first moment per key is aggregated (partially
    before the shuffle) and joined back on key *and* moment, which spreads even
    a key that holds most of the rows. A first change delivered twice keeps its
    status both times. ``changes`` is read twice: pass a stored table.
    """
    moment = F.struct(*(column.alias(f"o{i}") for i, column in enumerate(order)))
    timed = changes.withColumn("_moment", moment)
    first = timed.groupBy(F.col(key).alias("_key")).agg(F.min("_moment").alias("_first"))
    is_first = (F.col(key) == F.col("_key")) & (F.col("_moment") == F.col("_first"))
    stamped = timed.join(first, is_first, "left").withColumn(
        "status", F.when(F.col("_key").isNull(), F.lit(stamp)).otherwise(F.col("status"))
    )
    return stamped.select(*changes.columns)
