from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

logger = logging.getLogger("changeloom.streaming")

# Trigger settings for a run that takes in what is there and then ends.
ONCE = {"availableNow": True}


def await_all(spark: SparkSession) -> None:
    """Block until any query ends, and fail if it failed.

    The error leaves the process, so that a supervisor sees a non-zero exit and
    restarts it from the checkpoints.
    """
    try:
        spark.streams.awaitAnyTermination()
    except Exception:
        logger.exception("a streaming query failed")
        raise


def drain(queries: Iterable[StreamingQuery]) -> None:
    """Wait for queries started with the ``ONCE`` trigger."""
    for query in queries:
        query.awaitTermination()
