"""Progress of streaming queries, kept as a table of the engine's own reports."""

from __future__ import annotations

import atexit
import logging
import queue
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from changeloom.sources.filesystem import put

logger = logging.getLogger("changeloom.streaming.progress")

#: The parts of a report that the table shows.
REPORT = (
    "name STRING, runId STRING, batchId BIGINT, timestamp STRING, numInputRows BIGINT, "
    "processedRowsPerSecond DOUBLE, durationMs STRUCT<triggerExecution: BIGINT>, "
    "eventTime STRUCT<watermark: STRING>"
)


#: Reports that wait to be written, and seconds after which those there are go into a file.
WAITING, PAUSE = 10_000, 10.0


class ProgressListener(StreamingQueryListener):
    """Logs every report and, given a ``path``, stores it there as a line of JSON.

    Reports go into a queue and from there, many at a time, into files: no Spark job, and
    no file for each. A full queue holds up the sender rather than lose a report. What waits
    is written at the latest ``pause`` seconds after it came, when a query ends, and on
    ``close``. A file that cannot be written is tried again, and ``close`` fails if it still cannot.
    """

    def __init__(
        self, spark: SparkSession, path: str | None = None, waiting: int = WAITING, pause: float = PAUSE
    ):
        self._spark, self._path, self._pause = spark, path, pause
        self._queue: queue.Queue[str] = queue.Queue(waiting)
        self._ended, self._wake = threading.Event(), threading.Event()
        self._writing = threading.Lock()
        self._lines: list[str] = []
        self.running: set[str] = set()
        self.heard = time.monotonic()
        if path:
            self._writer = threading.Thread(target=self._write_on, name="progress-reports", daemon=True)
            self._writer.start()
            atexit.register(self.close)

    def onQueryStarted(self, event):
        self.running.add(str(event.runId))
        logger.info("query %s started", event.name)

    def onQueryProgress(self, event):
        logger.info(event.progress.json)
        if self._path:
            self._queue.put(event.progress.json)
            if self._queue.qsize() * 2 > self._queue.maxsize:
                self._wake.set()
        self.heard = time.monotonic()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.exception:
            logger.error("run %s failed: %s", event.runId, event.exception)
        self.running.discard(str(event.runId))
        self._wake.set()
        self.heard = time.monotonic()

    def _write_on(self) -> None:
        while not self._ended.is_set():
            self._wake.wait(self._pause)
            self._wake.clear()
            try:
                self.flush()
            except Exception:  # the reports are still there for the next time
                logger.exception("reports could not be written")

    def flush(self) -> None:
        """Write what waits into one file."""
        with self._writing:
            while len(self._lines) < self._queue.maxsize and not self._queue.empty():
                self._lines.append(self._queue.get_nowait())
            if self._lines:
                name = f"{time.time_ns():020d}-{uuid.uuid4().hex}.json"
                put(self._spark, f"{self._path}/{name}", "".join(f"{x}\n" for x in self._lines))
                self._lines = []

    def close(self) -> None:
        """Write all that waits and stop; again does nothing."""
        self._ended.set()
        self._wake.set()
        if self._path:
            atexit.unregister(self.close)
            self._writer.join()
            while self._lines or not self._queue.empty():
                self.flush()


@contextmanager
def recorded(spark: SparkSession, path: str, patience: float = 60.0) -> Iterator[None]:
    """Keep the reports of all queries that run within the block.

    Reports arrive after the batches they tell of; the block ends when those of the
    queries that ended in it have arrived, and fails if none arrives for ``patience`` seconds
    while some are missing.
    """
    listener = ProgressListener(spark, path)
    spark.streams.addListener(listener)
    try:
        yield
        ended = time.monotonic()
        while missing := listener.running - {str(query.runId) for query in spark.streams.active}:
            if time.monotonic() - max(ended, listener.heard) > patience:
                raise TimeoutError(f"reports of runs {sorted(missing)} have not arrived")
            time.sleep(0.05)
    finally:
        spark.streams.removeListener(listener)
        listener.close()


def progress_table(spark: SparkSession, path: str) -> DataFrame:
    """One row per micro-batch: query, run, batch, input rows, rate, duration, watermark."""
    report = F.from_json("value", REPORT)
    lines = spark.read.schema("value STRING").text(path)
    return lines.select(report.alias("r")).select(
        F.col("r.name").alias("query"),
        F.col("r.runId").alias("run"),
        F.col("r.batchId").alias("batch_id"),
        F.col("r.timestamp").cast("timestamp").alias("started_at"),
        F.col("r.numInputRows").alias("input_rows"),
        F.col("r.processedRowsPerSecond").alias("rows_per_sec"),
        F.col("r.durationMs.triggerExecution").alias("batch_duration_ms"),
        F.col("r.eventTime.watermark").alias("watermark"),
    )
