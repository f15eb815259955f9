"""Progress of running streams as a table: a listener notes every batch, and the rows are appended when the streams end.

    with recorded(spark, path):
        load.stream_load(...)
    spark.read.parquet(path)

Spark calls a listener after the batch, so it takes no time from the stream. A row per batch is held, ``FLUSH`` at most.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = (
    "run_id string, query_name string, batch_id long, started_at string, n_input_rows long, duration_ms long, watermark string, "
    "n_state_rows long, state_bytes long")
FLUSH = 10_000
WAIT_SECONDS = 60


class ProgressLog(StreamingQueryListener):
    """Notes the progress of all streams of a session from ``add`` to ``remove``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.rows: list[tuple] = []
        self.running: set[str] = set()
        self.failed: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        self.running.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = p.stateOperators or []
        self.rows.append((
            str(p.runId), p.name, p.batchId, p.timestamp, p.numInputRows, p.batchDuration, (p.eventTime or {}).get("watermark"),
            sum(s.numRowsTotal for s in state), sum(s.memoryUsedBytes for s in state)))
        if len(self.rows) >= FLUSH:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failed[str(event.runId)] = event.exception
        self.running.discard(str(event.runId))

    def flush(self) -> None:
        rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def wait(self, seconds: float = WAIT_SECONDS) -> None:
        """Until the ends of all streams that began have been told; events come after the fact."""
        until = time.monotonic() + seconds
        while self.running and time.monotonic() < until:
            time.sleep(0.05)


@contextmanager
def recorded(spark: SparkSession, path: str) -> Iterator[ProgressLog]:
    """Records the streams that begin and end within the block."""
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        log.wait()
        spark.streams.removeListener(log)
        log.flush()


def batches(progress: DataFrame) -> DataFrame:
    """One row per batch that read rows: a batch is told again when a stream is asked for news in between."""
    told = progress.filter("n_input_rows > 0")
    return told.groupBy("run_id", "batch_id").agg(
        F.max("n_input_rows").alias("n_input_rows"), F.max("duration_ms").alias("duration_ms"), F.max("watermark").alias("watermark"),
        F.max("n_state_rows").alias("n_state_rows"))
