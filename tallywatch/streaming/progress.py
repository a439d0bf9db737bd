"""What the batches of streaming queries report, kept as a table."""

from __future__ import annotations

import threading
import time
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = "query string, batch_id long, started_at string, metric string, value long"

INPUT_ROWS = "input_rows"
# Groups (window, source, place, type) of a batch that came after their window was closed.
LATE_GROUPS = "late_groups"
STATE_ROWS = "state_rows"


def metrics_of(progress: Any) -> dict[str, int]:
    """Rows read, groups dropped as late and rows kept as state where a query has state, and observed numbers as `name.column`."""
    found = {INPUT_ROWS: progress.numInputRows}
    if progress.stateOperators:
        found[LATE_GROUPS] = sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
        found[STATE_ROWS] = sum(s.numRowsTotal for s in progress.stateOperators)
    for name, row in progress.observedMetrics.items():
        found |= {f"{name}.{column}": n for column, n in row.asDict().items() if isinstance(n, int)}
    return found


class ProgressLog(StreamingQueryListener):
    """Writes the numbers of each batch to a table, while it is added to the session's listeners.

        log = ProgressLog(spark, folder)
        spark.streams.addListener(log)

    The table is partitioned by query and batch, and a batch that is repeated replaces its rows. Queries are told apart by
    name, those without one by their id. Spark calls listeners some time after the batch: `wait_for` returns when
    all batches of a query that has ended are in the table.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.names: dict[str, str] = {}
        self.ended: dict[str, threading.Event] = {}

    def _end_of(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event: Any) -> None:
        self._end_of(str(event.runId))

    def onQueryProgress(self, event: Any) -> None:
        progress = event.progress
        name = progress.name or str(progress.id)
        rows = [(name, progress.batchId, progress.timestamp, metric, n) for metric, n in metrics_of(progress).items()]
        table = self.spark.createDataFrame(rows, PROGRESS).coalesce(1)
        table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("query", "batch_id").parquet(self.path)

    def onQueryTerminated(self, event: Any) -> None:
        self._end_of(str(event.runId)).set()

    def close(self, seconds: float = 60) -> None:
        """Stop listening when the ends of all queries heard of have arrived, or the time is over."""
        until = time.monotonic() + seconds
        for ended in list(self.ended.values()):
            ended.wait(max(0.0, until - time.monotonic()))
        self.spark.streams.removeListener(self)

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Whether the end of the query, and with it all its batches, has been heard of."""
        return self._end_of(str(query.runId)).wait(seconds)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """All numbers reported so far as (query, batch_id, started_at, metric, value)."""
    return spark.read.schema(PROGRESS).parquet(path).withColumn("started_at", F.col("started_at").cast("timestamp"))
