"""Rows that came too late, as a table: what a watermark drops leaves no other trace."""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

LATE = "query_id string, batch_id long, at string, watermark string, dropped long"


class LateRows(StreamingQueryListener):
    """Writes, for every micro-batch of every query that it listens to, how many rows its stateful operators dropped behind the
    watermark (rows as they reach the operator, so after the partial aggregation of an aggregate). `spark.streams.addListener`
    starts it; rows are handed to `path` in groups of `held` batches and when a query ends."""

    def __init__(self, spark: SparkSession, path: str, held: int = 100):
        self.spark, self.path, self.held = spark, path, held
        self.rows: list[tuple] = []
        self.lock = threading.Lock()
        self.ended: set[str] = set()
        self.change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        dropped = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        with self.lock:
            self.rows.append((str(progress.id), progress.batchId, progress.timestamp, progress.eventTime.get("watermark"), dropped))
            if len(self.rows) >= self.held:
                self._write()

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self._write()
        with self.change:
            self.ended.add(str(event.id))
            self.change.notify_all()

    def _write(self) -> None:
        if self.rows:
            self.spark.createDataFrame(self.rows, LATE).coalesce(1).write.mode("append").parquet(self.path)
            self.rows = []

    def wait(self, query_id: str, seconds: float = 60) -> bool:
        """Whether all batches of a query that has ended are written; events arrive a little after the query's end."""
        with self.change:
            return self.change.wait_for(lambda: query_id in self.ended, seconds)
