"""What streams have taken in, batch by batch, kept in a table."""

from __future__ import annotations

import logging
import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from oreline.sinks.tables import write_table
from oreline.sources.tables import read_table
from oreline.spec import struct

logger = logging.getLogger("oreline.progress")

PROGRESS = struct(
    "name string, id string, run_id string, batch bigint, input_rows bigint, reported_at timestamp, millis bigint"
)


class BatchProgress(StreamingQueryListener):
    """Appends a row for every batch that had input to the table at ``path``.

    A query's own ``recentProgress`` forgets all but its last hundred batches, and everything when it
    ends. Rows are written ``every`` so many batches, and when a query ends; listeners are told
    after the fact, so ``wait`` for the end of a query before its rows are read.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 100) -> None:
        self.spark, self.path, self.every = spark, path, every
        self._rows: list[tuple] = []
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def __enter__(self) -> BatchProgress:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)
        self.flush()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        told = event.progress
        if not told.numInputRows:
            return
        millis = told.durationMs.get("triggerExecution")
        row = (told.name, str(told.id), str(told.runId), told.batchId, told.numInputRows, told.timestamp, millis)
        with self._changed:
            self._rows.append(row)
            full = len(self._rows) >= self.every
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def flush(self) -> None:
        """Write what is held. If that fails, the rows are kept for the next time."""
        with self._changed:
            rows, self._rows = self._rows, []
        if not rows:
            return
        try:
            told = self.spark.createDataFrame(rows, "name string, id string, run_id string, batch long, input_rows long, at string, millis long")
            stamped = told.withColumn("reported_at", F.to_timestamp("at")).select(*PROGRESS.names)
            write_table(stamped.coalesce(1), self.path)
        except Exception:
            logger.exception("progress of %d batches is not written yet", len(rows))
            with self._changed:
                self._rows = rows + self._rows

    def wait(self, query: StreamingQuery, timeout: float = 60) -> bool:
        """Wait until the end of a query has been told, and its rows are written."""
        run = str(query.runId)
        with self._changed:
            return self._changed.wait_for(lambda: run in self._ended, timeout)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch. A batch that was replayed after a restart was reported by both runs: the later counts."""
    rows = read_table(spark, path, schema=PROGRESS)
    latest = Window.partitionBy("id", "batch").orderBy(F.desc("reported_at"), F.desc("run_id"))
    return rows.withColumn("_rank", F.row_number().over(latest)).filter("_rank = 1").drop("_rank")
