"""Micro-batch append into the bronze log."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from oreline.sinks.tables import write_table
from oreline.spec import BATCH, EVENT_DATE

logger = logging.getLogger("oreline.bronze")

AVAILABLE_NOW = "available_now"
ADAPTIVE = "spark.sql.adaptive.enabled"


@contextmanager
def _adaptive(spark: SparkSession, setting: str) -> Iterator[None]:
    """Writes of a batch under the caller's setting of adaptive execution.

    A stream with state runs in a session that has it off, as its stores need a fixed number of partitions. What is
    done with a batch's rows comes after those; without it the rebalancing would be left out, and each
    store would write a file of its own for every event date.
    """
    before = spark.conf.get(ADAPTIVE)
    spark.conf.set(ADAPTIVE, setting)
    try:
        yield
    finally:
        spark.conf.set(ADAPTIVE, before)


def append_bronze(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (EVENT_DATE,),
    trigger: str = "60 seconds",
    name: str | None = None,
    fmt: str = "parquet",
    rebalance: bool = True,
    on_batch: Callable[[int, int], None] | None = None,
) -> StreamingQuery:
    """Start appending a stream to the table at ``path``.

    A batch that is replayed after a crash replaces what its first attempt
    wrote: every batch owns the partitions labelled with the query's id (kept in
    the checkpoint, so a restart has the same one) and its batch number.
    ``trigger`` is a processing-time interval, or ``"available_now"`` to take in
    what is there and stop. ``rebalance`` shuffles each batch into well-sized
    files per partition; without it every task writes a file of its own, which is
    the cheaper way once a task's share of a batch fills a file. ``on_batch`` is
    told the number of each batch and its rows, after the write.
    """

    adaptive = df.sparkSession.conf.get(ADAPTIVE)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        with _adaptive(batch.sparkSession, adaptive):
            rows_written = write_rows(batch, batch_id)
        logger.info("batch %d: %d rows", batch_id, rows_written)
        if on_batch:
            on_batch(batch_id, rows_written)

    def write_rows(batch: DataFrame, batch_id: int) -> int:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        written = Observation()
        if fmt == "delta":
            (
                batch.observe(written, F.count(F.lit(1)).alias("rows"))
                .write.format("delta")
                .mode("append")
                .option("mergeSchema", "true")
                .option("txnAppId", run)
                .option("txnVersion", batch_id)
                .partitionBy(*partition_by)
                .save(path)
            )
        else:
            label = f"{run}-{batch_id:010d}"
            rows = batch.withColumn(BATCH, F.lit(label))
            if rebalance:
                rows = rows.hint("rebalance", *partition_by)
            # Counted in the writing stage: the batch is read from its source
            # once, and an empty one writes no file.
            rows = rows.observe(written, F.count(F.lit(1)).alias("rows"))
            write_table(rows, path, "overwrite_partitions", [*partition_by, BATCH], fmt)
        return written.get["rows"]

    writer = df.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if trigger == AVAILABLE_NOW:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def run_until_stopped(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Wait for a query; on an interrupt stop it after the batch in progress.

    Returns whether the query has ended. A failed query raises.
    """
    try:
        ended = query.awaitTermination(timeout)
        return True if ended is None else ended
    except KeyboardInterrupt:
        logger.info("interrupted, stopping %s", query.name or query.id)
        query.stop()
        return True
