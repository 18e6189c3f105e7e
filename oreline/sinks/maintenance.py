"""Small-file control for tables written by path."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from oreline import paths
from oreline.functions.dates import as_date
from oreline.operators.changes import read_changes
from oreline.sinks.cursors import read_marks
from oreline.sinks.tables import finish, staged, write_table
from oreline.sources.tables import (
    date_in_range,
    key_column,
    key_parts,
    partition_values,
    read_date_range,
    read_table,
)
from oreline.spec import BATCH, EVENT_DATE, EntitySpec
from oreline.sources.batches import COMPACTED, batch_folders, highest, split_label

RECORD_ID = ("_kafka_topic", "_kafka_partition", "_kafka_offset")


def compact(
    spark: SparkSession,
    path: str,
    partition_by: Sequence[str] = (),
    predicate: Column | None = None,
    schema: StructType | None = None,
    dates: tuple[str | dt.date, str | dt.date] | None = None,
) -> None:
    """Rewrite the partitions ``predicate`` selects into well-sized files.

    ``predicate`` may only use partition columns: whole partitions are replaced.
    AQE sizes the files: it merges small pieces and splits an oversized
    partition. A table dealt to folders by its key needs no ``partition_by``.

    ``dates`` limits the work to a range of the first partition column: only those
    folders are listed and opened. ``schema`` must name all columns; without it
    they come from the footers of what is read.
    """
    if not partition_by:
        if not (parts := key_parts(spark, path)):
            raise ValueError("only a partitioned table, or one dealt by its key, can be compacted in place")
        finish(spark, path)
        partition_by = [key_column(parts)]

    options = {"schema": schema, "merge_schema": schema is None, "text_partitions": True, "dealt_column": True}
    if dates is not None:
        df = read_date_range(spark, path, partition_by[0], *dates, **options)
    else:
        df = read_table(spark, path, **options)
    if predicate is not None:
        df = df.filter(predicate)
    with staged(df.hint("rebalance", *partition_by), "compact", partition_by, keep_on_error=True) as packed:
        write_table(packed, path, "overwrite_partitions", partition_by)


def compact_log(
    spark: SparkSession,
    path: str,
    entity: EntitySpec,
    start: str | dt.date,
    end: str | dt.date,
    cursor: str | None = None,
) -> int:
    """Fold the micro-batch folders of a range of event dates into one per date.

    Rows are identified by their stream position, so running again after an
    interruption (or over a batch that was folded twice) leaves one copy of each.
    The newest batch of each ingest stays as it is: a restarted stream replays
    at most that one. Between the publish and the clean-up a reader may see a
    row twice, never miss one; silver's newest-per-key step is immune to that.
    ``cursor`` is the table of a consumer's marks: once it has some, batches that it has
    yet to take keep their folders. Returns the number of folders folded.
    """
    start, end = as_date(start), as_date(end)
    days = [day for day in partition_values(spark, path, EVENT_DATE) if date_in_range(day, start, end)]
    folders = batch_folders(spark, path, days)
    marks = read_marks(spark, cursor) if cursor else {}
    # The last batch of each ingest that may be folded.
    last = {run: number - 1 for run, number in highest(folders).items() if run}
    if marks:
        last = {run: min(number, marks.get(run, -1)) for run, number in last.items()}

    def closed(batch: str) -> bool:
        label = split_label(batch)
        return label is not None and label[1] <= last[label[0]]

    old = [(day, batch) for day, batch in folders if closed(batch)]
    if not old:
        return 0

    batch = F.col(BATCH)
    selected = batch == COMPACTED
    for run, number in last.items():
        selected = selected | (batch.startswith(f"{run}-") & (batch <= f"{run}-{number:010d}"))
    rows = read_changes(spark, path, start, end, entity.bronze_schema).filter(selected)
    folded = rows.dropDuplicates(list(RECORD_ID)).withColumn(BATCH, F.lit(COMPACTED)).hint("rebalance", EVENT_DATE)
    with staged(folded, "compact-log", [EVENT_DATE, BATCH], keep_on_error=True) as packed:
        write_table(packed, path, "overwrite_partitions", [EVENT_DATE, BATCH])
    paths.side_by_side(lambda one: paths.delete(spark, f"{path}/{EVENT_DATE}={one[0]}/{BATCH}={one[1]}"), old)
    return len(old)
