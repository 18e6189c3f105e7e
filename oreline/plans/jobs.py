"""The three jobs: stream -> bronze, bronze -> silver, silver -> gold."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from oreline.functions.dates import YYYYMMDD, as_date
from oreline.functions.envelope import stamp, to_bronze
from oreline.operators.changes import keyed_changes, read_changes, silver_changes
from oreline.plans.propagate import Inputs, affected_dates
from oreline.plans.removed import remember_removed, removed_schema, without_removed
from oreline.plans.report import booking_report, session_details
from oreline.sinks.catalog import ensure_table
from oreline.sinks.cursors import add_marks, read_marks
from oreline.sinks.tables import finish, repeated_hashes, replace_partitions, staged, upsert_table
from oreline.sources.batches import Folder, batch_folders, highest, last_commit, read_batches
from oreline.sources.batches import unseen as pick_unseen
from oreline.sources.streams import drop_redelivered, read_cdc_stream
from oreline.sources.tables import read_table, table_exists
from oreline.spec import (
    ENTITIES,
    REPORT_KEYS,
    REPORT_PARTITION,
    REPORT_STATUSES,
    VERSION,
    EntitySpec,
    Layout,
    TableSpec,
)
from oreline.streaming.bronze import append_bronze

logger = logging.getLogger("oreline.jobs")


def run_window(
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    today: dt.date | None = None,
) -> tuple[dt.date, dt.date]:
    """Inclusive date window of a run; yesterday to today (UTC) where not given."""
    today = today or dt.datetime.now(dt.timezone.utc).date()
    first = as_date(start) if start else today - dt.timedelta(days=1)
    last = as_date(end) if end else today
    if first > last:
        raise ValueError(f"window starts after it ends: {first} > {last}")
    return first, last


def ingest_bronze(
    spark: SparkSession,
    entity: EntitySpec,
    layout: Layout,
    trigger: str | None = None,
    source_fmt: str = "kafka",
    source_path: str | None = None,
    bootstrap_servers: str | None = None,
    files_per_trigger: int | None = None,
    on_batch: Callable[[int, int], None] | None = None,
    redelivery: str | None = None,
    rebalance: bool = True,
) -> StreamingQuery:
    """Start the stream that lands an entity's change events in its bronze log.

    ``redelivery`` (such as ``"1 hour"``) lands a record once that the source delivers again within that time.
    ``rebalance`` is that of ``append_bronze``: an initial snapshot, whose records are all of one time, needs none.
    """
    records = read_cdc_stream(spark, entity, source_fmt, source_path, bootstrap_servers, files_per_trigger)
    if redelivery:
        records = drop_redelivered(records, redelivery)
    return append_bronze(
        to_bronze(records, entity),
        layout.bronze_path(entity),
        layout.checkpoint_path(entity),
        trigger=trigger or entity.trigger,
        name=f"bronze_{entity.name}",
        fmt=layout.fmt,
        on_batch=on_batch,
        rebalance=rebalance,
    )


#: How long the key of a deleted row is remembered.
REMEMBERED = dt.timedelta(days=30)


def build_silver(
    spark: SparkSession,
    entity: EntitySpec,
    layout: Layout,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    deletes: str = "drop",
    guard: bool = False,
    register: bool = False,
    unseen: bool = False,
    remembered: dt.timedelta = REMEMBERED,
) -> int:
    """Merge the changes of a date window into an entity's silver table.

    Returns the number of keys merged. ``deletes="apply"`` removes keys whose
    newest event is a delete; ``guard=True`` keeps the event time as
    ``_version`` and never replaces a row by an older one. With both, the keys of
    removed rows are kept with their versions for the time ``remembered``, so that
    an older event does not bring them back.

    ``unseen=True`` takes, instead of a window, the batches of the log that no such
    run has merged before, whatever their event dates: late events need no run of
    their own. A late event may be older than the row it meets, which ``guard`` is for.
    """
    folders: list[Folder] = []
    if unseen:
        if start or end:
            raise ValueError("unseen batches have no window")
        if layout.fmt != "parquet":
            raise ValueError(f"batches are not kept apart in format {layout.fmt}")
        log, cursor = layout.bronze_path(entity), layout.cursor_path(entity.name)
        folders = pick_unseen(
            batch_folders(spark, log), read_marks(spark, cursor), last_commit(spark, layout.checkpoint_path(entity))
        )
        if not folders:
            return 0
        changes = read_batches(spark, log, entity, folders)
        span = f"{len(folders)} batch folders"
    else:
        start, end = run_window(start, end)
        bronze_schema = entity.bronze_schema if layout.fmt == "parquet" else None
        changes = read_changes(spark, layout.bronze_path(entity), start, end, bronze_schema, layout.fmt)
        span = f"{start} to {end}"
    merged = _merge_changes(spark, entity, layout, changes, deletes, guard, remembered)
    if unseen:
        add_marks(spark, cursor, highest(folders))
    logger.info("silver %s, %s: %d keys", entity.name, span, merged)
    if register:
        ensure_table(spark, layout.silver_table(entity))
    return merged


def _merge_changes(
    spark: SparkSession,
    entity: EntitySpec,
    layout: Layout,
    changes: DataFrame,
    deletes: str,
    guard: bool,
    remembered: dt.timedelta,
) -> int:
    schema = entity.silver_schema
    _create_first(spark, layout, layout.silver_table(entity))
    # A table that a guarded run has versioned stays versioned, or a later guard would let older rows in.
    versioned = guard or VERSION in _stored_columns(spark, layout, layout.silver_path(entity))
    if versioned:
        schema = T.StructType(
            [*schema.fields[:-1], T.StructField(VERSION, T.LongType()), schema.fields[-1]]
        )
    repeated = repeated_hashes(keyed_changes(changes, entity, deletes), [entity.key])
    newest = silver_changes(changes, entity, deletes, keep_version=versioned, repeated=repeated)
    source = stamp(newest, "_silver_updated_at")

    def merge(rows: DataFrame) -> int:
        return upsert_table(
            spark,
            layout.silver_path(entity),
            rows,
            [entity.key],
            schema=schema,
            not_null=[entity.key],
            on_duplicate="trust" if layout.fmt == "parquet" else "error",
            guard=VERSION if guard else None,
            delete_when=F.col("_op") == "d" if deletes == "apply" else None,
            parts=entity.parts,
            fmt=layout.fmt,
        )

    if not guard or layout.fmt != "parquet":
        return merge(source)
    with staged(source, "silver-changes") as rows:
        removed = layout.removed_path(entity)
        if deletes == "apply":
            # Remembered before they are removed: a job that is lost in between removes them when it runs again.
            remember_removed(spark, removed, entity, rows, remembered)
        return merge(without_removed(spark, removed, entity, rows))


def _stored_columns(spark: SparkSession, layout: Layout, path: str) -> list[str]:
    """Columns of a Parquet table as it is, in any of its folders; none if it is yet to be made."""
    if layout.fmt != "parquet" or not table_exists(spark, path):
        return []
    return read_table(spark, path, merge_schema=True).columns


def _create_first(spark: SparkSession, layout: Layout, table: TableSpec) -> None:
    """In a format with row-level operations a merge needs a table to merge into."""
    if layout.fmt != "parquet":
        ensure_table(spark, table)


def read_silver(spark: SparkSession, entity: EntitySpec, layout: Layout) -> DataFrame:
    schema = entity.silver_schema if layout.fmt == "parquet" else None
    return read_table(spark, layout.silver_path(entity), layout.fmt, schema)


def build_gold_report(
    spark: SparkSession,
    layout: Layout,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    date_filter: str = "pre_join",
    null_dates: str = "keep",
    on_duplicate: str = "error",
    null_safe: bool = False,
    date_encoding: str = YYYYMMDD,
    statuses=REPORT_STATUSES,
    register: bool = False,
) -> int:
    """Merge the report of a learn-date window into the gold table.

    Returns the number of report rows merged. A booking without a session in the
    window has a NULL date, which matches nothing: by default such rows are
    inserted again by every run. ``null_dates="drop"`` leaves them out,
    ``null_safe=True`` matches NULL with NULL.
    """
    start, end = run_window(start, end)
    if null_dates not in ("keep", "drop"):
        raise ValueError(f"unknown null_dates mode: {null_dates}")
    details = session_details(
        read_silver(spark, ENTITIES["class_regular_session"], layout),
        read_silver(spark, ENTITIES["study_program"], layout),
        start,
        end,
        date_encoding,
    )
    bookings = read_silver(spark, ENTITIES["class_regular_session_student"], layout)
    table = layout.report_table()
    _create_first(spark, layout, table)
    # A few days of sessions out of years: once they are written their size is a
    # fact, and if it is small the bookings are joined without being shuffled.
    with staged(details, "session-details") as sized:
        report = booking_report(bookings, sized, statuses, date_filter)
        if null_dates == "drop":
            report = report.filter(F.col(REPORT_PARTITION).isNotNull())
        merged = upsert_table(
            spark,
            table.path,
            stamp(report, "_gold_updated_at"),
            REPORT_KEYS,
            match_also=[REPORT_PARTITION],
            partition_by=REPORT_PARTITION,
            schema=table.schema,
            on_duplicate=on_duplicate,
            null_safe=null_safe,
            fmt=layout.fmt,
        )
    logger.info("gold report, %s to %s: %d rows", start, end, merged)
    if register:
        ensure_table(spark, table)
    return merged


#: Name of the report's marks among the cursors.
REPORT_CURSOR = "student_session_report"


def build_gold_changes(
    spark: SparkSession,
    layout: Layout,
    date_encoding: str = YYYYMMDD,
    statuses=REPORT_STATUSES,
    register: bool = False,
    adopt: bool = False,
) -> list[dt.date]:
    """Bring the gold table up to date with silver; returns the learn dates that were recomputed.

    Instead of a window, whatever silver merged since the last such run decides: the dates that its changes
    reach, old and new, are recomputed whole and replaced, so a session that was moved leaves no row on the
    date it had. Bookings without a session have no date and are left out; undated rows that
    ``build_gold_report`` wrote stay. The first run recomputes every date. A removed session is known if
    silver was merged with ``guard`` and ``deletes="apply"``; a removed booking is not, as
    the report does not carry its key: recompute its date with ``build_gold_report``, or merge deletes as a status.

    ``adopt=True`` recomputes nothing: it takes the gold table, as windowed runs left it, for up to date with silver,
    and later runs go on from there.
    """
    if layout.fmt != "parquet":
        raise ValueError(f"format {layout.fmt} replaces partitions by itself")
    session, booking, program = (
        ENTITIES[name] for name in ("class_regular_session", "class_regular_session_student", "study_program")
    )
    removed = layout.removed_path(session)
    inputs = Inputs(
        read_silver(spark, booking, layout),
        read_silver(spark, session, layout),
        read_silver(spark, program, layout),
        read_table(spark, removed, schema=removed_schema(session)) if table_exists(spark, removed) else None,
    )
    table, cursor = layout.report_table(), layout.cursor_path(REPORT_CURSOR)
    if adopt:
        add_marks(spark, cursor, inputs.newest())
        return []
    finish(spark, table.path)
    # Taken first: what is merged while this runs is above these marks and belongs to the next run.
    newest = inputs.newest()
    there = read_table(spark, table.path, schema=table.schema) if table_exists(spark, table.path) else None
    dates = affected_dates(inputs, there, read_marks(spark, cursor), date_encoding)
    if dates:
        details = session_details(inputs.sessions, inputs.programs, dates[0], dates[-1], date_encoding)
        with staged(details.filter(F.col(REPORT_PARTITION).isin(dates)), "session-details") as sized:
            report = stamp(booking_report(inputs.bookings, sized, statuses, "where"), "_gold_updated_at")
            replace_partitions(report, table.path, REPORT_PARTITION, [str(day) for day in dates])
    add_marks(spark, cursor, newest)
    logger.info("gold report: %d dates recomputed", len(dates))
    if register:
        ensure_table(spark, table)
    return dates
