"""Which dates of the report a change of its inputs reaches.

The report is a left join: a row stands on the date of its session. A changed session reaches the
date it has now and the one it had, which only the report itself still knows; so does one that was
removed. A changed booking reaches its session's date, and the dates on which its student stands in the
report, since it may have been moved or have lost its status. A changed program reaches the dates of its
sessions. Recomputing these dates, whole, leaves no row behind.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.functions.dates import YYYYMMDD, int_date
from oreline.spec import REPORT_PARTITION

UPDATED = "_silver_updated_at"


@dataclass(frozen=True)
class Inputs:
    """The silver tables of the report, each with the time of its rows' last merge, and the keys of
    sessions that were removed, with the time of that; None where none are remembered."""

    bookings: DataFrame
    sessions: DataFrame
    programs: DataFrame
    removed_sessions: DataFrame | None = None

    def newest(self) -> dict[str, int]:
        """Microseconds of each table's last merge: the marks up to which a run sees everything."""
        times = {"bookings": self.bookings, "sessions": self.sessions, "programs": self.programs}
        times = {name: df.select(F.max(UPDATED).alias("t")) for name, df in times.items()}
        if self.removed_sessions is not None:
            times["removed"] = self.removed_sessions.select(F.max("_removed_at").alias("t"))
        found = {name: df.select(F.unix_micros("t")).first()[0] for name, df in times.items()}
        return {name: mark for name, mark in found.items() if mark is not None}


def _since(df: DataFrame, mark: int | None, column: str = UPDATED) -> DataFrame:
    """Rows merged after a mark. The comparison is one of plain timestamps, so row groups of older rows are skipped."""
    return df if mark is None else df.filter(F.col(column) > F.timestamp_micros(F.lit(mark)))


def affected_dates(
    inputs: Inputs, report: DataFrame | None, marks: Mapping[str, int], date_encoding: str = YYYYMMDD
) -> list[dt.date]:
    """Dates, sorted, whose rows may differ from what ``report`` holds, given the marks of the run that wrote it.

    Without marks every date is affected. The changed keys are joined as they are: a small set is broadcast, a
    large one shuffles narrow rows. Only dates come to the driver, one for each partition to be rewritten.
    """
    bookings = _since(inputs.bookings, marks.get("bookings"))
    sessions = inputs.sessions.select("id", "learn_date", "study_program_id", UPDATED)
    programs = _since(inputs.programs, marks.get("programs")).select(F.col("id").alias("_program"))
    by_program = sessions.join(programs, F.col("study_program_id") == F.col("_program"), "left_semi")
    moved = _since(sessions, marks.get("sessions")).select("id").unionByName(by_program.select("id"))
    if inputs.removed_sessions is not None:
        moved = moved.unionByName(_since(inputs.removed_sessions, marks.get("removed"), "_removed_at").select("id"))
    booked = bookings.select(F.col("class_regular_session_id").alias("id"))
    reached = moved.unionByName(booked).distinct()
    dates = sessions.join(reached, "id", "left_semi").select(
        int_date(F.col("learn_date"), date_encoding).alias(REPORT_PARTITION)
    )
    if report is not None:
        stood = report.select(REPORT_PARTITION, "student_id", "class_regular_session_id")
        keys = moved.select(F.col("id").alias("class_regular_session_id")).distinct()
        students = bookings.select(F.col("student_id").cast("long").alias("student_id")).distinct()
        for by, column in ((keys, "class_regular_session_id"), (students, "student_id")):
            dates = dates.unionByName(stood.join(by, column, "left_semi").select(REPORT_PARTITION))
    return sorted(row[0] for row in dates.filter(F.col(REPORT_PARTITION).isNotNull()).distinct().collect())
