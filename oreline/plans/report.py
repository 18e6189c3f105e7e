"""The student-session report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.functions.dates import YYYYMMDD, as_date, int_date, int_date_between
from oreline.functions.labels import grade_band
from oreline.spec import REPORT_STATUSES


def attended(session_student: DataFrame, statuses: Sequence[str] = REPORT_STATUSES) -> DataFrame:
    """Bookings with one of the reported statuses."""
    return session_student.filter(F.col("status").isin(*statuses))


def sessions_between(
    session: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    date_encoding: str = YYYYMMDD,
) -> DataFrame:
    """Sessions of a date range, ``learn_date`` decoded. Undecodable dates drop out."""
    in_range = session.filter(int_date_between(F.col("learn_date"), start, end, date_encoding))
    decoded = in_range.withColumn("learn_date", int_date(F.col("learn_date"), date_encoding))
    return decoded.filter(F.col("learn_date").between(F.lit(as_date(start)), F.lit(as_date(end))))


def session_details(
    session: DataFrame,
    study_program: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    date_encoding: str = YYYYMMDD,
    grade: DataFrame | None = None,
) -> DataFrame:
    """What the report says about a session: date, program, optionally grade.

    Program and grade hang off the session, so they are joined to the (date
    filtered) sessions before the bookings are. Joined to the bookings
    afterwards they would shuffle the largest input a second time, on a key that
    is NULL for every booking out of range.
    """
    program = study_program.select(F.col("id").alias("program_id"), F.col("name").alias("study_program"))
    columns = ["id", "learn_date", "study_program_id"] + (["grade_id"] if grade is not None else [])
    details = (
        sessions_between(session, start, end, date_encoding)
        .select(*columns)
        .withColumnRenamed("id", "session_id")
        .join(program, F.col("study_program_id") == F.col("program_id"), "left")
    )
    if grade is None:
        return details.select("session_id", "learn_date", "study_program")
    grades = grade.select(
        F.col("id").alias("_grade_id"),
        F.col("code").alias("grade_code"),
        F.col("value").alias("grade_value"),
    )
    details = details.join(grades, F.col("grade_id") == F.col("_grade_id"), "left")
    return details.select("session_id", "learn_date", "study_program", "grade_code", "grade_value")


def booking_report(
    session_student: DataFrame,
    details: DataFrame,
    statuses: Sequence[str] = REPORT_STATUSES,
    date_filter: str = "pre_join",
) -> DataFrame:
    """Bookings of the given statuses with the details of their session.

    ``date_filter="pre_join"`` keeps a booking whose session is not among the
    details, with NULL date and program; ``"where"`` leaves it out.
    """
    if date_filter not in ("pre_join", "where"):
        raise ValueError(f"unknown date_filter: {date_filter}")
    labels = []
    if "grade_code" in details.columns:
        # Banded after the outer join: a booking without a session is "other" too.
        labels = [F.col("grade_code"), grade_band(F.col("grade_value")).alias("grade_program")]
    bookings = attended(session_student, statuses).select("student_id", "class_regular_session_id")
    joined = bookings.join(
        details,
        F.col("class_regular_session_id") == F.col("session_id"),
        "left" if date_filter == "pre_join" else "inner",
    )
    return joined.select(
        F.col("learn_date"),
        F.col("student_id").cast("long").alias("student_id"),
        F.col("class_regular_session_id"),
        F.col("study_program"),
        *labels,
    )


def student_session_report(
    session_student: DataFrame,
    session: DataFrame,
    study_program: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    statuses: Sequence[str] = REPORT_STATUSES,
    date_filter: str = "pre_join",
    date_encoding: str = YYYYMMDD,
    grade: DataFrame | None = None,
) -> DataFrame:
    """One row per reported booking: date, student, session, program.

    ``grade`` adds ``grade_code`` and ``grade_program``.
    """
    details = session_details(session, study_program, start, end, date_encoding, grade)
    return booking_report(session_student, details, statuses, date_filter)
