"""The report by SQL: a table function for a window, and a view of all dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from oreline.sinks.catalog import ensure_database, ensure_table
from oreline.spec import ENTITIES, REPORT_STATUSES, Layout

FUNCTION, VIEW = "report_between", "student_sessions"

_SOURCE = """
SELECT s.learn_date, CAST(b.student_id AS BIGINT) AS student_id, b.class_regular_session_id, s.study_program
FROM {bookings} b {join} JOIN (
  SELECT i.id, try_to_date(CAST(i.learn_date AS STRING), 'yyyyMMdd') AS learn_date, p.name AS study_program
  FROM {sessions} i LEFT JOIN {programs} p ON p.id = i.study_program_id
  WHERE {dates}) s ON s.id = b.class_regular_session_id
WHERE b.status IN ({statuses})"""


def _number(day: str) -> str:
    return f"CAST(date_format({day}, 'yyyyMMdd') AS INT)"


def register_report_sql(spark: SparkSession, layout: Layout, statuses: Sequence[str] = REPORT_STATUSES) -> tuple[str, str]:
    """Create, in the database of the gold layer, what answers for the report in plain SQL; returns both names.

    ``report_between(first_date, last_date)`` is the report of a window as the gold job makes it: a booking
    without a session in the window has no date. ``student_sessions`` is a permanent view of all dated rows. Both are
    computed from the silver tables, which are registered, when they are asked; conditions
    on the window reach the scan of the sessions, and columns nobody asks for are not read. A table
    function has no database in its name: call it after ``USE``. With a metastore both outlive the session.
    """
    names = {}
    for role, name in (("bookings", "class_regular_session_student"), ("sessions", "class_regular_session"), ("programs", "study_program")):
        table = layout.silver_table(ENTITIES[name])
        ensure_table(spark, table)
        names[role] = table.qualified
    gold = layout.report_table().database
    ensure_database(spark, gold)
    names["statuses"] = ", ".join("'" + status.replace("'", "\\'") + "'" for status in statuses)
    function, view = f"{layout.table_prefix}{FUNCTION}", f"{gold}.{layout.table_prefix}{VIEW}"
    # The numbers are what a scan can skip by; a number that is no date is no session of the window.
    dated = "try_to_date(CAST(i.learn_date AS STRING), 'yyyyMMdd') IS NOT NULL"
    window = f"i.learn_date BETWEEN {_number(f'{function}.first_date')} AND {_number(f'{function}.last_date')} AND {dated}"
    spark.sql(
        f"CREATE OR REPLACE FUNCTION {gold}.{function}(first_date DATE, last_date DATE) "
        "RETURNS TABLE (learn_date DATE, student_id BIGINT, class_regular_session_id STRING, study_program STRING) "
        "RETURN " + _SOURCE.format(join="LEFT", dates=window, **names)
    )
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS " + _SOURCE.format(join="INNER", dates=dated, **names))
    return function, view
