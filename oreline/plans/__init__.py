from oreline.plans.jobs import build_gold_changes, build_gold_report, build_silver, ingest_bronze, run_window
from oreline.plans.report import student_session_report
from oreline.plans.sql import register_report_sql

__all__ = [
    "build_gold_changes",
    "build_gold_report",
    "build_silver",
    "ingest_bronze",
    "register_report_sql",
    "run_window",
    "student_session_report",
]
