"""How far a consumer has come: high-water marks, appended to a small table.

A mark is written after the work it stands for. A job that is lost in between does that work again,
which merges and replaced partitions bear.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from oreline.functions.envelope import stamp
from oreline.sinks.tables import write_table
from oreline.sources.tables import read_table, table_exists
from oreline.spec import struct

MARKS = struct("name string, mark bigint")


def read_marks(spark: SparkSession, path: str) -> dict[str, int]:
    """The highest mark of each name; a name per input or run of a stream."""
    if not table_exists(spark, path):
        return {}
    marks = read_table(spark, path, schema=MARKS).groupBy("name").agg(F.max("mark").alias("mark"))
    return {row["name"]: row["mark"] for row in marks.collect()}


def add_marks(spark: SparkSession, path: str, marks: Mapping[str, int]) -> None:
    if marks:
        rows = spark.createDataFrame(list(marks.items()), MARKS).coalesce(1)
        write_table(stamp(rows, "_marked_at"), path)
