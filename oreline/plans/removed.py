"""Keys that deletes have taken out of a silver table, so that older events do not bring them back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.functions.envelope import stamp
from oreline.sinks.tables import finish, read_touched, upsert_table
from oreline.spec import VERSION, EntitySpec

REMOVED_AT = "_removed_at"


def removed_schema(entity: EntitySpec) -> T.StructType:
    return T.StructType(
        [
            T.StructField(entity.key, entity.after_schema[entity.key].dataType, False),
            T.StructField(VERSION, T.LongType()),
            T.StructField(REMOVED_AT, T.TimestampType()),
        ]
    )


def remember_removed(
    spark: SparkSession, path: str, entity: EntitySpec, changes: DataFrame, remembered: dt.timedelta
) -> None:
    """Keep the keys and versions of the delete events among ``changes``, the highest version of each key.

    A key that was remembered for longer than ``remembered`` is dropped when its folder is next rewritten.
    """
    gone = stamp(changes.filter(F.col("_op") == "d").select(entity.key, VERSION), REMOVED_AT)
    limit = F.current_timestamp() - F.expr(f"interval {int(remembered.total_seconds())} seconds")
    upsert_table(
        spark,
        path,
        gone,
        [entity.key],
        schema=removed_schema(entity),
        on_duplicate="trust",
        guard=VERSION,
        expired=F.col(REMOVED_AT) < limit,
        parts=entity.parts,
    )


def without_removed(spark: SparkSession, path: str, entity: EntitySpec, changes: DataFrame) -> DataFrame:
    """``changes`` without events that are older than the removal of their key, or as old.

    A delete passes if it is as old: it may be the one remembered, by a run that was lost before its merge.
    """
    finish(spark, path)
    removed = read_touched(spark, path, changes, [entity.key], removed_schema(entity))
    if removed is None:
        return changes
    marks = removed.select(F.col(entity.key).alias("_k"), F.col(VERSION).alias("_v"))
    deleted = F.col("_op") == "d" if "_op" in changes.columns else F.lit(False)
    older = F.col("_v") >= F.when(deleted, F.col(VERSION) + 1).otherwise(F.col(VERSION))
    return changes.join(marks, (F.col(entity.key) == F.col("_k")) & older, "left_anti")
