"""Reducing a change log to the rows an upsert needs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from oreline.functions.dates import as_date
from oreline.sources.tables import read_date_range, read_table
from oreline.spec import BEFORE_KEY, BRONZE_META, EVENT_DATE, VERSION, EntitySpec

KEY_HASH = "_key_hash"
# Millisecond timestamps tie; a stream position does not, so the newest change
# is the same one on every run.
NEWEST_FIRST = ("_ts_ms", "_kafka_offset", "_kafka_partition")


def in_window(df: DataFrame, start: str | dt.date, end: str | dt.date, column: str = EVENT_DATE) -> DataFrame:
    """Rows whose date lies in ``[start, end]``, both ends included."""
    return df.filter(F.col(column).between(F.lit(as_date(start)), F.lit(as_date(end))))


def read_changes(
    spark: SparkSession,
    path: str,
    start: str | dt.date,
    end: str | dt.date,
    schema: StructType | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Bronze rows of a range of event dates; only those partitions are read."""
    if fmt == "parquet":
        return read_date_range(spark, path, EVENT_DATE, start, end, schema)
    return in_window(read_table(spark, path, fmt, schema), start, end)


def drop_deletes(df: DataFrame) -> DataFrame:
    """Drop delete events, and rows that have no operation at all."""
    return df.filter(F.col("_op") != "d")


def require_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep rows in which every key column has a value."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    newest_first: Iterable[str | Column] = NEWEST_FIRST,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """The newest row of each key.

    A top-1 rank: Catalyst keeps one row per key in every map task before the
    shuffle, so a key that holds a third of the log ships one row per task.
    ``repeated``, as ``repeated_hashes`` gives them, tells which keys need a rank at
    all: a row that is alone with its key is not shuffled.
    """
    if repeated is not None:
        once, several = split_repeated(df, keys, repeated)
        return once.unionByName(latest_per_key(several, keys, newest_first))
    order = [F.desc(c) if isinstance(c, str) else c for c in newest_first]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(key) for key in keys])


def split_repeated(df: DataFrame, keys: Sequence[str], repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that are alone with their key, and the others, among them those whose key has the hash of a repeated one."""
    hashed, few = df.withColumn(KEY_HASH, key_hash(keys)), F.broadcast(repeated)
    return tuple(hashed.join(few, KEY_HASH, how).drop(KEY_HASH) for how in ("left_anti", "left_semi"))


def strip_columns(df: DataFrame, names: Iterable[str] = BRONZE_META) -> DataFrame:
    """Drop the named columns that are present."""
    return df.drop(*names)


def silver_changes(
    df: DataFrame,
    entity: EntitySpec,
    deletes: str = "drop",
    keep_version: bool = False,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """Bronze rows -> one row per key, ready to be upserted.

    ``deletes="drop"`` removes delete events first, so a key that was deleted
    comes out with its last live image. ``deletes="apply"`` picks the newest
    event first and keeps deletes as rows with ``_op = 'd'`` and only the key
    set, for ``upsert(..., delete_when=...)``; bronze must carry the key of the
    before image (``EntitySpec.before_key``).

    ``keep_version=True`` keeps the event time as ``_version``. ``repeated`` holds the
    hashes of the keys that several of the ``keyed_changes`` share, if they are known.
    """
    key = entity.key
    newest = latest_per_key(keyed_changes(df, entity, deletes), [key], repeated=repeated)
    if keep_version:
        newest = newest.withColumn(VERSION, F.col("_ts_ms"))
    keep_op = deletes == "apply"
    return strip_columns(newest, [c for c in BRONZE_META if not (keep_op and c == "_op")])


def keyed_changes(df: DataFrame, entity: EntitySpec, deletes: str = "drop") -> DataFrame:
    """The bronze rows that ``silver_changes`` chooses from."""
    key = entity.key
    if deletes == "drop":
        rows = drop_deletes(df)
    elif deletes == "apply":
        rows = df.filter(F.col("_op").isNotNull()).withColumn(key, F.coalesce(F.col(key), F.col(BEFORE_KEY)))
    else:
        raise ValueError(f"unknown deletes mode: {deletes}")
    return require_key(rows, [key])
