"""File-system helpers: metadata operations only, through Hadoop's FileSystem."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession


#: Calls to the file system in flight at once, where there is one per folder.
CALLS = 32

T = TypeVar("T")
R = TypeVar("R")


def side_by_side(call: Callable[[T], R], items: Iterable[T]) -> list[R]:
    """``call`` for every item, in order; an object store answers a month of folders in minutes, not hours."""
    with ThreadPoolExecutor(CALLS) as pool:
        return list(pool.map(call, items))


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def child_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories directly under ``path``, sorted."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly under ``path``, sorted."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isFile())


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether data files lie directly under ``path``; names with ``_`` or ``.`` in front are not data."""
    return any(name[0] not in "_." for name in child_files(spark, path))


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Partition columns of a table, from the folder names down to its first file."""
    found: list[str] = []
    while nested := [name for name in child_dirs(spark, path) if "=" in name]:
        found.append(nested[0].partition("=")[0])
        path = f"{path}/{nested[0]}"
    return found


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, for staged and checkpointed data.

    The cluster names it in ``spark.checkpoint.dir``. A temporary folder is made
    up only in local mode, where driver and executors are one process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="oreline-")
        spark.sparkContext.setCheckpointDir(base)
    return base


def scratch_root(spark: SparkSession) -> str:
    """This application's folder for staged data; safe to delete once it has ended."""
    return f"{shared_dir(spark).rstrip('/')}/oreline/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
