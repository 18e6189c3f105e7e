"""Batch table access, by path and by name."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from oreline import paths
from oreline.functions.dates import as_date

UNDATED = "__HIVE_DEFAULT_PARTITION__"

# A table without a partition column of its own is dealt to folders by the hash of its key. The
# folder names state how many there are, so a table stays as it was dealt whatever is declared later.
_DEALT = re.compile(r"_key_of_(\d+)$")
_OLD_SNAPSHOT = re.compile(r"snapshot-\d+")


def key_column(parts: int) -> str:
    """Partition column of a table dealt to ``parts`` folders by its key."""
    return f"_key_of_{parts}"


def key_parts(spark: SparkSession, path: str) -> int:
    """How many folders a table is dealt to by its key; 0 if it is not dealt."""
    for name in paths.child_dirs(spark, path):
        if found := _DEALT.match(name.partition("=")[0]):
            return int(found[1])
    return 0


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a committed write has ever put data under ``path``."""
    folders = paths.child_dirs(spark, path)
    if any(_OLD_SNAPSHOT.match(name) for name in folders):
        raise RuntimeError(f"{path} is in numbered snapshots, which are no longer read: write its newest one anew")
    return (
        paths.exists(spark, f"{path}/_SUCCESS") or any("=" in name for name in folders) or paths.has_files(spark, path)
    )


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | None = None,
    merge_schema: bool = False,
    text_partitions: bool = False,
    folders: list[str] | None = None,
    dealt_column: bool = False,
) -> DataFrame:
    """Read a table by path.

    The column that a table is dealt to folders by is no column of the result, unless ``dealt_column``.

    Give ``schema`` where it is known: files written before a column existed
    then read it as NULL without any footer being opened for inference.
    ``merge_schema=True`` finds the union of all file schemas instead, which
    opens every footer. ``text_partitions=True`` takes partition values as they
    are in the path, where inference would turn ``01`` into the number 1: what is
    rewritten must go back to the partition it came from. ``folders`` limits the
    read to some partition folders of the table.
    """
    def load(columns: StructType | None) -> DataFrame:
        reader = spark.read.format(fmt)
        if columns is not None:
            reader = reader.schema(columns)
        elif merge_schema:
            reader = reader.option("mergeSchema", "true")
        if dealt:
            # Values are taken from the files alone, so the folders' column does not come up.
            return reader.option("recursiveFileLookup", "true").load(folders or path)
        if folders:
            return reader.option("basePath", path).load(folders)
        return reader.load(path)

    dealt = not dealt_column and fmt == "parquet" and key_parts(spark, path) > 0
    if dealt or not text_partitions:
        return load(schema)
    # Declared as text they are not inferred; a setting would change what other threads of the session read.
    own = paths.partition_columns(spark, path)
    text = [StructField(name, StringType()) for name in own]
    if schema is not None:
        return load(StructType([*schema.fields, *[f for f in text if f.name not in schema.names]]))
    if not own:
        return load(None)
    return load(StructType([*[f for f in load(None).schema.fields if f.name not in own], *text]))


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the first-level partition column, as they are in the folder names."""
    prefix = f"{column}="
    return [n.removeprefix(prefix) for n in paths.child_dirs(spark, path) if n.startswith(prefix)]


def date_in_range(value: str, start: dt.date, end: dt.date) -> bool:
    """Whether a partition value is a date in the range. A corrupt event time can
    make a folder of the year 50000 (or of no date): that is in no range."""
    try:
        return start <= as_date(value) <= end
    except ValueError:
        return False


def read_date_range(
    spark: SparkSession,
    path: str,
    column: str,
    start: str | dt.date,
    end: str | dt.date,
    schema: StructType | None = None,
    with_undated: bool = False,
    days: Collection[dt.date] | None = None,
    **options,
) -> DataFrame:
    """Rows of a date-partitioned table with ``start <= column <= end``.

    Reading the table and filtering would prune the files, but only after every
    folder of every date (and of every batch below it) had been listed. Here one
    listing of the top level picks the dates, and only those are listed further.
    ``days`` picks single dates of the range.
    """
    start, end = as_date(start), as_date(end)
    wanted = F.col(column).between(F.lit(start), F.lit(end))
    if days is not None:
        wanted = wanted & F.col(column).cast("date").isin(list(days))
    if with_undated:
        wanted = wanted | F.col(column).isNull()
    values = partition_values(spark, path, column)
    picked = [
        v
        for v in values
        if (date_in_range(v, start, end) and (days is None or as_date(v) in days)) or (with_undated and v == UNDATED)
    ]
    if len(picked) == len(values):
        return read_table(spark, path, schema=schema, **options).filter(wanted)
    # An empty window still needs some folder to take the columns from.
    folders = [f"{path}/{column}={v}" for v in picked or values[:1]]
    return read_table(spark, path, schema=schema, folders=folders, **options).filter(wanted)


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Make tables available to ``spark.sql`` under the given names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
