"""Writing tables: appends and table-level upserts."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from oreline import paths
from oreline.operators.changes import KEY_HASH, key_hash
from oreline.operators.upsert import check_not_null, upsert
from oreline.sources.tables import (
    UNDATED,
    key_column,
    key_parts,
    read_date_range,
    read_table,
    table_exists,
)

logger = logging.getLogger("oreline.tables")

_DATED = "_dated"
#: Where a merge puts the complete rows of the partitions it is about to replace.
PENDING = "_pending"
#: Folders that a table without a partition column is dealt to, where nothing else is said.
PARTS = 16
#: Hashes of repeated keys that are sent to every task at most.
FEW = 1_000_000
#: Rows of a merge's source whose keys, of any width, are sent to every task.
FEW_ROWS = 100_000


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    compression: str | None = None,
    max_records_per_file: int | None = None,
    bloom: Sequence[str] = (),
) -> None:
    """Write files under ``path``. ``mode="overwrite_partitions"`` replaces just
    the partitions that occur in ``df``. ``bloom`` names columns that get a Parquet Bloom
    filter: a scan for single values skips the row groups that cannot have them."""
    options = {f"parquet.bloom.filter.enabled#{column}": "true" for column in bloom}
    if compression or fmt == "parquet":
        options["compression"] = compression or default_compression(df.sparkSession)
    if max_records_per_file:
        options["maxRecordsPerFile"] = str(max_records_per_file)
    if mode == "overwrite_partitions":
        mode = "overwrite"
        options["partitionOverwriteMode"] = "dynamic"
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def default_compression(spark: SparkSession) -> str:
    """Zstandard, unless the session names a codec: keys of text take a third less than with Spark's default."""
    return spark.conf.get("spark.sql.parquet.compression.codec", None) or "zstd"


def repeated_hashes(df: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """Hashes of the keys that several rows share, written down; None if there are too many to send to every task.

    Only hashes are shuffled. Where few keys repeat, as in the initial snapshot of a table, work on
    repeated keys can leave the other rows where they are.
    """
    spark = df.sparkSession
    path = paths.scratch_path(spark, "repeated")
    counted = df.groupBy(key_hash(keys).alias(KEY_HASH)).agg(F.count(F.lit(1)).alias("_copies"))
    write_table(counted.filter("_copies > 1").select(KEY_HASH), path, mode="error")
    found = spark.read.schema(f"{KEY_HASH} long").parquet(path)
    if found.count() <= FEW:
        return found
    paths.delete(spark, path)
    return None


def publish(df: DataFrame, path: str, partition_by: str, lookup_by: Sequence[str] = ()) -> list[str]:
    """Replace the partitions of ``df`` in the table; returns their folder names.

    ``df`` may read what it replaces: its rows are complete in a folder of their own, which readers
    of the table skip, before the first old file goes. Partitions are replaced one after the other; a
    driver that is lost meanwhile leaves that folder, and the next merge begins with ``finish``.
    Files are sorted by ``lookup_by`` and have Bloom filters on it.
    """
    spark = df.sparkSession
    pending = f"{path}/{PENDING}"
    # The marker says that the rows are complete, whatever the cluster's default for it is.
    marked = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "true"}
    marked["compression"] = default_compression(spark)
    df.hint("rebalance", partition_by).write.options(**marked).partitionBy(partition_by).parquet(pending)
    written = [name for name in paths.child_dirs(spark, pending) if "=" in name]
    finish(spark, path, lookup_by)
    return written


def replace_partitions(
    df: DataFrame, path: str, partition_by: str, values: Sequence[str], lookup_by: Sequence[str] = ()
) -> None:
    """Make the rows of ``df`` all there is in the partitions of ``values``; one without rows goes."""
    spark = df.sparkSession
    written = publish(df, path, partition_by, lookup_by)
    emptied = {_folder(partition_by, value) for value in values} - set(written)
    paths.side_by_side(
        lambda name: paths.delete(spark, f"{path}/{name}"), emptied & set(paths.child_dirs(spark, path))
    )


def finish(spark: SparkSession, path: str, lookup_by: Sequence[str] = ()) -> None:
    """Put a merge's complete rows in their place, also if an earlier attempt was stopped half-way.

    Writing them again changes nothing. Rows that are not complete are dropped: nothing had been replaced yet.
    """
    pending = f"{path}/{PENDING}"
    if not paths.exists(spark, pending):
        return
    if paths.exists(spark, f"{pending}/_SUCCESS"):
        columns = paths.partition_columns(spark, pending)
        if columns:
            rows = read_table(spark, pending, text_partitions=True, dealt_column=True)
            if lookup_by:
                rows = rows.sortWithinPartitions(*columns, *lookup_by)
            write_table(rows, path, "overwrite_partitions", columns, bloom=lookup_by)
    paths.delete(spark, pending)


def _passing_name() -> str:
    return f"oreline_{uuid.uuid4().hex}"


@contextmanager
def staged(
    df: DataFrame, label: str, partition_by: Sequence[str] = (), keep_on_error: bool = False
) -> Iterator[DataFrame]:
    """``df`` computed once, as files in the shared folder.

    A written table rather than a cache: it survives lost executors, cuts the
    lineage, and its size is known to the planner of whatever reads it next.
    ``keep_on_error`` is for rows about to replace the only other copy: if that
    fails half-way, the files stay and can be written again.
    """
    spark = df.sparkSession
    path = paths.scratch_path(spark, label)
    written = False
    try:
        write_table(df, path, mode="error", partition_by=partition_by)
        written = True
        yield spark.read.schema(df.schema).parquet(path)
    except Exception:
        if keep_on_error and written:
            logger.error("the complete rows are kept in %s", path)
        else:
            paths.delete(spark, path)
        raise
    paths.delete(spark, path)


def upsert_table(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    match_also: Sequence[str] = (),
    partition_by: str | None = None,
    schema: StructType | None = None,
    not_null: Sequence[str] = (),
    on_duplicate: str = "error",
    null_safe: bool = False,
    evolve: bool = False,
    guard: str | None = None,
    delete_when: Column | None = None,
    expired: Column | None = None,
    parts: int = PARTS,
    fmt: str = "parquet",
) -> int:
    """Merge ``source`` into the table at ``path``; returns the source row count.

    An empty source changes nothing. A new table is written once, an existing one by way of ``publish``. See ``upsert`` for the row semantics. Only the
    partitions that the source touches are read and rewritten: those of ``partition_by``,
    a column of the match condition, or else of the hash of ``keys``, which deals
    a new table to ``parts`` folders (an existing one stays as it was dealt). Rows with a
    NULL key match nothing and are appended to a folder of their own.
    ``schema`` declares the table's columns; others that the table has are kept
    as they are. Without it all columns come from the footers. ``expired`` is a condition
    on the table's rows: those leave a dealt table when their folder is rewritten.
    One writer per table at a time.
    """
    if evolve:
        schema = None  # the table may have columns its declaration does not
    if fmt != "parquet":
        if null_safe or evolve or guard or delete_when is not None or expired is not None or on_duplicate != "error":
            raise ValueError(f"only the plain merge is available for format {fmt}")
        with staged(source, "upsert-source") as rows:
            count = rows.count()
            if count:
                _merge_into(rows, f"{fmt}.`{path}`", [*keys, *match_also])
            return count
    if partition_by and partition_by not in [*keys, *match_also]:
        raise ValueError("partition_by must be part of the match condition")
    if partition_by and (delete_when is not None or expired is not None):
        raise ValueError("delete_when and expired are not available for a partitioned table")

    options = {
        "keys": keys,
        "match_also": match_also,
        "on_duplicate": on_duplicate,
        "null_safe": null_safe,
        "evolve": evolve,
        "guard": guard,
        "delete_when": delete_when,
    }
    if partition_by:
        # Dated and undated rows go separate ways; staged apart, none of the
        # passes over the one reads the other.
        flagged = source.withColumn(_DATED, F.col(partition_by).isNotNull())
        with staged(flagged, "upsert-source", [_DATED]) as rows:
            return _upsert_partitions(spark, path, rows, partition_by, schema, not_null, options)
    own = key_parts(spark, path)
    if not own and table_exists(spark, path):
        raise RuntimeError(f"{path} was not written by a merge: move it away and merge its rows into a new table")
    part = key_column(own or parts)
    fresh = not own and not paths.exists(spark, f"{path}/{PENDING}")
    if fresh and delete_when is None and on_duplicate != "keep_any":
        return _create_dealt(spark, path, source, part, schema, not_null, options)
    with staged(source.withColumn(part, _part_of(keys, own or parts)), "upsert-source") as rows:
        return _upsert_dealt(spark, path, rows, part, schema, not_null, options, expired)


def _part_of(keys: Sequence[str], parts: int) -> Column:
    """The folder of a key; none if any of its columns is NULL."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    # As text, so that a key keeps its folder when its type is widened.
    return F.when(~missing, F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(parts)).cast("int"))


def _create_dealt(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    part: str,
    schema: StructType | None,
    not_null: Sequence[str],
    options: dict,
) -> int:
    """Merge into a dealt table that is yet to be made: what is written replaces nothing, so it goes straight to its folders.

    A job that is lost before its commit leaves nothing, and one that is run again merges into what the first has left.
    """
    keys = options["keys"]
    rows = check_not_null(source, not_null)
    merged = upsert(_nothing(spark, rows, schema), rows, null_keys=False, **options)
    dealt = merged.withColumn(part, _part_of(keys, int(part.rpartition("_")[2])))
    write_table(dealt.hint("rebalance", part).sortWithinPartitions(part, *keys), path, "append", [part], bloom=keys)
    if not key_parts(spark, path):
        paths.delete(spark, f"{path}/_SUCCESS")  # an empty source makes no table
        return 0
    # As many as the source has: told by the files' footers.
    return read_table(spark, path).count()


def _upsert_dealt(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    part: str,
    schema: StructType | None,
    not_null: Sequence[str],
    options: dict,
    expired: Column | None,
) -> int:
    finish(spark, path)
    keys, null_safe = options["keys"], options["null_safe"]
    # A row per folder at most.
    counts = {row[part]: row["count"] for row in rows.groupBy(part).count().collect()}
    if not counts:
        return 0
    # What the table holds has passed this check when it was a source.
    rows = check_not_null(rows, not_null)
    undealt = rows.filter(F.col(part).isNull())
    if None in counts and set(keys) & set(not_null):
        # These rows are written last; what is wrong with them must show before anything is replaced.
        undealt.write.format("noop").mode("overwrite").save()
    touched = {_folder(part, value) for value in counts if value is not None or null_safe}
    matchable = rows if null_safe else rows.filter(F.col(part).isNotNull())
    if touched:
        there = [name for name in paths.child_dirs(spark, path) if name in touched]
        target = _dealt_target(spark, path, there, matchable.drop(part), schema, options["delete_when"])
        if expired is not None:
            target = target.filter(~F.coalesce(expired, F.lit(False)))
        few = sum(counts.values()) <= FEW_ROWS
        merged = upsert(target, matchable.drop(part), null_keys=False, few=few, **options)
        dealt = merged.withColumn(part, _part_of(keys, int(part.rpartition("_")[2])))
        replace_partitions(dealt, path, part, [str(value) for value in counts if value is not None], keys)
    if None in counts and not null_safe:
        # NULL equals nothing: these rows are inserts whatever the table holds.
        delete_when = options["delete_when"]
        if delete_when is not None:
            undealt = undealt.filter(~F.coalesce(delete_when, F.lit(False))).drop(
                *[c for c in ["_op"] if schema is None or "_op" not in schema.names]
            )
        write_table(undealt, path, "append", [part])
    return sum(counts.values())


def read_touched(
    spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], schema: StructType
) -> DataFrame | None:
    """The folders of a dealt table that keys of ``rows`` belong to; None if there are none."""
    parts = key_parts(spark, path)
    if not parts:
        return None
    column = key_column(parts)
    touched = rows.select(_part_of(keys, parts).alias(column)).distinct().collect()
    names = {_folder(column, row[0]) for row in touched}
    folders = [f"{path}/{name}" for name in paths.child_dirs(spark, path) if name in names]
    return read_table(spark, path, schema=schema, folders=folders) if folders else None


def lookup(spark: SparkSession, path: str, key: str, values: Sequence, schema: StructType) -> DataFrame:
    """Rows of a dealt table with one of a few keys.

    Only the folders the keys belong to are listed; in them, the Bloom filters and the order of the files leave the
    row groups that may have one.
    """
    wanted = spark.createDataFrame([(value,) for value in values], StructType([schema[key]]))
    rows = read_touched(spark, path, wanted, [key], schema)
    return _nothing(spark, wanted, schema) if rows is None else rows.filter(F.col(key).isin(list(values)))


def _folder(column: str, value: object) -> str:
    return f"{column}={UNDATED if value is None else value}"


def _dealt_target(
    spark: SparkSession,
    path: str,
    folders: Sequence[str],
    rows: DataFrame,
    schema: StructType | None,
    delete_when: Column | None,
) -> DataFrame:
    """The touched folders of a dealt table as they are, with the columns of all their files."""
    if not folders:
        return _nothing(spark, rows, schema, delete_when)
    where = {"folders": [f"{path}/{name}" for name in folders]}
    own = read_table(spark, path, merge_schema=True, **where).schema
    columns = own if schema is None else _with_declared(own, schema)
    return read_table(spark, path, schema=columns, **where)


def _nothing(
    spark: SparkSession, rows: DataFrame, schema: StructType | None, delete_when: Column | None = None
) -> DataFrame:
    """A table that is yet to be made. Known to be empty at planning time, so the merge plan reduces to the source."""
    if schema is None:
        schema = rows.schema
        if delete_when is not None:
            schema = StructType([f for f in schema.fields if f.name != "_op"])
    return spark.range(1).limit(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def _target(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    schema: StructType | None,
    within: tuple,
) -> DataFrame:
    """The touched partitions as they are. ``within`` is the partition column, the values of it
    that matter, and whether NULL does too."""
    if not table_exists(spark, path):
        return _nothing(spark, rows, schema)
    # What is not read here would be missing from the rewritten files, so the
    # table's own columns count, declared or not: those of all files that are rewritten.
    options = {"schema": None, "merge_schema": True, "text_partitions": True}
    column, values, with_null = within
    kind = rows.schema[column].dataType
    if isinstance(kind, DateType) and values:
        dates = {"with_undated": with_null, "days": set(values)}
        picked = read_date_range(spark, path, column, min(values), max(values), **dates, **options)
        if schema is not None:
            options = {"schema": _with_declared(picked.schema, schema), "text_partitions": True}
            picked = read_date_range(spark, path, column, min(values), max(values), **dates, **options)
        return picked.withColumn(column, F.col(column).cast(kind))
    target = read_table(spark, path, **options).withColumn(column, F.col(column).cast(kind))
    wanted = F.col(column).isin(values) if values else F.lit(False)
    return target.filter(wanted | F.col(column).isNull() if with_null else wanted)


def _with_declared(own: StructType, declared: StructType) -> StructType:
    """The table's own columns, in the declared type where there is one, then declared ones it lacks."""
    types = {f.name: f for f in declared.fields}
    kept = [types.get(f.name, f) for f in own.fields]
    return StructType(kept + [f for f in declared.fields if f.name not in own.names])


def _upsert_partitions(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    partition_by: str,
    schema: StructType | None,
    not_null: Sequence[str],
    options: dict,
) -> int:
    finish(spark, path)
    partition = F.col(partition_by)
    dated_count, count = rows.agg(F.count(partition), F.count(F.lit(1))).first()
    if count == 0:
        return 0
    rows = check_not_null(rows, not_null)
    dated, undated = rows.filter(_DATED).drop(_DATED), rows.filter(~F.col(_DATED)).drop(_DATED)
    null_safe = options["null_safe"]
    matchable = rows.drop(_DATED) if null_safe else dated

    if dated_count or null_safe:
        # As many values as the merge makes folders. With them the target is cut to the
        # touched partitions when the scan is planned: no join on a column of few values.
        touched = [row[0] for row in rows.filter(_DATED).select(partition_by).distinct().collect()]
        target = _target(spark, path, matchable, schema, (partition_by, touched, null_safe))
        publish(upsert(target, matchable, few=count <= FEW_ROWS, **options), path, partition_by)

    if count > dated_count and not null_safe:
        # NULL equals nothing: these rows are inserts whatever the table holds.
        write_table(undated, path, "append", [partition_by])
    return count


def _merge_into(rows: DataFrame, table: str, match: Sequence[str]) -> None:
    """MERGE in a table format that has row-level operations of its own."""
    on = " AND ".join(f"target.{c} = source.{c}" for c in match)
    # A name of its own: two merges in one session must not replace each other's source.
    view = _passing_name()
    rows.createOrReplaceTempView(view)
    try:
        rows.sparkSession.sql(
            f"MERGE INTO {table} AS target USING {view} AS source ON {on} "
            "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
        )
    finally:
        rows.sparkSession.catalog.dropTempView(view)
