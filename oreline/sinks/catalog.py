"""Catalog databases and external tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from oreline import paths
from oreline.spec import TableSpec


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_table_sql(spec: TableSpec) -> str:
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in spec.schema.fields
    )
    parts = [f"CREATE TABLE IF NOT EXISTS {spec.qualified} ({columns}) USING {spec.fmt}"]
    if spec.partition_by:
        parts.append(f"PARTITIONED BY ({', '.join(f'`{c}`' for c in spec.partition_by)})")
    if spec.dealt:
        parts.append("OPTIONS ('recursiveFileLookup' = 'true')")
    parts.append(f"LOCATION {_quoted(spec.path)}")
    if spec.properties:
        pairs = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in spec.properties.items())
        parts.append(f"TBLPROPERTIES ({pairs})")
    return " ".join(parts)


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def ensure_table(spark: SparkSession, spec: TableSpec) -> None:
    """Create the external table if it is missing, and register partitions written by path."""
    ensure_database(spark, spec.database)
    spark.sql(create_table_sql(spec))
    if spec.fmt != "parquet":
        return
    if spec.partition_by and paths.exists(spark, spec.path):
        # SYNC also forgets partitions that compaction has folded away.
        spark.sql(f"MSCK REPAIR TABLE {spec.qualified} SYNC PARTITIONS")
    spark.catalog.refreshTable(spec.qualified)
