"""Change feeds and report inputs derived from plain star-schema tables.

They let every job run on any parquet copy of the tables ``events``, ``orders``,
``lineitem``, ``customer`` and ``nation``, at any size, without a message broker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oreline.operators.changes import split_repeated
from oreline.sinks.tables import repeated_hashes
from oreline.spec import ENTITIES, REPORT_STATUSES, EntitySpec

EVENTS = EntitySpec("events", "id string, event_type string, value double, props string")
EVENTS_WITH_BEFORE = EntitySpec("events", EVENTS.columns, before_key=True)
ORDERS = EntitySpec("orders", "id string, order_id bigint, status string, total double, priority string")

STATUSES = ("A", "R")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _record(topic: str, number: Column, ts: Column, value: Column) -> list[Column]:
    return [
        F.lit(topic).alias("topic"),
        F.pmod(number, F.lit(3)).cast("int").alias("partition"),
        F.floor(number / 3).alias("offset"),
        ts.alias("timestamp"),
        value.alias("value"),
    ]


def _message(before: Column, after: Column, op: Column, ts: Column) -> Column:
    payload = F.struct(
        before.alias("before"),
        after.alias("after"),
        op.alias("op"),
        F.unix_millis(ts).alias("ts_ms"),
    )
    return F.to_json(F.struct(payload.alias("payload")), {"ignoreNullFields": "false"})


def event_feed(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """``events`` as change records, one entity per user.

    An error event is a delete, a signup a create, anything else an update.
    ``broken=True`` turns some values into garbage and some into tombstones.
    """
    events = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    deleted = F.col("event_type") == "error"
    image = F.struct(F.col("user_id").cast("string").alias("id"), "event_type", "value", "props")
    op = F.when(deleted, "d").when(F.col("event_type") == "signup", "c").otherwise("u")
    value = _message(F.when(deleted, image), F.when(~deleted, image), op, ts)
    if broken:
        remainder = F.col("event_id") % 97
        value = F.when(remainder == 0, "garbage").when(remainder != 1, value)
    return events.select(*_record("cdc.events", F.col("event_id"), ts, value))


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as change records, one entity per customer: its newest order."""
    orders = table(spark, sf_dir, "orders")
    ts = F.col("o_orderdate").cast("timestamp")
    image = F.struct(
        F.col("o_custkey").cast("string").alias("id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderpriority").alias("priority"),
    )
    value = _message(F.when(F.lit(False), image), image, F.lit("u"), ts)
    return orders.select(*_record("cdc.orders", F.col("o_orderkey"), ts, value))


SNAPSHOT_TIME = "2024-01-01 06:00:00"


def snapshot_feed(entity: EntitySpec, rows: DataFrame, number: Column) -> DataFrame:
    """``rows`` as the initial snapshot of ``entity``: one ``r`` record per row, all
    taken at one moment. Columns the rows lack are NULL in the image."""
    ts = F.lit(SNAPSHOT_TIME).cast("timestamp")
    image = F.struct(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in entity.after_schema.fields
        ]
    )
    value = _message(F.when(F.lit(False), image), image, F.lit("r"), ts)
    return rows.select(*_record(entity.topic, number, ts, value))


def report_snapshots(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Snapshot feeds of the report's three entities, by entity name."""
    lines = table(spark, sf_dir, "lineitem")
    # No column set of lineitem is a key: a booking is identified by all of them, and numbered among its like.
    rows = lines.withColumn("_row", F.concat_ws("|", *lines.columns))
    number = F.row_number().over(Window.partitionBy("_row").orderBy(F.lit(0)))
    repeated = repeated_hashes(rows, ["_row"])
    if repeated is None:
        numbered = rows.withColumn("_number", number)
    else:
        once, several = split_repeated(rows, ["_row"], repeated)
        numbered = once.withColumn("_number", F.lit(1)).unionByName(several.withColumn("_number", number))
    booking = numbered.select(
        F.concat_ws("#", "_row", "_number").alias("id"),
        F.col("l_suppkey").alias("student_id"),
        F.col("l_orderkey").alias("class_regular_session_id"),
        F.when(F.col("l_returnflag") == "A", REPORT_STATUSES[0])
        .when(F.col("l_returnflag") == "R", REPORT_STATUSES[1])
        .otherwise("BOOKED")
        .alias("status"),
    )
    session, program = sessions(spark, sf_dir), study_programs(spark, sf_dir)
    number = F.col("id").cast("long")
    return {
        "class_regular_session_student": snapshot_feed(
            ENTITIES["class_regular_session_student"], booking, F.expr("xxhash64(id) & 9223372036854775807L")
        ),
        "class_regular_session": snapshot_feed(ENTITIES["class_regular_session"], session, number),
        "study_program": snapshot_feed(ENTITIES["study_program"], program, number),
    }


def session_students(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("student_id"),
        F.col("l_orderkey").alias("class_regular_session_id"),
        F.col("l_returnflag").alias("status"),
    )


def sessions(spark: SparkSession, sf_dir: str, with_grade: bool = False) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("learn_date"),
        F.col("o_custkey").alias("study_program_id"),
    )
    if not with_grade:
        return orders
    nations = table(spark, sf_dir, "customer").select(F.col("c_custkey"), F.col("c_nationkey").alias("grade_id"))
    return orders.join(nations, F.col("study_program_id") == F.col("c_custkey"), "left").drop("c_custkey")


def study_programs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))


def grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id"),
        F.col("n_name").alias("code"),
        F.col("n_nationkey").alias("value"),
    )
