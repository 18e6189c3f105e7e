"""Every operator and job as a query over the sample tables, with its SQL twin.

``@query(sql)`` registers a function (spark, sf_dir) -> DataFrame together with
the SQL that must give the same rows.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline import paths, samples
from oreline.functions import decode_envelope, image_columns, int_date, to_bronze, undecodable, with_event_date
from oreline.operators import (
    drop_deletes,
    duplicate_keys,
    in_window,
    latest_per_key,
    read_changes,
    require_key,
    silver_changes,
    strip_columns,
    upsert,
)
from oreline.plans import (
    build_gold_changes,
    build_gold_report,
    build_silver,
    ingest_bronze,
    register_report_sql,
    student_session_report,
)
from oreline.plans.jobs import read_silver, run_window
from oreline.plans.report import attended, sessions_between
from oreline.sinks import compact, compact_log, lookup, upsert_table, write_table
from oreline.sources import read_table, register_views
from oreline.spec import (
    BATCH,
    ENTITIES,
    EVENT_DATE,
    REPORT_KEYS,
    REPORT_PARTITION,
    VERSION,
    EntitySpec,
    Layout,
    struct,
)
from oreline.streaming import BatchProgress, read_progress, run_until_stopped
from oreline.streaming.bronze import AVAILABLE_NOW

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return register


# --- inputs -------------------------------------------------------------------

_BUILT: dict[tuple, str] = {}


def _once(spark: SparkSession, sf_dir: str, label: str, build: Callable[[str], None]) -> str:
    """Path of a table that several queries read, written by the first of them."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _BUILT or not paths.exists(spark, f"{_BUILT[key]}/_SUCCESS"):
        path = paths.scratch_path(spark, label)
        build(path)
        _BUILT[key] = path
    return _BUILT[key]


def _bronze_path(spark: SparkSession, sf_dir: str, entity: EntitySpec, feed: Callable) -> str:
    def build(path: str) -> None:
        rows = to_bronze(feed(spark, sf_dir), entity).withColumn(BATCH, F.lit("sample-0000000000"))
        write_table(rows.hint("rebalance", EVENT_DATE), path, partition_by=[EVENT_DATE, BATCH])

    return _once(spark, sf_dir, f"bronze-{entity.name}-{entity.before_key}", build)


def _event_log(spark: SparkSession, sf_dir: str, entity: EntitySpec = samples.EVENTS) -> DataFrame:
    path = _bronze_path(spark, sf_dir, entity, samples.event_feed)
    return read_table(spark, path, schema=entity.bronze_schema)


def _order_changes(spark: SparkSession, sf_dir: str, start: str, end: str, **options) -> DataFrame:
    """One merge source: the newest order per customer in a date range.

    Orders span years, a directory per day would be thousands of tiny files, so
    this log stays unpartitioned.
    """
    log = with_event_date(decode_envelope(samples.order_feed(spark, sf_dir), samples.ORDERS.after_schema))
    path = _once(spark, sf_dir, "bronze-orders", lambda p: write_table(log, p))
    return silver_changes(in_window(read_table(spark, path), start, end), samples.ORDERS, **options)


def _event_state(spark: SparkSession, sf_dir: str, start: str, end: str, **options) -> DataFrame:
    entity = samples.EVENTS_WITH_BEFORE if options.get("deletes") == "apply" else samples.EVENTS
    return silver_changes(in_window(_event_log(spark, sf_dir, entity), start, end), entity, **options)


EVENT_COLUMNS = ("id", "event_type", "value", "props")

# The feed and the bronze rows it decodes to, as SQL.
FEED_SQL = """
with bronze as (
  select case event_type when 'error' then 'd' when 'signup' then 'c' else 'u' end as _op,
         epoch_us(ts) // 1000 as _ts_ms,
         'cdc.events' as _kafka_topic,
         cast(event_id % 3 as integer) as _kafka_partition,
         event_id // 3 as _kafka_offset,
         case when event_type <> 'error' then cast(user_id as varchar) end as id,
         case when event_type <> 'error' then event_type end as event_type,
         case when event_type <> 'error' then value end as value,
         case when event_type <> 'error' then props end as props,
         cast(user_id as varchar) as any_id,
         cast(ts as date) as _event_date,
         ts
  from events)
"""


def _newest_sql(where: str) -> str:
    return f"""(
  select * from (
    select *, row_number() over (partition by id order by _ts_ms desc, _kafka_offset desc) as rn
    from bronze where _op <> 'd' and id is not null and {where}) where rn = 1)"""


def _days(start: str, end: str) -> str:
    return f"_event_date between date '{start}' and date '{end}'"


# --- bronze: envelope ------------------------------------------------------------


@query(
    FEED_SQL
    + "select _op, _ts_ms, _kafka_topic, _kafka_partition, _kafka_offset, id, event_type, value, props from bronze"
)
def decode_envelope_star(spark, sf_dir):
    decoded = decode_envelope(samples.event_feed(spark, sf_dir), samples.EVENTS.after_schema)
    return decoded.drop("_kafka_timestamp")


@query(
    FEED_SQL + "select _op, _ts_ms, _kafka_partition, _kafka_offset, id, value from bronze",
    name="decode_envelope",
)
def _decode_envelope(spark, sf_dir):
    decoded = decode_envelope(samples.event_feed(spark, sf_dir), samples.EVENTS.after_schema, columns=["id", "value"])
    return decoded.drop("_kafka_timestamp", "_kafka_topic")


@query(
    """
select case event_type when 'error' then 'd' when 'signup' then 'c' else 'u' end as _op,
       case when event_type = 'error' then cast(user_id as varchar) end as _before_key,
       case when event_type = 'error' then event_type end as before_type,
       case when event_type = 'error' then value end as before_value,
       case when event_type <> 'error' then value end as value
from events"""
)
def decode_before_image(spark, sf_dir):
    decoded = decode_envelope(
        samples.event_feed(spark, sf_dir),
        samples.EVENTS.after_schema,
        columns=["value"],
        before_key="id",
        before_image=True,
    )
    return decoded.select(
        "_op",
        "_before_key",
        F.col("_before.event_type").alias("before_type"),
        F.col("_before.value").alias("before_value"),
        "value",
    )


@query(
    FEED_SQL
    + "select _kafka_topic, _kafka_partition, _kafka_offset, epoch_us(ts) as _kafka_timestamp_us from bronze"
)
def kafka_metadata(spark, sf_dir):
    decoded = decode_envelope(samples.event_feed(spark, sf_dir), samples.EVENTS.after_schema, columns=[], meta=["op"])
    return decoded.select(
        "_kafka_topic",
        "_kafka_partition",
        "_kafka_offset",
        F.unix_micros("_kafka_timestamp").alias("_kafka_timestamp_us"),
    )


@query(FEED_SQL + "select _kafka_partition, _kafka_offset, _event_date from bronze")
def event_date(spark, sf_dir):
    decoded = decode_envelope(samples.event_feed(spark, sf_dir), samples.EVENTS.after_schema, columns=[])
    return with_event_date(decoded).select("_kafka_partition", "_kafka_offset", EVENT_DATE)


@query(
    """
select cast(event_id % 3 as integer) as _kafka_partition, event_id // 3 as _kafka_offset,
       cast(null as varchar) as id, cast(null as date) as _event_date
from events where event_id % 97 in (0, 1)"""
)
def undecodable_rows(spark, sf_dir):
    log = to_bronze(samples.event_feed(spark, sf_dir, broken=True), samples.EVENTS)
    return undecodable(log).select("_kafka_partition", "_kafka_offset", "id", EVENT_DATE)


# --- bronze -> silver ---------------------------------------------------------------

LOG_COLUMNS = ("_op", "_ts_ms", "_kafka_partition", "_kafka_offset", *EVENT_COLUMNS, EVENT_DATE)
LOG_SQL = FEED_SQL + f"select {', '.join(LOG_COLUMNS)} from bronze "


@query(LOG_SQL + f"where {_days('2024-01-10', '2024-01-20')}", name="read_changes")
def _read_changes(spark, sf_dir):
    path = _bronze_path(spark, sf_dir, samples.EVENTS, samples.event_feed)
    changes = read_changes(spark, path, "2024-01-10", "2024-01-20", samples.EVENTS.bronze_schema)
    return changes.select(*LOG_COLUMNS)


@query(LOG_SQL + "where _op <> 'd'", name="drop_deletes")
def _drop_deletes(spark, sf_dir):
    return drop_deletes(_event_log(spark, sf_dir)).select(*LOG_COLUMNS)


@query(LOG_SQL + "where id is not null", name="require_key")
def _require_key(spark, sf_dir):
    return require_key(_event_log(spark, sf_dir), ["id"]).select(*LOG_COLUMNS)


@query(
    FEED_SQL + f"select {', '.join(LOG_COLUMNS)} from {_newest_sql('true')}",
    name="latest_per_key",
)
def _latest_per_key(spark, sf_dir):
    live = require_key(drop_deletes(_event_log(spark, sf_dir)), ["id"])
    return latest_per_key(live, ["id"]).select(*LOG_COLUMNS)


@query(FEED_SQL + "select id, event_type, value, props from bronze")
def strip_metadata(spark, sf_dir):
    return strip_columns(_event_log(spark, sf_dir))


@query(
    FEED_SQL + f"select id, event_type, value, props from {_newest_sql(_days('2024-01-10', '2024-01-20'))}"
)
def silver_source(spark, sf_dir):
    return _event_state(spark, sf_dir, "2024-01-10", "2024-01-20")


@query(
    FEED_SQL
    + """
select id, event_type, value, props from (
  select *, row_number() over (partition by any_id order by _ts_ms desc, _kafka_offset desc) as rn
  from bronze where _event_date between date '2024-01-10' and date '2024-01-20')
where rn = 1 and _op <> 'd'"""
)
def silver_source_apply_deletes(spark, sf_dir):
    newest = _event_state(spark, sf_dir, "2024-01-10", "2024-01-20", deletes="apply")
    return drop_deletes(newest).drop("_op")


# --- upsert ----------------------------------------------------------------------


def _upsert_sql(first: str, second: str, columns: str) -> str:
    """``second`` merged into ``first``."""
    return f"""
select {columns} from {second}
union all
select {columns} from {first} where id not in (select id from {second})"""


EVENT_LIST = ", ".join(EVENT_COLUMNS)
EVENT_HALF_1 = _newest_sql(_days("2024-01-01", "2024-01-15"))
EVENT_HALF_2 = _newest_sql(_days("2024-01-16", "2024-01-31"))


@query(FEED_SQL + _upsert_sql(EVENT_HALF_1, EVENT_HALF_2, EVENT_LIST))
def upsert_update(spark, sf_dir):
    return upsert(
        _event_state(spark, sf_dir, "2024-01-01", "2024-01-15"),
        _event_state(spark, sf_dir, "2024-01-16", "2024-01-31"),
        ["id"],
        null_keys=False,
    )


EVENT_RUN_1 = _newest_sql(_days("2024-01-10", "2024-01-11"))
EVENT_RUN_2 = _newest_sql(_days("2024-01-12", "2024-01-12"))


@query(FEED_SQL + _upsert_sql(EVENT_RUN_1, EVENT_RUN_2, EVENT_LIST))
def upsert_daily_runs(spark, sf_dir):
    return upsert(
        _event_state(spark, sf_dir, "2024-01-10", "2024-01-11"),
        _event_state(spark, sf_dir, "2024-01-12", "2024-01-12"),
        ["id"],
        null_keys=False,
    )


@query(
    FEED_SQL
    + f"""
, newest as (
  select * from (
    select *, row_number() over (partition by any_id order by _ts_ms desc, _kafka_offset desc) as rn
    from bronze where {_days('2024-01-16', '2024-01-31')}) where rn = 1)
select {EVENT_LIST} from newest where _op <> 'd'
union all
select {EVENT_LIST} from {EVENT_HALF_1} where id not in (select any_id from newest)"""
)
def upsert_apply_deletes(spark, sf_dir):
    return upsert(
        _event_state(spark, sf_dir, "2024-01-01", "2024-01-15"),
        _event_state(spark, sf_dir, "2024-01-16", "2024-01-31", deletes="apply"),
        ["id"],
        delete_when=F.col("_op") == "d",
        null_keys=False,
    )


ORDER_LIST = "id, order_id, status, total, priority"
OLD_ORDERS = ("1900-01-01", "1998-06-30")
NEW_ORDERS = ("1998-07-01", "2100-01-01")


def _orders_sql(span: tuple[str, str]) -> str:
    return f"""(
  select cast(o_custkey as varchar) as id, o_orderkey as order_id, o_orderstatus as status,
         o_totalprice as total, o_orderpriority as priority, epoch_us(o_orderdate) // 1000 as _version
  from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn
        from orders where cast(o_orderdate as date) between date '{span[0]}' and date '{span[1]}')
  where rn = 1)"""


@query(_upsert_sql(_orders_sql(OLD_ORDERS), _orders_sql(NEW_ORDERS), ORDER_LIST))
def upsert_insert(spark, sf_dir):
    """Newest order per customer, in two runs: updates, inserts and untouched rows."""
    return upsert(
        _order_changes(spark, sf_dir, *OLD_ORDERS), _order_changes(spark, sf_dir, *NEW_ORDERS), ["id"], null_keys=False
    )


@query(_upsert_sql(_orders_sql(NEW_ORDERS), _orders_sql(OLD_ORDERS), ORDER_LIST))
def late_event_rerun(spark, sf_dir):
    """Re-running an older window puts older images back: there is no version check."""
    return upsert(
        _order_changes(spark, sf_dir, *NEW_ORDERS), _order_changes(spark, sf_dir, *OLD_ORDERS), ["id"], null_keys=False
    )


@query(_upsert_sql(_orders_sql(OLD_ORDERS), _orders_sql(NEW_ORDERS), ORDER_LIST + ", _version"))
def upsert_guarded(spark, sf_dir):
    """The same re-run with a version guard keeps the newer rows."""
    return upsert(
        _order_changes(spark, sf_dir, *NEW_ORDERS, keep_version=True),
        _order_changes(spark, sf_dir, *OLD_ORDERS, keep_version=True),
        ["id"],
        guard=VERSION,
        null_keys=False,
    )


@query(
    f"""
select n.{', n.'.join(ORDER_LIST.split(', '))}, o.total as first_total
from {_orders_sql(NEW_ORDERS)} n left join {_orders_sql(OLD_ORDERS)} o using (id)
union all
select {ORDER_LIST}, total as first_total from {_orders_sql(OLD_ORDERS)}
where id not in (select id from {_orders_sql(NEW_ORDERS)})"""
)
def upsert_keeps_target_columns(spark, sf_dir):
    """A target column the source lacks keeps its value on matched rows."""
    old = _order_changes(spark, sf_dir, *OLD_ORDERS)
    return upsert(
        old.withColumn("first_total", F.col("total")), _order_changes(spark, sf_dir, *NEW_ORDERS), ["id"], null_keys=False
    )


@query(
    f"""
select {ORDER_LIST}, _version from {_orders_sql(NEW_ORDERS)}
union all
select {ORDER_LIST}, cast(null as bigint) as _version from {_orders_sql(OLD_ORDERS)}
where id not in (select id from {_orders_sql(NEW_ORDERS)})"""
)
def upsert_evolve(spark, sf_dir):
    """A source column the target lacks is added; untouched rows have it NULL."""
    return upsert(
        _order_changes(spark, sf_dir, *OLD_ORDERS),
        _order_changes(spark, sf_dir, *NEW_ORDERS, keep_version=True),
        ["id"],
        evolve=True,
        null_keys=False,
    )


# --- gold -------------------------------------------------------------------------

YEAR = ("1996-01-01", "1996-12-31")
JANUARY = ("1996-01-01", "1996-01-31")
FEBRUARY = ("1996-02-01", "1996-02-29")
ALWAYS = ("1900-01-01", "2100-12-31")


def _report(spark, sf_dir, window=YEAR, **options) -> DataFrame:
    return student_session_report(
        samples.session_students(spark, sf_dir),
        samples.sessions(spark, sf_dir, with_grade="grade" in options),
        samples.study_programs(spark, sf_dir),
        *window,
        statuses=samples.STATUSES,
        **options,
    )


def report_of_year(spark, sf_dir) -> DataFrame:
    return _report(spark, sf_dir)


def _report_sql(window, columns="", joins="", where="", lines="lineitem") -> str:
    return f"""(
  select b.learn_date, l_suppkey as student_id, l_orderkey as class_regular_session_id,
         c.c_name as study_program{columns}
  from {lines}
  left join (select o_orderkey, o_custkey, cast(o_orderdate as date) as learn_date from orders
             where cast(o_orderdate as date) between date '{window[0]}' and date '{window[1]}') b
    on b.o_orderkey = l_orderkey
  left join customer c on c.c_custkey = b.o_custkey
  {joins}
  where l_returnflag in ('A', 'R'){where})"""


@query(
    """
select l_suppkey as student_id, l_orderkey as class_regular_session_id, l_returnflag as status
from lineitem where l_returnflag in ('A', 'R')"""
)
def gold_status_filter(spark, sf_dir):
    return attended(samples.session_students(spark, sf_dir), samples.STATUSES)


@query(
    """
select o_orderkey as id, cast(strftime(o_orderdate, '%Y%m%d') as integer) as learn_date,
       cast(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') as date) as learn_day
from orders"""
)
def gold_int_date(spark, sf_dir):
    sessions = samples.sessions(spark, sf_dir)
    return sessions.select("id", "learn_date", int_date(F.col("learn_date")).alias("learn_day"))


@query(
    f"""
select o_orderkey as id, cast(o_orderdate as date) as learn_date, o_custkey as study_program_id
from orders where cast(o_orderdate as date) between date '{YEAR[0]}' and date '{YEAR[1]}'"""
)
def gold_date_range(spark, sf_dir):
    return sessions_between(samples.sessions(spark, sf_dir), *YEAR)


@query(
    f"""
select l_suppkey as student_id, l_orderkey as class_regular_session_id, b.learn_date
from lineitem
left join (select o_orderkey, cast(o_orderdate as date) as learn_date from orders
           where cast(o_orderdate as date) between date '{YEAR[0]}' and date '{YEAR[1]}') b
  on b.o_orderkey = l_orderkey
where l_returnflag in ('A', 'R')"""
)
def gold_left_join_session(spark, sf_dir):
    return _report(spark, sf_dir).select("student_id", "class_regular_session_id", "learn_date")


@query(f"select * from {_report_sql(YEAR)}")
def gold_report(spark, sf_dir):
    return _report(spark, sf_dir)


@query(f"select * from {_report_sql(YEAR, where=' and b.learn_date is not null')}")
def gold_report_where(spark, sf_dir):
    return _report(spark, sf_dir, date_filter="where")


@query(
    "select * from "
    + _report_sql(
        YEAR,
        columns=""", n_name as grade_code,
         case when n_nationkey between 1 and 5 then 'Tiểu học'
              when n_nationkey between 6 and 9 then 'THCS' else 'Others' end as grade_program""",
        joins="left join nation on n_nationkey = c.c_nationkey",
    )
)
def gold_report_with_band(spark, sf_dir):
    return _report(spark, sf_dir, grade=samples.grades(spark, sf_dir))


GOLD_KEYS = (*REPORT_KEYS, REPORT_PARTITION)
GOLD_KEY_LIST = ", ".join(GOLD_KEYS)


@query(
    f"""
select {GOLD_KEY_LIST}, count(*) as copies from {_report_sql(ALWAYS)}
where learn_date is not null group by all having count(*) > 1"""
)
def gold_duplicate_keys(spark, sf_dir):
    return duplicate_keys(_report(spark, sf_dir, ALWAYS), GOLD_KEYS)


def _run_gold(spark, sf_dir, windows, null_safe=False, **options) -> DataFrame:
    path = paths.scratch_path(spark, "gold")
    schema = struct("learn_date date, student_id bigint, class_regular_session_id bigint, study_program string")
    for window in windows:
        upsert_table(
            spark,
            path,
            _report(spark, sf_dir, window, **options),
            REPORT_KEYS,
            match_also=[REPORT_PARTITION],
            partition_by=REPORT_PARTITION,
            schema=schema,
            on_duplicate="keep_any",
            null_safe=null_safe,
        )
    return read_table(spark, path, schema=schema)


@query(
    f"""
select distinct * from {_report_sql(JANUARY, where=' and b.learn_date is not null')}
union all
select distinct * from {_report_sql(FEBRUARY, where=' and b.learn_date is not null')}"""
)
def gold_upsert(spark, sf_dir):
    return _run_gold(spark, sf_dir, [JANUARY, FEBRUARY, JANUARY], date_filter="where")


@query(
    f"""
select distinct * from {_report_sql(JANUARY)} where learn_date is not null
union all
select * from {_report_sql(JANUARY)} where learn_date is null
union all
select * from {_report_sql(JANUARY)} where learn_date is null"""
)
def gold_upsert_null_dates(spark, sf_dir):
    """Two identical runs: one dated row per key, rows without a date as often as they come in each run."""
    return _run_gold(spark, sf_dir, [JANUARY, JANUARY])


@query(f"select distinct * from {_report_sql(JANUARY)}")
def gold_upsert_null_safe(spark, sf_dir):
    return _run_gold(spark, sf_dir, [JANUARY, JANUARY], null_safe=True)


# --- streams, table upkeep, whole jobs ----------------------------------------------

FEED_BATCHES = 3


def _feed(spark, sf_dir) -> tuple[str, int]:
    """A folder of change records, and how many files make a third of it: a file per core, two per batch at least."""
    share = max(2, -(-spark.sparkContext.defaultParallelism // FEED_BATCHES))
    files = FEED_BATCHES * share

    def build(path: str) -> None:
        samples.event_feed(spark, sf_dir).repartitionByRange(files, "timestamp").write.parquet(path)

    return _once(spark, sf_dir, "feed-events", build), share


def _ingest(spark, layout: Layout, feed: str, entity: EntitySpec = samples.EVENTS, trigger=AVAILABLE_NOW, **options):
    return ingest_bronze(spark, entity, layout, trigger=trigger, source_fmt="parquet", source_path=feed, **options)


def _landed(spark, sf_dir, runs: int = 1) -> tuple[Layout, list]:
    """A lakehouse whose bronze log was filled by ``runs`` runs of the stream."""
    feed, share = _feed(spark, sf_dir)
    layout = Layout(paths.scratch_path(spark, "lake"))
    streams = []
    for _ in range(runs):
        streams.append(_ingest(spark, layout, feed, files_per_trigger=share))
        run_until_stopped(streams[-1])
    return layout, streams


def _landed_log(spark, layout: Layout) -> DataFrame:
    log = read_table(spark, layout.bronze_path(samples.EVENTS), schema=samples.EVENTS.bronze_schema)
    return log.select(*LOG_COLUMNS)


@query(LOG_SQL)
def stream_bronze_append(spark, sf_dir):
    layout, _ = _landed(spark, sf_dir)
    return _landed_log(spark, layout)


@query(LOG_SQL)
def stream_resume(spark, sf_dir):
    """The second run starts after the last committed batch and adds nothing."""
    layout, _ = _landed(spark, sf_dir, runs=2)
    return _landed_log(spark, layout)


@query(
    FEED_SQL
    + "select _event_date, count(*) as events, cast(3 as integer) as batches from bronze group by _event_date"
)
def stream_rate_limit(spark, sf_dir):
    """A third of the files per batch: taken in by three batches, as the listener's table has them."""
    feed, share = _feed(spark, sf_dir)
    layout, told = Layout(paths.scratch_path(spark, "lake")), paths.scratch_path(spark, "progress")
    with BatchProgress(spark, told) as progress:
        stream = _ingest(spark, layout, feed, files_per_trigger=share)
        run_until_stopped(stream)
        progress.wait(stream)
    batches = read_progress(spark, told).filter(F.col("id") == str(stream.id)).agg(F.count(F.lit(1)).cast("int").alias("batches"))
    counted = _landed_log(spark, layout).groupBy(EVENT_DATE).agg(F.count(F.lit(1)).alias("events"))
    return counted.crossJoin(F.broadcast(batches))


@query(
    """
select 1 as run, 3 as batches, count(*) as input_rows from events
union all
select 2, 1, count(*) from events where event_id % 3 = 0"""
)
def stream_progress(spark, sf_dir):
    """What two runs of a stream took in, batch by batch, after both have ended: more records came in between."""
    shared, share = _feed(spark, sf_dir)
    feed, told = paths.scratch_path(spark, "feed"), paths.scratch_path(spark, "progress")
    layout = Layout(paths.scratch_path(spark, "lake"))
    write_table(spark.read.parquet(shared).repartitionByRange(FEED_BATCHES * share, "timestamp"), feed)
    runs = []
    with BatchProgress(spark, told, every=2) as progress:
        for limit in (share, None):
            stream = _ingest(spark, layout, feed, files_per_trigger=limit)
            run_until_stopped(stream)
            progress.wait(stream)
            runs.append(str(stream.runId))
            write_table(spark.read.parquet(shared).filter("partition = 0"), feed)
    number = F.when(F.col("run_id") == runs[0], 1).when(F.col("run_id") == runs[1], 2)
    counted = read_progress(spark, told).groupBy(number.alias("run"))
    return counted.agg(F.count(F.lit(1)).cast("int").alias("batches"), F.sum("input_rows").alias("input_rows")).filter("run is not null")


@query(FEED_SQL + "select _op, _kafka_partition, _kafka_offset, id, event_type, value, props from bronze")
def decode_variant(spark, sf_dir):
    """Only the key is declared: the rest of the image is landed all the same, and read from the stored log."""
    entity = EntitySpec(samples.EVENTS.name, "id string", image=True)
    feed, share = _feed(spark, sf_dir)
    layout = Layout(paths.scratch_path(spark, "lake"))
    run_until_stopped(_ingest(spark, layout, feed, entity, files_per_trigger=share))
    log = read_table(spark, layout.bronze_path(entity), schema=entity.bronze_schema)
    found = image_columns(log, struct("event_type string, value double, props string"))
    return found.select("_op", "_kafka_partition", "_kafka_offset", *EVENT_COLUMNS)


@query(LOG_SQL)
def stream_redelivery(spark, sf_dir):
    """The source delivers records again, in the same batch, in later ones and after a restart: each is landed once."""
    records = samples.event_feed(spark, sf_dir)
    early = F.col("timestamp") < F.lit("2024-01-16").cast("timestamp")
    feed, layout = paths.scratch_path(spark, "feed"), Layout(paths.scratch_path(spark, "lake"))
    again = records.filter(F.col("offset") % 3 == 0)
    for part in (records.filter(early).unionByName(again.filter(early)), records):
        for half in (F.col("partition") == 0, F.col("partition") > 0):
            write_table(part.filter(half).unionByName(again.filter(early)), feed)
        run_until_stopped(_ingest(spark, layout, feed, files_per_trigger=4, redelivery="1 hour"))
    return _landed_log(spark, layout)


@query(LOG_SQL)
def compact_preserves_rows(spark, sf_dir):
    layout, _ = _landed(spark, sf_dir)
    path = layout.bronze_path(samples.EVENTS)
    compact_log(spark, path, samples.EVENTS, "2024-01-01", "2024-01-31")
    month = F.col(EVENT_DATE).between(F.to_date(F.lit("2024-01-01")), F.to_date(F.lit("2024-01-31")))
    compact(spark, path, [EVENT_DATE, BATCH], month)
    return _landed_log(spark, layout)


@query(
    """
select event_id, event_type, value, case when ts >= timestamp '2024-01-16' then props end as props
from events"""
)
def schema_evolution_append(spark, sf_dir):
    """A column that appears later is NULL in the rows written before."""
    path = paths.scratch_path(spark, "evolving")
    events = samples.table(spark, sf_dir, "events")
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    write_table(events.filter(~late).select("event_id", "event_type", "value"), path)
    write_table(events.filter(late).select("event_id", "event_type", "value", "props"), path)
    return read_table(spark, path, merge_schema=True).select("event_id", "event_type", "value", "props")


@query("select 1 as run, count(*) as row_count, 3 as batches from events union all select 2, 0, 1")
def batch_counts(spark, sf_dir):
    """Rows of each batch as the append counts them while it writes; then an empty file, an empty batch."""
    shared, share = _feed(spark, sf_dir)
    feed = paths.scratch_path(spark, "feed")
    write_table(spark.read.parquet(shared).repartitionByRange(FEED_BATCHES * share, "timestamp"), feed)
    layout = Layout(paths.scratch_path(spark, "lake"))
    counts: list[tuple[int, int]] = []
    for run in (1, 2):
        stream = _ingest(
            spark, layout, feed, files_per_trigger=share, on_batch=lambda _, rows, run=run: counts.append((run, rows))
        )
        run_until_stopped(stream)
        write_table(spark.read.parquet(shared).limit(0), feed)
    told = spark.createDataFrame(counts, "run int, rows long")
    return told.groupBy("run").agg(F.sum("rows").alias("row_count"), F.count(F.lit(1)).cast("int").alias("batches"))


@query(LOG_SQL)
def replayed_batch(spark, sf_dir):
    """The last batch is taken in again, as after a crash between its write and its commit."""
    layout, (stream,) = _landed(spark, sf_dir)
    last = max(p["batchId"] for p in stream.recentProgress if p["numInputRows"] > 0)
    paths.delete(spark, f"{layout.checkpoint_path(samples.EVENTS)}/commits/{last}")
    feed, share = _feed(spark, sf_dir)
    run_until_stopped(_ingest(spark, layout, feed, files_per_trigger=share))
    return _landed_log(spark, layout)


@query(
    """
select true as waiting, true as stopped, count(*) as row_count from events"""
)
def stream_interval(spark, sf_dir):
    """An interval trigger keeps the stream waiting for more until it is stopped."""
    feed, _ = _feed(spark, sf_dir)
    layout = Layout(paths.scratch_path(spark, "lake"))
    stream = _ingest(spark, layout, feed, trigger="1 second")
    stream.processAllAvailable()
    waiting = not run_until_stopped(stream, timeout=1)
    stream.stop()
    counted = _landed_log(spark, layout).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(F.lit(waiting).alias("waiting"), F.lit(not stream.isActive).alias("stopped"), "row_count")


@query(
    FEED_SQL
    + f"""
select id, event_type, value, case when ts >= timestamp '2024-01-16' then props end as props
from {_newest_sql(_days('2024-01-01', '2024-01-31'))}"""
)
def evolving_append(spark, sf_dir):
    """The entity gains a column between two runs of the stream; silver has it NULL in rows landed before."""
    records = samples.event_feed(spark, sf_dir)
    late = F.col("timestamp") >= F.lit("2024-01-16").cast("timestamp")
    feed, layout = paths.scratch_path(spark, "feed"), Layout(paths.scratch_path(spark, "lake"))
    before = EntitySpec(samples.EVENTS.name, "id string, event_type string, value double")
    for entity, part in ((before, ~late), (samples.EVENTS, late)):
        write_table(records.filter(part), feed)
        run_until_stopped(_ingest(spark, layout, feed, entity))
    build_silver(spark, samples.EVENTS, layout, "2024-01-01", "2024-01-31")
    return read_silver(spark, samples.EVENTS, layout).drop("_silver_updated_at")


@query("select count(*) as row_count, true as within_limit, true as gzipped from events")
def writer_settings(spark, sf_dir):
    """Compression and the limit of rows per file, as the files show them."""
    path = paths.scratch_path(spark, "settings")
    write_table(samples.table(spark, sf_dir, "events"), path, compression="gzip", max_records_per_file=1000)
    files = read_table(spark, path).groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    return files.agg(
        F.sum("rows").alias("row_count"),
        F.bool_and(F.col("rows") <= 1000).alias("within_limit"),
        F.bool_and(F.col("file").endswith(".gz.parquet")).alias("gzipped"),
    )


@query(FEED_SQL + _upsert_sql(EVENT_HALF_1, EVENT_HALF_2, EVENT_LIST))
def silver_job(spark, sf_dir):
    """Stream -> bronze -> silver, the silver job run once per half of the month."""
    layout, _ = _landed(spark, sf_dir)
    build_silver(spark, samples.EVENTS, layout, "2024-01-01", "2024-01-15")
    build_silver(spark, samples.EVENTS, layout, "2024-01-16", "2024-01-31")
    return read_silver(spark, samples.EVENTS, layout).drop("_silver_updated_at")


LAST_ORDERS = ("2001-08-01", "2100-01-01")


def _files(spark, path: str) -> set[str]:
    """Folder and name of every file that holds rows of a table."""
    files = read_table(spark, path).select(F.col("_metadata.file_path").alias("file")).distinct()
    return {"/".join(row["file"].rsplit("/", 2)[1:]) for row in files.collect()}


@query(_upsert_sql(_orders_sql(OLD_ORDERS), _orders_sql(LAST_ORDERS), f"{ORDER_LIST}, true as others_stay, true as touched_go"))
def silver_touched_only(spark, sf_dir):
    """A merge of few keys replaces the folders these keys belong to; all other files stay, by name."""
    path = paths.scratch_path(spark, "dealt")
    upsert_table(spark, path, _order_changes(spark, sf_dir, *OLD_ORDERS), ["id"], parts=64)
    before = _files(spark, path)
    few = _order_changes(spark, sf_dir, *LAST_ORDERS)
    upsert_table(spark, path, few, ["id"])
    after = _files(spark, path)
    parts = few.select(F.pmod(F.xxhash64("id"), F.lit(64)).alias("part")).distinct().collect()
    touched = {f"_key_of_64={row['part']}" for row in parts}
    stayed = {f for f in before if f.split("/")[0] not in touched}
    return read_table(spark, path).select(
        "*",
        F.lit(stayed == {f for f in after if f.split("/")[0] not in touched}).alias("others_stay"),
        F.lit(not (before - stayed) & after).alias("touched_go"),
    )


@query(f"select {ORDER_LIST} from {_orders_sql(OLD_ORDERS)} where id in (select id from {_orders_sql(LAST_ORDERS)})")
def bloom_lookup(spark, sf_dir):
    """The rows of a few keys (customers of the last days) by the folders, file order and Bloom filters of the key."""
    path = paths.scratch_path(spark, "dealt")
    upsert_table(spark, path, _order_changes(spark, sf_dir, *OLD_ORDERS), ["id"], parts=64)
    few = [row["id"] for row in _order_changes(spark, sf_dir, *LAST_ORDERS).select("id").collect()]
    return lookup(spark, path, "id", few, samples.ORDERS.after_schema)


def _late_feed(spark, sf_dir, late: Column, entity: EntitySpec, **options) -> tuple[Layout, list[int]]:
    """A lakehouse whose records arrive in two runs of the stream, the ``late`` ones in the second; silver takes
    what it has not seen after each, and once more. With how many keys each run merged."""
    records = samples.event_feed(spark, sf_dir)
    feed, layout = paths.scratch_path(spark, "feed"), Layout(paths.scratch_path(spark, "lake"))
    merged = []
    for part in (~late, late):
        write_table(records.filter(part), feed)
        run_until_stopped(_ingest(spark, layout, feed, entity))
        merged.append(build_silver(spark, entity, layout, guard=True, unseen=True, **options))
    merged.append(build_silver(spark, entity, layout, guard=True, unseen=True, **options))
    return layout, merged


@query(FEED_SQL + f"select {EVENT_LIST}, _ts_ms as _version, 0 as merged_again from {_newest_sql('true')}")
def silver_late_batch(spark, sf_dir):
    """Records of earlier dates land in a later batch: the run takes that batch, without being told its dates."""
    late = (F.col("offset") % 5 == 0) & (F.col("timestamp") < F.lit("2024-01-20").cast("timestamp"))
    layout, merged = _late_feed(spark, sf_dir, late, samples.EVENTS)
    state = read_table(spark, layout.silver_path(samples.EVENTS), merge_schema=True).drop("_silver_updated_at")
    return state.withColumn("merged_again", F.lit(merged[-1]))


@query(
    FEED_SQL
    + f"""
select {EVENT_LIST} from (
  select *, row_number() over (partition by any_id order by _ts_ms desc, _kafka_offset desc) as rn from bronze)
where rn = 1 and _op <> 'd'"""
)
def delete_then_old_event(spark, sf_dir):
    """Events that are older than the delete of their key arrive after it: the key stays away."""
    layout, _ = _late_feed(
        spark, sf_dir, F.col("offset") % 2 == 0, samples.EVENTS_WITH_BEFORE, deletes="apply"
    )
    return read_silver(spark, samples.EVENTS_WITH_BEFORE, layout).drop("_silver_updated_at")


@query(FEED_SQL + f"select {EVENT_LIST}, _ts_ms as _version from {_newest_sql(_days('2024-01-01', '2024-01-31'))}")
def silver_guard_then_plain(spark, sf_dir):
    """A plain run keeps the versions of a guarded one, so a guarded re-run of older days changes nothing."""
    layout, _ = _landed(spark, sf_dir)
    build_silver(spark, samples.EVENTS, layout, "2024-01-01", "2024-01-15", guard=True)
    build_silver(spark, samples.EVENTS, layout, "2024-01-16", "2024-01-31")
    build_silver(spark, samples.EVENTS, layout, "2024-01-01", "2024-01-15", guard=True)
    return read_table(spark, layout.silver_path(samples.EVENTS)).drop("_silver_updated_at")


@query(
    FEED_SQL
    + f"""
select id, case when b.id is null then a.event_type else b.event_type end as event_type,
       case when b.id is null then a.value else b.value end as value,
       case when b.id is null then a.props else b.props end as props, a.event_type as note
from {EVENT_HALF_1} a full join {EVENT_HALF_2} b using (id)"""
)
def silver_evolved_column_kept(spark, sf_dir):
    """A column that one merge added survives merges that only declare the others."""
    path = paths.scratch_path(spark, "evolved")
    declared = struct("id string, event_type string, value double, props string")
    first = _event_state(spark, sf_dir, "2024-01-01", "2024-01-15").select(*EVENT_COLUMNS)
    upsert_table(spark, path, first, ["id"], schema=declared)
    upsert_table(spark, path, first.withColumn("note", F.col("event_type")), ["id"], evolve=True)
    second = _event_state(spark, sf_dir, "2024-01-16", "2024-01-31").select(*EVENT_COLUMNS)
    upsert_table(spark, path, second, ["id"], schema=declared)
    return read_table(spark, path)


@query(
    FEED_SQL
    + f"""
select 1 as run, count(*) as merged from {EVENT_HALF_1} union all
select 2, count(*) from {EVENT_HALF_2} union all
select 3, 0"""
)
def merge_counts(spark, sf_dir):
    """What the silver job says it merged; a window without events merges nothing and changes nothing."""
    layout, _ = _landed(spark, sf_dir)
    windows = [("2024-01-01", "2024-01-15"), ("2024-01-16", "2024-01-31"), ("1999-01-01", "1999-01-02")]
    counts = [(i, build_silver(spark, samples.EVENTS, layout, *w)) for i, w in enumerate(windows, 1)]
    return spark.createDataFrame(counts, "run int, merged long")


@query(FEED_SQL + f"select event_type, count(*) as events from {EVENT_HALF_1} group by event_type")
def empty_window_changes_nothing(spark, sf_dir):
    layout, _ = _landed(spark, sf_dir)
    build_silver(spark, samples.EVENTS, layout, "2024-01-01", "2024-01-15")
    build_silver(spark, samples.EVENTS, layout, "1999-01-01", "1999-01-02")
    state = read_silver(spark, samples.EVENTS, layout)
    return state.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


@query(FEED_SQL + f"select {EVENT_LIST} from {_newest_sql(_days('2024-01-15', '2024-01-16'))}")
def default_window(spark, sf_dir):
    """Without dates a run takes yesterday and today."""
    layout, _ = _landed(spark, sf_dir)
    build_silver(spark, samples.EVENTS, layout, *run_window(today=dt.date(2024, 1, 16)))
    return read_silver(spark, samples.EVENTS, layout).drop("_silver_updated_at")


@query(
    FEED_SQL
    + f"""
select 'bronze' as layer, 3 as stamps, count(*) as row_count from bronze union all
select 'silver', cast(count(distinct fresh) as integer), count(*) from (
  select id, true as fresh from {EVENT_RUN_2} union all
  select id, false from {EVENT_RUN_1} where id not in (select id from {EVENT_RUN_2}))"""
)
def stamped_once(spark, sf_dir):
    """Every batch and every run stamps its rows with one time; rows that a merge leaves alone keep theirs."""
    layout, _ = _landed(spark, sf_dir)
    for window in (("2024-01-10", "2024-01-11"), ("2024-01-12", "2024-01-12")):
        build_silver(spark, samples.EVENTS, layout, *window)
    log = read_table(spark, layout.bronze_path(samples.EVENTS), schema=samples.EVENTS.bronze_schema)
    stamped = {
        "bronze": log.select(F.col("_ingested_at").alias("stamp")),
        "silver": read_silver(spark, samples.EVENTS, layout).select(F.col("_silver_updated_at").alias("stamp")),
    }
    counts = [
        df.where("stamp <= current_timestamp()")
        .agg(F.count_distinct("stamp").cast("int").alias("stamps"), F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("layer"), "stamps", "row_count")
        for name, df in stamped.items()
    ]
    return counts[0].unionByName(counts[1])


@query(
    FEED_SQL
    + f"""
select {EVENT_LIST}, 'Silver current state: events' as description, true as external from {EVENT_HALF_1}"""
)
def catalog_round_trip(spark, sf_dir):
    """The silver job registers its table; rows, kind and properties are read back by name.

    Spark does not keep NOT NULL for Parquet tables: ``not_null_violation`` shows what holds it.
    """
    landed, _ = _landed(spark, sf_dir)
    layout = Layout(landed.root, table_prefix=f"t{uuid.uuid4().hex}_")
    build_silver(spark, samples.EVENTS, layout, "2024-01-01", "2024-01-15", register=True)
    name = layout.silver_table(samples.EVENTS).qualified
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    external = spark.catalog.getTable(name).tableType == "EXTERNAL"
    state = spark.table(name).select(
        *EVENT_COLUMNS,
        F.lit(properties.get("description")).alias("description"),
        F.lit(external).alias("external"),
    )
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return state


def _refused_merge(spark, sf_dir, source: DataFrame, reason: str) -> DataFrame:
    """State of a table after a merge that must fail, and whether it failed for the given reason."""
    path = paths.scratch_path(spark, "refused")
    schema = struct(samples.EVENTS.columns)
    first = _event_state(spark, sf_dir, "2024-01-01", "2024-01-15").select(*EVENT_COLUMNS)
    upsert_table(spark, path, first, ["id"], schema=schema, not_null=["id"])
    refused = False
    try:
        upsert_table(spark, path, source.select(*EVENT_COLUMNS), ["id"], schema=schema, not_null=["id"])
    except PySparkException as error:
        refused = reason in str(error)
    return read_table(spark, path, schema=schema).withColumn("refused", F.lit(refused))


@query(FEED_SQL + f"select {EVENT_LIST}, true as refused from {EVENT_HALF_1}")
def not_null_violation(spark, sf_dir):
    """Delete events have no key in their image: merging them whole is refused and changes nothing."""
    deletes = _event_log(spark, sf_dir).where("_op = 'd'")
    return _refused_merge(spark, sf_dir, deletes, "NULL in NOT NULL column id")


@query(FEED_SQL + f"select {EVENT_LIST}, true as refused from {EVENT_HALF_1}")
def ambiguous_match(spark, sf_dir):
    """The log itself has many rows per key: merging it unreduced is refused and changes nothing."""
    live = require_key(drop_deletes(_event_log(spark, sf_dir)), ["id"])
    return _refused_merge(spark, sf_dir, live, "several source rows match the same target row")


def _merge_sessions(spark, layout: Layout, rows: DataFrame) -> None:
    session = ENTITIES["class_regular_session"]
    stamped = rows.withColumn("_silver_updated_at", F.current_timestamp())
    upsert_table(spark, layout.silver_path(session), stamped, ["id"], schema=session.silver_schema, on_duplicate="trust")


def _silver_star(spark, sf_dir) -> Layout:
    """The report's three silver tables, with the declared schemas. Sessions are merged, so that they can be merged into."""
    layout = Layout(paths.scratch_path(spark, "star"))
    inputs = {
        "class_regular_session_student": samples.session_students(spark, sf_dir),
        "class_regular_session": samples.sessions(spark, sf_dir),
        "study_program": samples.study_programs(spark, sf_dir),
    }
    for name, df in inputs.items():
        entity = ENTITIES[name]
        columns = [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in entity.silver_schema.fields
        ]
        if name == "class_regular_session":
            _merge_sessions(spark, layout, df.select(*columns))
        else:
            stamped = df.select(*columns).withColumn("_silver_updated_at", F.current_timestamp())
            write_table(stamped, layout.silver_path(entity))
    return layout


@query(
    f"""
select learn_date, student_id, cast(class_regular_session_id as varchar) as class_regular_session_id, study_program
from (select * from {_report_sql(JANUARY)}
      union all
      select * from {_report_sql(FEBRUARY)})"""
)
def gold_job(spark, sf_dir):
    """The gold job run for two months over stored silver tables."""
    layout = _silver_star(spark, sf_dir)
    for window in (JANUARY, FEBRUARY):
        build_gold_report(spark, layout, *window, statuses=samples.STATUSES)
    table = layout.report_table()
    return read_table(spark, table.path, schema=table.schema).drop("_gold_updated_at")


@query(
    f"""
with moved as (
  select o_orderkey, o_custkey, cast(o_orderdate as date) as old_date,
         cast(o_orderdate as date) + case when cast(o_orderdate as date) between date '{JANUARY[0]}' and date '{JANUARY[1]}' then 31 else 0 end as learn_date
  from orders),
reached as (select distinct learn_date from moved where learn_date <> old_date)
select learn_date, l_suppkey as student_id, cast(l_orderkey as varchar) as class_regular_session_id, c_name as study_program
from lineitem join moved on o_orderkey = l_orderkey left join customer on c_custkey = o_custkey
where l_returnflag in ('A', 'R') and learn_date in (select learn_date from reached)"""
)
def gold_after_move(spark, sf_dir):
    """January's sessions are moved by a month after its report was made: their rows move, and none is left behind."""
    layout = _silver_star(spark, sf_dir)
    build_gold_report(spark, layout, *JANUARY, date_filter="where", statuses=samples.STATUSES)
    build_gold_changes(spark, layout, adopt=True)
    session = ENTITIES["class_regular_session"]
    silver = read_silver(spark, session, layout)
    moved = sessions_between(silver, *JANUARY).withColumn(
        "learn_date", F.date_format(F.date_add("learn_date", 31), "yyyyMMdd").cast("int")
    )
    _merge_sessions(spark, layout, moved)
    build_gold_changes(spark, layout, statuses=samples.STATUSES)
    table = layout.report_table()
    return read_table(spark, table.path, schema=table.schema).drop("_gold_updated_at")


@query(
    f"""
select learn_date, student_id, cast(class_regular_session_id as varchar) as class_regular_session_id, study_program
from {_report_sql(JANUARY)}"""
)
def snapshot_to_report(spark, sf_dir):
    """All three jobs on the declared entities: their initial snapshots arrive as
    streams and end up in the report of a month."""
    layout = Layout(paths.scratch_path(spark, "lake"))
    for name, feed in samples.report_snapshots(spark, sf_dir).items():
        topic = paths.scratch_path(spark, f"topic-{name}")
        write_table(feed, topic)
        entity = ENTITIES[name]
        run_until_stopped(
            ingest_bronze(
                spark, entity, layout, trigger=AVAILABLE_NOW, source_fmt="parquet", source_path=topic, rebalance=False
            )
        )
        build_silver(spark, entity, layout, "2024-01-01", "2024-01-01")
    build_gold_report(spark, layout, *JANUARY)
    table = layout.report_table()
    return read_table(spark, table.path, schema=table.schema).drop("_gold_updated_at")


@query(
    f"""
select 'window' as part, learn_date, student_id, cast(class_regular_session_id as varchar) as class_regular_session_id, study_program
from {_report_sql(JANUARY)}
union all
select 'dated', learn_date, student_id, cast(class_regular_session_id as varchar), study_program
from {_report_sql(ALWAYS)} where learn_date is not null"""
)
def report_function(spark, sf_dir):
    """The report of a window through its table function, and all its dates through the permanent view."""
    layout = Layout(_silver_star(spark, sf_dir).root, table_prefix=f"r{uuid.uuid4().hex}_")
    function, view = register_report_sql(spark, layout, samples.STATUSES)
    database = spark.catalog.currentDatabase()
    spark.sql("USE gold")
    report = spark.sql(
        f"SELECT 'window' AS part, * FROM {function}(DATE'{JANUARY[0]}', DATE'{JANUARY[1]}') "
        f"UNION ALL SELECT 'dated', * FROM {view}"
    )
    spark.sql(f"USE {database}")
    return report


@query(
    FEED_SQL
    + f"""
select 'bronze' as layer, count(*) as row_count from bronze
union all
select 'silver', count(*) from {_newest_sql('true')}
union all
select 'gold', count(*) from {_report_sql(YEAR)}"""
)
def row_counts(spark, sf_dir):
    log = _event_log(spark, sf_dir)
    layers = {"bronze": log, "silver": silver_changes(log, samples.EVENTS), "gold": _report(spark, sf_dir)}
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        for name, df in layers.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


LAYER_SQL = """
select s.event_type, count(*) as visits, count(distinct s.id) as users,
       round(sum(s.value), 2) as total, min(g.learn_date) as first_date
from {silver} s
left join {gold} g on cast(g.student_id as {text}) = s.id
group by s.event_type"""


@query(
    FEED_SQL
    + LAYER_SQL.format(
        silver=_newest_sql("true"),
        gold=f"(select * from {_report_sql(ALWAYS)} where learn_date is not null)",
        text="varchar",
    )
)
def sql_over_layers(spark, sf_dir):
    """Plain SQL over the layers by name."""
    register_views(
        spark,
        {
            "silver_events": silver_changes(_event_log(spark, sf_dir), samples.EVENTS),
            "gold_report_view": _report(spark, sf_dir, ALWAYS, date_filter="where"),
        },
    )
    return spark.sql(LAYER_SQL.format(silver="silver_events", gold="gold_report_view", text="string"))
