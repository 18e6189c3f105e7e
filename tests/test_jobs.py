import datetime as dt
import json
import os

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from oreline import paths
from oreline.__main__ import parse_args, run_job
from oreline.functions import image_columns, to_bronze
from oreline.plans import (
    build_gold_changes,
    build_gold_report,
    build_silver,
    ingest_bronze,
    register_report_sql,
    run_window,
    student_session_report,
)
from oreline.plans.jobs import read_silver
from oreline.plans.removed import remember_removed
from oreline.plans.report import sessions_between
from oreline.sinks import compact_log, ensure_table, tables
from oreline.sources import read_cdc_stream, read_table
from oreline.sources.streams import kafka_options
from oreline.spec import BATCH, ENTITIES, STREAM_RECORD, EntitySpec, Layout, struct
from oreline.streaming import BatchProgress, append_bronze, read_progress, run_until_stopped

THING = EntitySpec("thing", "id string, n int", before_key=True)
DAY = 86_400_000
DAY_0 = 1_704_067_200_000  # 2024-01-01
APRIL_2 = dt.date(2026, 4, 2)


def message(op, day, key, n=None, spec_key="after"):
    image = {"id": key, "n": n}
    payload = {"op": op, "ts_ms": DAY_0 + day * DAY, "after": None if op == "d" else image, "before": image if op == "d" else None}
    return json.dumps({"payload": payload})


class Topic:
    """A folder of record files, one file per ``send``."""

    def __init__(self, spark, path, topic="cdc.thing"):
        self.spark, self.path, self.topic, self.sent = spark, str(path), topic, 0

    def send(self, *values):
        rows = [(self.topic, 0, self.sent + i, dt.datetime(2024, 1, 1), v) for i, v in enumerate(values)]
        self.sent += len(rows)
        self.spark.createDataFrame(rows, STREAM_RECORD).coalesce(1).write.mode("append").parquet(self.path)


@pytest.fixture
def lake(spark, tmp_path):
    return Layout(str(tmp_path / "lake"))


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


def ingest(spark, lake, topic, entity=THING, **options):
    query = ingest_bronze(
        spark, entity, lake, trigger="available_now", source_fmt="parquet", source_path=topic.path, **options
    )
    assert run_until_stopped(query)
    return query


def bronze(spark, lake, entity=THING):
    return read_table(spark, lake.bronze_path(entity), schema=entity.bronze_schema)


def test_run_window():
    today = dt.date(2026, 4, 3)
    assert run_window(today=today) == (dt.date(2026, 4, 2), today)
    assert run_window("2026-01-01", today=today) == (dt.date(2026, 1, 1), today)
    assert run_window("2026-01-01", "2026-01-31") == (dt.date(2026, 1, 1), dt.date(2026, 1, 31))
    with pytest.raises(ValueError):
        run_window("2026-02-01", "2026-01-31")


def test_stream_appends_and_resumes(spark, lake, topic):
    topic.send(message("c", 0, "a", 1), message("c", 1, "b", 2), "garbage", None)
    ingest(spark, lake, topic)
    assert rows_of(bronze(spark, lake), "id", "_op") == sorted([("a", "c"), ("b", "c"), (None, None), (None, None)], key=repr)
    days = {d for d in paths.child_dirs(spark, lake.bronze_path(THING))}
    assert days == {"_event_date=2024-01-01", "_event_date=2024-01-02", "_event_date=__HIVE_DEFAULT_PARTITION__"}

    ingest(spark, lake, topic)
    assert bronze(spark, lake).count() == 4
    topic.send(message("u", 0, "a", 3))
    ingest(spark, lake, topic)
    assert rows_of(bronze(spark, lake).filter("id = 'a'"), "n") == [(1,), (3,)]


@pytest.mark.parametrize("rebalance", [True, False])
def test_interval_trigger_keeps_running(spark, lake, topic, rebalance):
    topic.send(message("c", 0, "a", 1))
    stream = to_bronze(read_cdc_stream(spark, THING, "parquet", topic.path), THING)
    query = append_bronze(
        stream,
        lake.bronze_path(THING),
        lake.checkpoint_path(THING),
        trigger="1 seconds",
        name=f"interval_{rebalance}",
        rebalance=rebalance,
    )
    try:
        query.processAllAvailable()
        topic.send(message("c", 0, "b", 2))
        query.processAllAvailable()
        assert not run_until_stopped(query, timeout=1)
    finally:
        query.stop()
    assert run_until_stopped(query)
    assert rows_of(bronze(spark, lake), "id") == [("a",), ("b",)]


def test_replayed_batch_is_not_appended_twice(spark, lake, topic):
    topic.send(message("c", 0, "a", 1))
    topic.send(message("c", 0, "b", 2))
    ingest(spark, lake, topic, files_per_trigger=1)
    checkpoint = lake.checkpoint_path(THING)
    last = max(int(f) for f in os.listdir(f"{checkpoint}/commits") if f.isdigit())
    # As after a crash between the write and the commit of the last batch.
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{checkpoint}/commits/{name}"):
            os.remove(f"{checkpoint}/commits/{name}")
    ingest(spark, lake, topic, files_per_trigger=1)
    assert rows_of(bronze(spark, lake), "id") == [("a",), ("b",)]


def test_new_checkpoint_does_not_overwrite_earlier_batches(spark, lake, topic, tmp_path):
    topic.send(message("c", 0, "a", 1))
    ingest(spark, lake, topic)
    other = Topic(spark, tmp_path / "other")
    other.send(message("c", 0, "b", 2))
    stream = to_bronze(read_cdc_stream(spark, THING, "parquet", other.path), THING)
    run_until_stopped(append_bronze(stream, lake.bronze_path(THING), str(tmp_path / "ck"), trigger="available_now"))
    assert rows_of(bronze(spark, lake), "id") == [("a",), ("b",)]


def test_corrupt_event_times_do_not_break_later_jobs(spark, lake, topic):
    micros = json.dumps({"payload": {"op": "c", "ts_ms": DAY_0 * 1000, "after": {"id": "far"}}})
    negative = json.dumps({"payload": {"op": "c", "ts_ms": -(2**62), "after": {"id": "none"}}})
    topic.send(message("c", 0, "a", 1), micros, negative)
    topic.send(message("c", 0, "b", 1))
    topic.send(message("c", 0, "c", 1))
    ingest(spark, lake, topic, files_per_trigger=1)
    assert bronze(spark, lake).count() == 5
    assert build_silver(spark, THING, lake, "2024-01-01", "2024-01-02") == 3
    assert compact_log(spark, lake.bronze_path(THING), THING, "2024-01-01", "2024-01-02") == 2
    assert rows_of(bronze(spark, lake), "id") == [("a",), ("b",), ("c",), ("far",), ("none",)]


def test_rate_limit(spark, lake, topic):
    for i in range(5):
        topic.send(message("c", 0, f"k{i}", i))
    query = ingest(spark, lake, topic, files_per_trigger=2)
    sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert sizes == [2, 2, 1]


def test_progress_of_more_batches_than_a_query_remembers(spark, lake, tmp_path):
    """A hundred is all that recentProgress keeps."""
    topic, told = tmp_path / "many", str(tmp_path / "progress")
    rows = [("cdc.thing", 0, i, dt.datetime(2024, 1, 1), message("c", 0, f"k{i}", i)) for i in range(110)]
    spark.createDataFrame(rows, STREAM_RECORD).repartition(110, "offset").write.option("maxRecordsPerFile", 1).parquet(str(topic))
    records = read_cdc_stream(spark, THING, "parquet", str(topic), files_per_trigger=1)
    with BatchProgress(spark, told, every=25) as progress:
        query = records.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        run_until_stopped(query)
        assert progress.wait(query)
    assert len(query.recentProgress) <= 100
    got = read_progress(spark, told)
    assert got.count() == 110 and got.agg(F.sum("input_rows")).first()[0] == 110
    assert got.select("batch").distinct().count() == 110


def test_progress_that_cannot_be_written_is_kept(spark, tmp_path, monkeypatch):
    from oreline.streaming import progress as module

    progress = BatchProgress(spark, str(tmp_path / "p"))
    progress._rows = [("n", "i", "r1", 0, 5, "2024-01-01T00:00:00.000Z", 9), ("n", "i", "r1", 1, 6, "2024-01-01T00:00:01.000Z", None)]
    write = module.write_table
    monkeypatch.setattr(module, "write_table", lambda *_: 1 / 0)
    progress.flush()
    monkeypatch.setattr(module, "write_table", write)
    progress.flush()
    # The last batch again, as a second run would report it after a crash before its commit.
    progress._rows = [("n", "i", "r2", 1, 7, "2024-01-02T00:00:00.000Z", 9)]
    progress.flush()
    assert rows_of(read_progress(spark, progress.path), "run_id", "batch", "input_rows") == [("r1", 0, 5), ("r2", 1, 7)]


def test_a_record_delivered_again_is_landed_once(spark, lake, topic):
    """Within a batch, in a later one and after a restart; what comes late for the first time is kept."""
    def send(*offsets, day=0):
        rows = [("cdc.thing", 0, i, dt.datetime(2024, 1, 1) + dt.timedelta(day), message("c", day, f"k{i}", i)) for i in offsets]
        spark.createDataFrame(rows, STREAM_RECORD).coalesce(1).write.mode("append").parquet(topic.path)

    def run():
        ingest(spark, lake, topic, files_per_trigger=1, redelivery="1 hour")
        return [r[0] for r in rows_of(bronze(spark, lake), "id")]

    send(1, 1, 2, day=20)
    send(2, 3, day=20)
    assert run() == ["k1", "k2", "k3"]
    send(1, 3, 4, day=20)
    send(0, day=1)
    assert run() == ["k0", "k1", "k2", "k3", "k4"]


def test_a_stream_with_state_writes_few_files(spark, lake, topic):
    """One file per event date and batch while they are small, not one for each state store."""
    for first in (0, 500):
        rows = [("cdc.thing", 0, i, dt.datetime(2024, 1, 1), message("c", i % 3, f"k{i}", i)) for i in range(first, first + 600)]
        spark.createDataFrame(rows, STREAM_RECORD).coalesce(1).write.mode("append").parquet(topic.path)
    ingest(spark, lake, topic, files_per_trigger=1, redelivery="1 hour")
    log = bronze(spark, lake)
    assert log.count() == 1100 and len(log.inputFiles()) == 6


def test_the_whole_image_survives_folding(spark, lake, topic):
    entity = EntitySpec("thing", "id string", image=True)
    for n in range(3):
        topic.send(message("c", 0, f"a{n}", n), "garbage")
    ingest(spark, lake, topic, entity, files_per_trigger=1)
    assert compact_log(spark, lake.bronze_path(entity), entity, "2024-01-01", "2024-01-01") == 2
    found = image_columns(bronze(spark, lake, entity).filter("id is not null"), struct("n int"))
    assert rows_of(found, "id", "n") == [("a0", 0), ("a1", 1), ("a2", 2)]
    # A column that is declared later is there from then on; silver takes declared ones only.
    build_silver(spark, entity, lake, "2024-01-01", "2024-01-01")
    assert read_silver(spark, entity, lake).columns == ["id", "_silver_updated_at"]


def test_interrupt_stops_the_query():
    class Query:
        name, id, stopped = "q", 1, False

        def awaitTermination(self, timeout):
            raise KeyboardInterrupt

        def stop(self):
            self.stopped = True

    query = Query()
    assert run_until_stopped(query) and query.stopped


def test_sources_need_an_address(spark):
    with pytest.raises(ValueError, match="bootstrap_servers"):
        read_cdc_stream(spark, THING)
    with pytest.raises(ValueError, match="path"):
        read_cdc_stream(spark, THING, "parquet")


def test_kafka_options():
    options = kafka_options(ENTITIES["class_regular_session"], "broker:9092")
    assert options == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "cdc.class_regular_session",
        "groupIdPrefix": "bronze-class_regular_session",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "50000",
        "failOnDataLoss": "false",
        "kafka.session.timeout.ms": "45000",
        "kafka.request.timeout.ms": "60000",
    }
    assert kafka_options(ENTITIES["class_regular_session_student"], "b")["maxOffsetsPerTrigger"] == "200000"


def test_log_compaction(spark, lake, topic):
    for i in range(4):
        topic.send(message("c", 0, f"a{i}", i), message("c", 1, f"b{i}", i), message("c", 9, f"z{i}", i), "garbage")
    ingest(spark, lake, topic, files_per_trigger=1)
    path = lake.bronze_path(THING)
    before = rows_of(bronze(spark, lake).drop(BATCH))
    assert compact_log(spark, path, THING, "2024-01-01", "2024-01-05") == 6
    assert rows_of(bronze(spark, lake).drop(BATCH)) == before
    left = paths.child_dirs(spark, f"{path}/_event_date=2024-01-01")
    assert len(left) == 2 and "_batch=compacted" in left and any(b.endswith("-0000000003") for b in left)
    assert len(paths.child_dirs(spark, f"{path}/_event_date=2024-01-10")) == 4
    assert compact_log(spark, path, THING, "2024-01-01", "2024-01-05") == 0

    topic.send(message("u", 0, "a0", 50))
    ingest(spark, lake, topic)
    # The batch that was the newest is closed now, in both dates it wrote to.
    assert compact_log(spark, path, THING, "2024-01-01", "2024-01-05") == 2
    assert bronze(spark, lake).count() == len(before) + 1


def test_interrupted_compaction_is_repaired(spark, lake, topic):
    for i in range(3):
        topic.send(message("c", 0, f"a{i}", i))
    ingest(spark, lake, topic, files_per_trigger=1)
    path = lake.bronze_path(THING)
    before = rows_of(bronze(spark, lake).drop(BATCH))
    # As after a crash between publishing the folded rows and the clean-up.
    copy = bronze(spark, lake).filter(~F.col(BATCH).endswith("2")).withColumn(BATCH, F.lit("compacted"))
    copy.write.mode("append").partitionBy("_event_date", BATCH).parquet(path)
    assert bronze(spark, lake).count() > len(before)
    compact_log(spark, path, THING, "2024-01-01", "2024-01-01")
    assert rows_of(bronze(spark, lake).drop(BATCH)) == before


def test_silver_job(spark, lake, topic):
    topic.send(message("c", 0, "a", 1), message("c", 0, "b", 1), message("u", 1, "b", 2), message("d", 1, "a"))
    ingest(spark, lake, topic)
    assert build_silver(spark, THING, lake, "2024-01-01", "2024-01-01") == 2
    assert rows_of(read_silver(spark, THING, lake), "id", "n") == [("a", 1), ("b", 1)]
    assert build_silver(spark, THING, lake, "2024-01-02", "2024-01-02") == 1
    assert rows_of(read_silver(spark, THING, lake), "id", "n") == [("a", 1), ("b", 2)]
    assert build_silver(spark, THING, lake, "2024-02-01", "2024-02-02") == 0
    # Without a guard an older window puts older rows back.
    build_silver(spark, THING, lake, "2024-01-01", "2024-01-01")
    assert rows_of(read_silver(spark, THING, lake), "id", "n") == [("a", 1), ("b", 1)]
    assert [f.name for f in read_silver(spark, THING, lake).schema] == THING.silver_schema.names


def test_silver_job_with_deletes_applied(spark, lake, topic):
    topic.send(message("c", 0, "a", 1), message("c", 0, "b", 1), message("u", 1, "b", 2), message("d", 1, "a"), message("d", 1, "zz"))
    ingest(spark, lake, topic)
    build_silver(spark, THING, lake, "2024-01-01", "2024-01-01", deletes="apply")
    build_silver(spark, THING, lake, "2024-01-02", "2024-01-02", deletes="apply")
    assert rows_of(read_silver(spark, THING, lake), "id", "n") == [("b", 2)]


@pytest.mark.parametrize("parts", [1, 4])
def test_silver_job_with_guard(spark, lake, topic, parts):
    entity = EntitySpec("thing", THING.columns, parts=parts)
    topic.send(message("c", 0, "a", 1), message("u", 1, "a", 2), message("c", 0, "b", 7))
    ingest(spark, lake, topic, entity)
    for day in ("2024-01-02", "2024-01-01"):
        build_silver(spark, entity, lake, day, day, guard=True)
    got = read_table(spark, lake.silver_path(entity))
    assert rows_of(got, "id", "n") == [("a", 2), ("b", 7)]
    assert rows_of(got.filter("id = 'a'"), "_version") == [(DAY_0 + DAY,)]


def test_late_event_needs_a_rerun_of_its_date(spark, lake, topic):
    topic.send(message("c", 5, "a", 1))
    ingest(spark, lake, topic)
    build_silver(spark, THING, lake, "2024-01-05", "2024-01-07")
    topic.send(message("c", 2, "late", 9))
    ingest(spark, lake, topic)
    build_silver(spark, THING, lake, "2024-01-05", "2024-01-07")
    assert rows_of(read_silver(spark, THING, lake), "id") == [("a",)]
    build_silver(spark, THING, lake, "2024-01-03", "2024-01-07")
    assert rows_of(read_silver(spark, THING, lake), "id") == [("a",), ("late",)]


def state(spark, lake):
    return rows_of(read_silver(spark, THING, lake), "id", "n")


def unseen(spark, lake, **options):
    return build_silver(spark, THING, lake, guard=True, unseen=True, **options)


def test_unseen_batches_are_merged_once_whatever_their_dates(spark, lake, topic):
    topic.send(message("c", 5, "a", 1))
    ingest(spark, lake, topic)
    assert unseen(spark, lake) == 1 and unseen(spark, lake) == 0
    # Late: one new key, one that is older than what silver has.
    topic.send(message("c", 2, "late", 9), message("c", 1, "a", 0), "garbage")
    topic.send(message("u", 3, "late", 10))
    ingest(spark, lake, topic, files_per_trigger=1)
    assert unseen(spark, lake) == 2
    assert state(spark, lake) == [("a", 1), ("late", 10)]
    assert unseen(spark, lake) == 0
    with pytest.raises(ValueError):
        build_silver(spark, THING, lake, "2024-01-01", unseen=True)


def test_a_batch_that_is_not_committed_is_left_for_later(spark, lake, topic):
    for n in (1, 2):
        topic.send(message("c", n, f"k{n}", n))
    ingest(spark, lake, topic, files_per_trigger=1)
    commits = f"{lake.checkpoint_path(THING)}/commits"
    last = max(int(name) for name in os.listdir(commits) if name.isdigit())
    held = open(f"{commits}/{last}").read()
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")
    assert unseen(spark, lake) == 1 and state(spark, lake) == [("k1", 1)]
    with open(f"{commits}/{last}", "w") as f:
        f.write(held)
    assert unseen(spark, lake) == 1 and state(spark, lake) == [("k1", 1), ("k2", 2)]


def test_unseen_batches_are_not_folded_away(spark, lake, topic):
    for n in range(3):
        topic.send(message("c", 0, f"a{n}", n))
    ingest(spark, lake, topic, files_per_trigger=1)
    path, cursor = lake.bronze_path(THING), lake.cursor_path("thing")
    assert unseen(spark, lake) == 3
    for n in range(3, 6):
        topic.send(message("c", 0, f"a{n}", n))
    ingest(spark, lake, topic, files_per_trigger=1)
    assert compact_log(spark, path, THING, "2024-01-01", "2024-01-01", cursor) == 3
    assert unseen(spark, lake) == 3
    assert state(spark, lake) == [(f"a{n}", n) for n in range(6)]
    # The newest stays; the others have been seen by now.
    assert compact_log(spark, path, THING, "2024-01-01", "2024-01-01", cursor) == 2
    assert unseen(spark, lake) == 0


def test_folded_batches_count_on_the_first_run(spark, lake, topic):
    for n in range(3):
        topic.send(message("c", 0, f"a{n}", n))
    ingest(spark, lake, topic, files_per_trigger=1)
    compact_log(spark, lake.bronze_path(THING), THING, "2024-01-01", "2024-01-01")
    assert unseen(spark, lake) == 3 and unseen(spark, lake) == 0


def test_a_run_that_is_lost_before_its_mark_merges_again(spark, lake, topic, monkeypatch):
    from oreline.plans import jobs

    topic.send(message("c", 0, "a", 1), message("d", 1, "b"))
    ingest(spark, lake, topic)

    def lost(*_):
        raise RuntimeError

    monkeypatch.setattr(jobs, "add_marks", lost)
    with pytest.raises(RuntimeError):
        unseen(spark, lake, deletes="apply")
    monkeypatch.undo()
    assert unseen(spark, lake, deletes="apply") == 2 and state(spark, lake) == [("a", 1)]


def test_removed_keys_stay_away_from_older_events(spark, lake, topic):
    topic.send(message("c", 1, "a", 1), message("c", 1, "b", 1), message("d", 5, "a"), message("d", 5, "never"))
    ingest(spark, lake, topic)
    unseen(spark, lake, deletes="apply")
    assert state(spark, lake) == [("b", 1)]
    topic.send(message("u", 3, "a", 3), message("u", 5, "a", 5), message("u", 4, "never", 4), message("d", 2, "b"))
    ingest(spark, lake, topic)
    unseen(spark, lake, deletes="apply")
    # Older, or as old; and a delete that is newer than b's row takes it, an older one would not.
    assert state(spark, lake) == []
    topic.send(message("c", 6, "a", 6), message("d", 5, "a"))
    ingest(spark, lake, topic)
    unseen(spark, lake, deletes="apply")
    assert state(spark, lake) == [("a", 6)]
    # A plain window run with a guard asks the same memory.
    build_silver(spark, THING, lake, "2024-01-01", "2024-01-05", guard=True)
    assert state(spark, lake) == [("a", 6)]


def test_removed_keys_are_forgotten_after_a_while(spark, lake, topic):
    topic.send(message("d", 5, "a"))
    ingest(spark, lake, topic)
    forget = {"deletes": "apply", "remembered": dt.timedelta(0)}
    unseen(spark, lake, **forget)
    removed = read_table(spark, lake.removed_path(THING))
    assert rows_of(removed, "id") == [("a",)]
    topic.send(message("d", 7, "a"), message("u", 3, "a", 3))
    ingest(spark, lake, topic)
    unseen(spark, lake, **forget)
    assert rows_of(read_table(spark, lake.removed_path(THING)), "id", "_version") == [("a", DAY_0 + 7 * DAY)]


SESSION, BOOKING, PROGRAM = (
    ENTITIES[name] for name in ("class_regular_session", "class_regular_session_student", "study_program")
)


def merge_silver(spark, lake, entity, **columns):
    """One row merged into a silver table, stamped as the job does it."""
    row = [
        (F.lit(columns.get(f.name)) if f.name != "_silver_updated_at" else F.current_timestamp()).cast(f.dataType).alias(f.name)
        for f in entity.silver_schema.fields
    ]
    tables.upsert_table(spark, lake.silver_path(entity), spark.range(1).select(*row), ["id"], schema=entity.silver_schema)


@pytest.fixture
def reported(spark, lake):
    """A session on the 2nd with two students, one on the 3rd with one, and their report."""
    merge_silver(spark, lake, PROGRAM, id="p1", name="Maths")
    merge_silver(spark, lake, SESSION, id="s1", learn_date=20260402, study_program_id="p1")
    merge_silver(spark, lake, SESSION, id="s2", learn_date=20260403, study_program_id="p1")
    for number, student, session in (("b1", 1, "s1"), ("b2", 2, "s1"), ("b3", 3, "s2")):
        merge_silver(spark, lake, BOOKING, id=number, student_id=student, class_regular_session_id=session, status="SUCCESS")
    assert build_gold_changes(spark, lake) == [APRIL_2, APRIL_2 + dt.timedelta(1)]
    return lake


def gold(spark, lake):
    report = read_table(spark, lake.gold_path(), schema=lake.report_table().schema)
    return sorted((r.learn_date.day, r.student_id, r.class_regular_session_id, r.study_program) for r in report.collect())


REPORTED = [(2, 1, "s1", "Maths"), (2, 2, "s1", "Maths"), (3, 3, "s2", "Maths")]


def days_of(dates):
    return [d.day for d in dates]


def test_nothing_changed(spark, reported):
    assert gold(spark, reported) == REPORTED
    before = sorted(os.listdir(f"{reported.gold_path()}/learn_date=2026-04-02"))
    assert build_gold_changes(spark, reported) == []
    assert sorted(os.listdir(f"{reported.gold_path()}/learn_date=2026-04-02")) == before


def test_a_moved_session_leaves_no_row(spark, reported):
    other = sorted(os.listdir(f"{reported.gold_path()}/learn_date=2026-04-03"))
    merge_silver(spark, reported, SESSION, id="s1", learn_date=20260409, study_program_id="p1")
    assert days_of(build_gold_changes(spark, reported)) == [2, 9]
    assert gold(spark, reported) == [(3, 3, "s2", "Maths"), (9, 1, "s1", "Maths"), (9, 2, "s1", "Maths")]
    assert not os.path.exists(f"{reported.gold_path()}/learn_date=2026-04-02")
    assert sorted(os.listdir(f"{reported.gold_path()}/learn_date=2026-04-03")) == other


def test_a_session_that_loses_its_date(spark, reported):
    merge_silver(spark, reported, SESSION, id="s2", study_program_id="p1")
    assert days_of(build_gold_changes(spark, reported)) == [3]
    assert gold(spark, reported) == REPORTED[:2]


def test_a_booking_that_moves_or_loses_its_status(spark, reported):
    merge_silver(spark, reported, BOOKING, id="b1", student_id=1, class_regular_session_id="s2", status="SUCCESS")
    merge_silver(spark, reported, BOOKING, id="b3", student_id=3, class_regular_session_id="s2", status="BOOKED")
    assert days_of(build_gold_changes(spark, reported)) == [2, 3]
    assert gold(spark, reported) == [(2, 2, "s1", "Maths"), (3, 1, "s2", "Maths")]


def test_a_program_that_is_renamed(spark, reported):
    merge_silver(spark, reported, PROGRAM, id="p1", name="Algebra")
    assert days_of(build_gold_changes(spark, reported)) == [2, 3]
    assert {r[3] for r in gold(spark, reported)} == {"Algebra"}


def test_a_session_that_is_removed(spark, reported, tmp_path):
    # As the silver job does it: remembered, then taken out.
    gone = spark.createDataFrame([("s1", 1, "d")], "id string, _version long, _op string")
    remember_removed(spark, reported.removed_path(SESSION), SESSION, gone, dt.timedelta(1))
    tables.upsert_table(
        spark, reported.silver_path(SESSION), gone.select("id", "_op"), ["id"], schema=SESSION.silver_schema,
        delete_when=F.col("_op") == "d",
    )
    assert days_of(build_gold_changes(spark, reported)) == [2]
    assert gold(spark, reported) == REPORTED[2:]


def test_a_report_of_windows_is_adopted(spark, reported, tmp_path):
    lake = Layout(reported.root)
    build_gold_report(spark, lake, "2026-04-02", "2026-04-03", date_filter="where")
    assert build_gold_changes(spark, lake, adopt=True) == [] == build_gold_changes(spark, lake)
    merge_silver(spark, lake, SESSION, id="s2", learn_date=20260402, study_program_id="p1")
    assert days_of(build_gold_changes(spark, lake)) == [2, 3]
    assert [r[0] for r in gold(spark, lake)] == [2, 2, 2]


def test_a_report_that_is_lost_half_way(spark, reported, monkeypatch):
    merge_silver(spark, reported, SESSION, id="s1", learn_date=20260403, study_program_id="p1")
    write = tables.write_table

    def lost(df, target, mode="append", *rest, **options):
        if mode == "overwrite_partitions":
            paths.delete(spark, f"{reported.gold_path()}/learn_date=2026-04-03")
            raise RuntimeError
        write(df, target, mode, *rest, **options)

    monkeypatch.setattr(tables, "write_table", lost)
    with pytest.raises(RuntimeError):
        build_gold_changes(spark, reported)
    monkeypatch.undo()
    assert days_of(build_gold_changes(spark, reported)) == [2, 3]
    assert gold(spark, reported) == [(3, 1, "s1", "Maths"), (3, 2, "s1", "Maths"), (3, 3, "s2", "Maths")]


def star(spark, hot=0):
    students = [(1, "s1", "SUCCESS"), (2, "s1", "ABSENT"), (3, "s2", "FAILED_STUDENT_NO_LEARNED"), (4, "s9", "SUCCESS"), (5, None, "SUCCESS")]
    students += [(100 + i, "s1", "SUCCESS") for i in range(hot)]
    return (
        spark.createDataFrame(students, "student_id long, class_regular_session_id string, status string"),
        spark.createDataFrame(
            [("s1", 20260402, "p1", "g1"), ("s2", 20260410, "p2", "g2"), ("s9", 20261399, "p1", None)],
            "id string, learn_date int, study_program_id string, grade_id string",
        ),
        spark.createDataFrame([("p1", "Maths"), ("p2", "English")], "id string, name string"),
        spark.createDataFrame([("g1", "G1", 3), ("g2", "G2", 8)], "id string, code string, value int"),
    )


def test_report_keeps_bookings_without_a_session_in_range(spark):
    students, sessions, programs, grades = star(spark)
    report = student_session_report(students, sessions, programs, "2026-04-02", "2026-04-03")
    assert rows_of(report) == sorted(
        [(APRIL_2, 1, "s1", "Maths"), (None, 3, "s2", None), (None, 4, "s9", None), (None, 5, None, None)], key=repr
    )
    banded = student_session_report(students, sessions, programs, "2026-04-02", "2026-04-30", grade=grades)
    assert rows_of(banded, "student_id", "grade_code", "grade_program") == [
        (1, "G1", "Tiểu học"), (3, "G2", "THCS"), (4, None, "Others"), (5, None, "Others"),
    ]
    where = student_session_report(students, sessions, programs, "2026-04-02", "2026-04-03", date_filter="where")
    assert rows_of(where) == [(APRIL_2, 1, "s1", "Maths")]
    with pytest.raises(ValueError):
        student_session_report(students, sessions, programs, "2026-04-02", "2026-04-03", date_filter="having")


def test_report_joins_the_bookings_once(spark):
    students, sessions, programs, _ = star(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = student_session_report(students, sessions, programs, "2026-04-02", "2026-04-03")
        plan = report._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum("Exchange hashpartitioning(class_regular_session_id" in line for line in plan.splitlines()) == 1
    assert plan.count("Exchange hashpartitioning") == 4


def test_report_with_a_session_that_holds_most_bookings(spark):
    students, sessions, programs, _ = star(spark, hot=5000)
    report = student_session_report(students.repartition(8), sessions, programs, "2026-04-02", "2026-04-03")
    assert report.count() == 5004
    assert report.filter("study_program = 'Maths'").count() == 5001


def test_hot_session_is_split_when_it_cannot_be_broadcast(spark, tmp_path):
    _, sessions, programs, _ = star(spark)
    hot = spark.range(60_000).select(
        F.col("id").alias("student_id"),
        F.when(F.col("id") % 3 == 0, "s1").otherwise(F.concat(F.lit("x"), F.col("id"))).alias("class_regular_session_id"),
        F.lit("SUCCESS").alias("status"),
    )
    hot.repartition(8).write.parquet(str(tmp_path / "hot"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        students = spark.read.parquet(str(tmp_path / "hot"))
        report = student_session_report(students, sessions, programs, "2026-04-02", "2026-04-03")
        rows = report.collect()
        plan = report._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert "skew=true" in plan
    assert len(rows) == 60_000
    assert sum(r.study_program == "Maths" for r in rows) == 20_000


def test_session_dates_are_filtered_in_the_scan(spark, lake):
    put_star(spark, lake)
    sessions = read_silver(spark, ENTITIES["class_regular_session"], lake)
    plan = sessions_between(sessions, "2026-04-02", "2026-04-03")._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters:")[1]
    assert "GreaterThanOrEqual(learn_date,20260402)" in pushed and "LessThanOrEqual(learn_date,2026" in pushed


def put_star(spark, lake):
    for name, df in zip(("class_regular_session_student", "class_regular_session", "study_program"), star(spark), strict=False):
        entity = ENTITIES[name]
        columns = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in entity.silver_schema]
        df.select(*columns).write.parquet(lake.silver_path(entity))


def test_gold_job(spark, lake):
    put_star(spark, lake)
    gold = lambda: read_table(spark, lake.gold_path(), schema=lake.report_table().schema)
    assert build_gold_report(spark, lake, "2026-04-02", "2026-04-03") == 4
    assert build_gold_report(spark, lake, "2026-04-02", "2026-04-03") == 4
    # The dated row once, the three undated ones once per run.
    assert gold().filter("learn_date is not null").count() == 1
    assert gold().filter("learn_date is null").count() == 6
    assert gold().filter("_gold_updated_at is null").count() == 0


def test_gold_job_without_undated_rows(spark, lake):
    put_star(spark, lake)
    for _ in range(2):
        assert build_gold_report(spark, lake, "2026-04-01", "2026-04-30", null_dates="drop") == 2
    gold = read_table(spark, lake.gold_path(), schema=lake.report_table().schema)
    assert rows_of(gold, "student_id", "study_program") == [(1, "Maths"), (3, "English")]
    with pytest.raises(ValueError):
        build_gold_report(spark, lake, null_dates="maybe")


def test_report_function_prunes_its_scan(spark, tmp_path):
    lake = Layout(str(tmp_path / "lake9"), table_prefix="t9_")
    put_star(spark, lake)
    function, view = register_report_sql(spark, lake)
    spark.sql("USE gold")
    try:
        whole = spark.sql(f"SELECT * FROM {function}(DATE'2026-04-02', DATE'2026-04-03')")
        some = spark.sql(f"SELECT student_id FROM {function}(DATE'2026-04-02', DATE'2026-04-03') WHERE learn_date IS NOT NULL")
        bad = spark.sql(f"SELECT * FROM {function}(DATE'2026-01-01', DATE'2026-12-31') WHERE class_regular_session_id = 's9'")
    finally:
        spark.sql("USE default")
    assert rows_of(whole) == sorted(
        [(APRIL_2, 1, "s1", "Maths"), (None, 3, "s2", None), (None, 4, "s9", None), (None, 5, None, None)], key=repr
    )
    assert rows_of(some) == [(1,)] and rows_of(bad) == [(None, 4, "s9", None)]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(learn_date,20260402)" in plan and "LessThanOrEqual(learn_date,2026" in plan
    (scan,) = [line for line in plan.splitlines() if "FileScan" in line and "class_regular_session_id" in line]
    assert "notes" not in scan.split("ReadSchema")[1]
    assert rows_of(spark.table(view), "student_id", "study_program") == [(1, "Maths"), (3, "English")]


def test_gold_job_null_safe(spark, lake):
    put_star(spark, lake)
    for _ in range(2):
        build_gold_report(spark, lake, "2026-04-02", "2026-04-03", null_safe=True)
    assert read_table(spark, lake.gold_path(), schema=lake.report_table().schema).count() == 4


def test_bronze_catalog_table_after_compaction(spark, tmp_path, topic):
    lake = Layout(str(tmp_path / "lake2"), table_prefix="t2_")
    for i in range(3):
        topic.send(message("c", 0, f"a{i}", i))
    ingest(spark, lake, topic, files_per_trigger=1)
    table = lake.bronze_table(THING)
    ensure_table(spark, table)
    count = "select count(*) from bronze.t2_thing where _event_date = '2024-01-01'"
    assert spark.sql(count).first()[0] == 3
    compact_log(spark, table.path, THING, "2024-01-01", "2024-01-01")
    ensure_table(spark, table)
    assert spark.sql(count).first()[0] == 3


def test_command_line():
    args = parse_args(["--root", "/lake", "silver", "grade", "--start-date", "2026-04-01"])
    assert (args.job, args.entity, args.start_date, args.end_date) == ("silver", "grade", "2026-04-01", None)
    args = parse_args(["--root", "/lake", "bronze", "study_program", "--source", "json", "--source-path", "/in"])
    assert (args.source, args.source_path, args.trigger) == ("json", "/in", None)
    assert parse_args(["--root", "/lake", "gold"]).job == "gold"


def test_command_line_options():
    silver = parse_args(["--root", "/lake", "silver", "grade", "--deletes", "apply", "--guard", "--compact"])
    assert (silver.deletes, silver.guard, silver.compact) == ("apply", True, True)
    gold = parse_args(
        "--root /lake gold --date-filter where --null-dates drop --null-safe --on-duplicate keep_any --date-encoding epoch_days".split()
    )
    assert (gold.date_filter, gold.null_dates, gold.null_safe, gold.on_duplicate, gold.date_encoding) == (
        "where", "drop", True, "keep_any", "epoch_days"
    )
    assert parse_args(["--root", "/lake", "silver", "grade", "--unseen"]).unseen
    assert parse_args(["--root", "/lake", "gold", "--changes"]).changes
    fold = parse_args(["--root", "/lake", "compact", "grade", "--start-date", "2026-04-01"])
    assert (fold.job, fold.entity, fold.start_date) == ("compact", "grade", "2026-04-01")


def test_batch_column_belongs_to_the_plain_log_only():
    plain, delta = (Layout("/lake", fmt=f).bronze_table(THING) for f in ("parquet", "delta"))
    assert BATCH in plain.schema.names and BATCH in plain.partition_by
    assert BATCH not in delta.schema.names and delta.partition_by == ("_event_date",)


def test_tables_are_made_before_the_first_merge(spark, monkeypatch):
    """In a format with row-level operations; not run against one here."""
    from oreline.plans import jobs

    calls = []
    monkeypatch.setattr(jobs, "ensure_table", lambda s, table: calls.append(("ensure", table.name)))
    monkeypatch.setattr(jobs, "upsert_table", lambda *a, **k: calls.append(("merge", k["fmt"])) or 0)
    monkeypatch.setattr(jobs, "read_changes", lambda s, *a: to_bronze(spark.createDataFrame([], STREAM_RECORD), THING))
    build_silver(spark, THING, Layout("/lake", fmt="delta"), "2024-01-01", "2024-01-02")
    assert calls == [("ensure", "thing"), ("merge", "delta")]


def test_command_line_jobs_end_to_end(spark, tmp_path):
    """JSON topics of the real entities -> bronze -> silver -> gold -> SQL."""
    root = str(tmp_path / "lake3")

    def run(*argv):
        run_job(spark, parse_args(["--root", root, "--hive", *argv]))

    def event(op, day, image):
        return json.dumps({"payload": {"op": op, "ts_ms": DAY_0 + day * DAY, "before": None, "after": image}})

    topics = {
        "class_regular_session": [
            event("c", 0, {"id": "s1", "learn_date": 20240105, "study_program_id": "p1"}),
            event("u", 1, {"id": "s1", "learn_date": 20240106, "study_program_id": "p1"}),
            event("c", 1, {"id": "s2", "learn_date": 20240301, "study_program_id": "p1"}),
        ],
        "class_regular_session_student": [
            event("c", 0, {"id": "1", "class_regular_session_id": "s1", "student_id": 7, "status": "BOOKED"}),
            event("u", 1, {"id": "1", "class_regular_session_id": "s1", "student_id": 7, "status": "SUCCESS"}),
            event("c", 1, {"id": "2", "class_regular_session_id": "s2", "student_id": 7, "status": "SUCCESS"}),
            event("c", 1, {"id": "3", "class_regular_session_id": "s1", "student_id": 8, "status": "ABSENT"}),
        ],
        "study_program": [event("r", 0, {"id": "p1", "name": "Maths"}), None, "garbage"],
    }
    for name, values in topics.items():
        folder = tmp_path / name
        folder.mkdir()
        records = [
            {"topic": f"cdc.{name}", "partition": 0, "offset": i, "timestamp": "2024-01-02T00:00:00Z", "value": v}
            for i, v in enumerate(values)
        ]
        (folder / "records.json").write_text("\n".join(json.dumps(r) for r in records))
        run("bronze", name, "--source", "json", "--source-path", str(folder), "--trigger", "available_now")
        run("silver", name, "--start-date", "2024-01-01", "--end-date", "2024-01-31")
    run("gold", "--start-date", "2024-01-01", "--end-date", "2024-01-31")

    report = spark.sql("select learn_date, student_id, class_regular_session_id, study_program from gold.student_session_report")
    assert rows_of(report) == sorted([(dt.date(2024, 1, 6), 7, "s1", "Maths"), (None, 7, "s2", None)], key=repr)
    assert spark.sql("select count(*) from bronze.study_program").first()[0] == 3
    assert spark.sql("select count(*) from silver.study_program").first()[0] == 1
