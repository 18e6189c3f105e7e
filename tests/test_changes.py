import datetime as dt
import json
import random

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from oreline import samples
from oreline.functions import to_bronze
from oreline.operators import (
    drop_deletes,
    in_window,
    latest_per_key,
    read_changes,
    require_key,
    silver_changes,
    strip_columns,
)
from oreline.operators.changes import split_repeated
from oreline.plans import jobs
from oreline.sinks import tables, write_table
from oreline.spec import BATCH, EVENT_DATE, EntitySpec, Layout

THING = EntitySpec("thing", "id string, n int", before_key=True)

SCHEMA = "_op string, _ts_ms long, _kafka_partition int, _kafka_offset long, _before_key string, id string, n int, _event_date date"


def log(spark, rows):
    day = dt.date(2024, 1, 1)
    full = [(op, ts, 0, i, before, key, n, day + dt.timedelta(days=ts)) for i, (op, ts, before, key, n) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def test_newest_row_is_independent_of_input_order(spark):
    rows = [("u", random.Random(i).randrange(5), None, f"k{i % 7}", i) for i in range(200)]
    expected = {}
    for i, (_, ts, _, key, n) in enumerate(rows):
        expected[key] = max(expected.get(key, (-1, -1, -1)), (ts, i, n))
    df = log(spark, rows)
    for seed in range(3):
        got = latest_per_key(df.orderBy(F.rand(seed)), ["id"])
        assert rows_of(got, "id", "n") == sorted((k, v[2]) for k, v in expected.items())


def test_newest_row_of_a_key_that_holds_most_of_the_log(spark):
    rows = [("u", i, None, "hot" if i % 3 else f"k{i}", i) for i in range(3000)]
    got = latest_per_key(log(spark, rows).repartition(16), ["id"])
    assert got.count() == 1001
    assert got.filter("id = 'hot'").first()["n"] == 2999


def test_rank_is_pruned_before_the_shuffle(spark):
    df = log(spark, [("u", 1, None, "a", 1)]).repartition(4)
    plan = plan_of(latest_per_key(df, ["id"]))
    assert plan.count("WindowGroupLimit") == 2


def test_rows_without_operation_or_key_are_dropped(spark):
    df = log(spark, [("u", 1, None, "a", 1), ("d", 2, "a", None, None), (None, 3, None, "b", 2), ("c", 4, None, None, 3)])
    assert rows_of(drop_deletes(df), "n") == [(1,), (3,)]
    assert rows_of(require_key(drop_deletes(df), ["id"]), "n") == [(1,)]


def test_window_includes_both_ends_and_drops_undated(spark):
    df = log(spark, [("u", t, None, "a", t) for t in range(5)])
    df = df.unionByName(df.limit(1).withColumn("_event_date", F.lit(None).cast("date")))
    assert rows_of(in_window(df, "2024-01-02", "2024-01-04"), "n") == [(1,), (2,), (3,)]


def test_created_then_deleted_key(spark):
    df = log(spark, [("c", 1, None, "a", 1), ("d", 2, "a", None, None), ("u", 1, None, "b", 5)])
    assert rows_of(silver_changes(df, THING)) == [("a", 1), ("b", 5)]
    applied = silver_changes(df, THING, deletes="apply")
    assert rows_of(applied, "id", "_op") == [("a", "d"), ("b", "u")]


def test_key_that_comes_back_after_a_delete(spark):
    df = log(spark, [("d", 1, "a", None, None), ("c", 2, None, "a", 7)])
    assert rows_of(silver_changes(df, THING, deletes="apply"), "id", "n", "_op") == [("a", 7, "c")]


def test_version_is_kept_on_request(spark):
    df = log(spark, [("c", 1, None, "a", 1), ("u", 2, None, "a", 2)])
    assert rows_of(silver_changes(df, THING, keep_version=True), "id", "n", "_version") == [("a", 2, 2)]


def test_strip_ignores_missing_names(spark):
    df = log(spark, [("c", 1, None, "a", 1)])
    assert strip_columns(df, ["_op", "nope"]).columns == [c for c in df.columns if c != "_op"]
    assert strip_columns(df).columns == ["id", "n"]


def test_only_the_window_is_read(spark, tmp_path):
    path = str(tmp_path / "log")
    write_table(log(spark, [("u", t, None, "a", t) for t in range(5)]), path, partition_by=["_event_date"])
    df = read_changes(spark, path, "2024-01-02", dt.date(2024, 1, 3))
    assert rows_of(df, "n") == [(1,), (2,)]
    plan = plan_of(df)
    partition_filters = plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "_event_date" in partition_filters
    # Other dates are not even listed.
    assert len(df.inputFiles()) == 2


def test_window_without_any_partition(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = log(spark, [("u", t, None, "a", t) for t in range(3)])
    undated = rows.limit(1).withColumn("_event_date", F.lit(None).cast("date"))
    write_table(rows.unionByName(undated), path, partition_by=["_event_date"])
    assert read_changes(spark, path, "2025-01-01", "2025-01-31").count() == 0
    assert read_changes(spark, path, "2020-01-01", "2030-01-31").count() == 3


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_rows_alone_with_their_key_need_no_rank(spark, monkeypatch, few):
    monkeypatch.setattr(tables, "FEW", few)
    rows = [(f"k{i % 90}" if i else None, i % 7, i, 0) for i in range(100)]
    log = spark.createDataFrame(rows, "id string, _ts_ms long, _kafka_offset long, _kafka_partition int")
    repeated = tables.repeated_hashes(log, ["id"])
    assert (repeated is None) == (few == 0)
    if repeated is not None:
        assert repeated.count() == 9  # k1 to k9; k0 and the null are alone
        once, several = split_repeated(log, ["id"], repeated)
        assert (once.count(), several.count()) == (82, 18)
        assert "Exchange hashpartitioning" not in plan_of(once)
    assert rows_of(latest_per_key(log, ["id"], repeated=repeated)) == rows_of(latest_per_key(log, ["id"]))


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_bookings_are_numbered_among_their_like(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(tables, "FEW", few)
    rows = [(1, 5, "A"), (1, 5, "A"), (1, 5, "A"), (2, 5, "R"), (None, 5, "R"), (None, 5, "R"), (3, None, None)]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_suppkey long, l_returnflag string")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 1)], "o_orderkey long, o_orderdate timestamp, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, "c")], "c_custkey long, c_name string").write.parquet(f"{tmp_path}/customer.parquet")
    feed = samples.report_snapshots(spark, str(tmp_path))["class_regular_session_student"]
    ids = feed.select(F.get_json_object("value", "$.payload.after.id").alias("id"))
    assert [r[0] for r in rows_of(ids)] == ["1|5|A#1", "1|5|A#2", "1|5|A#3", "2|5|R#1", "3#1", "5|R#1", "5|R#2"]
    assert feed.select("offset", "partition").distinct().count() == 7
    if few:
        assert "Window" not in plan_of(feed).split("Union")[0]


def test_a_snapshot_ends_up_in_silver_without_a_shuffle_of_its_log(spark, tmp_path, monkeypatch):
    """The rows are shuffled once, to be dealt to the table's folders."""
    seen = []
    merge = jobs.upsert_table
    monkeypatch.setattr(jobs, "upsert_table", lambda s, path, rows, *rest, **options: seen.append(plan_of(rows)) or merge(s, path, rows, *rest, **options))
    layout, entity = Layout(str(tmp_path / "lake")), EntitySpec("thing", "id string, n int")
    rows = [(json.dumps({"payload": {"after": {"id": f"k{i % 999}", "n": i}, "op": "r", "ts_ms": 0}}), i) for i in range(1000)]
    records = spark.createDataFrame(rows, "value string, offset long").selectExpr("'t' as topic", "0 as partition", "offset", "timestamp'1970-01-01' as timestamp", "value")
    write_table(to_bronze(records, entity).withColumn(BATCH, F.lit("b-0")), layout.bronze_path(entity), partition_by=[EVENT_DATE, BATCH])
    assert jobs.build_silver(spark, entity, layout, "1970-01-01", "1970-01-01") == 999
    found = {r["id"]: r["n"] for r in jobs.read_silver(spark, entity, layout).collect()}
    assert found == {f"k{i}": i for i in range(1, 999)} | {"k0": 999}
    # Of the two branches only the one of repeated keys has an exchange.
    assert seen[0].count("Exchange hashpartitioning") == 1 and seen[0].count("BroadcastHashJoin") == 2
