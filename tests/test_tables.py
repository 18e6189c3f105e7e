import datetime as dt
import os

import pytest
from conftest import plan_of, rows_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from oreline import paths
from oreline.operators import upsert
from oreline.sinks import compact, ensure_table, lookup, upsert_table, write_table
from oreline.sinks import tables
from oreline.sources import read_table, register_views
from oreline.sources.tables import key_parts, table_exists
from oreline.spec import ENTITIES, Layout, struct

SCHEMA = struct("id string, v int")


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def part_files(path):
    return [f for _, _, names in os.walk(path) for f in names if f.startswith("part-")]


def files_by_folder(path):
    return {
        name: sorted(f for f in os.listdir(f"{path}/{name}") if f.startswith("part-"))
        for name in os.listdir(path)
        if "=" in name
    }


def keyed(spark, low, high, v):
    return spark.range(low, high).select(F.col("id").cast("string").alias("id"), F.lit(v).cast("int").alias("v"))


def test_a_small_merge_leaves_the_other_folders_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_table(spark, path, keyed(spark, 0, 3000, 1), ["id"], parts=32)
    before = files_by_folder(path)
    assert len(before) == 32
    # A thousandth of the keys.
    upsert_table(spark, path, keyed(spark, 100, 103, 2), ["id"])
    after = files_by_folder(path)
    changed = {name for name in before if before[name] != after[name]}
    assert 1 <= len(changed) <= 3 and set(after) == set(before)
    got = read_table(spark, path)
    assert got.columns == ["id", "v"]
    assert got.groupBy("v").count().orderBy("v").collect() == [(1, 2997), (2, 3)]


def rows_scanned(df):
    """Rows that the scan handed on when ``df`` was last computed."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()))


def test_a_lookup_of_absent_keys_reads_no_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    even = spark.range(0, 4000, 2).select(F.col("id").cast("string").alias("id"), F.lit(1).cast("int").alias("v"))
    upsert_table(spark, path, even, ["id"], parts=4)
    there = lookup(spark, path, "id", ["10", "11", "2000"], SCHEMA)
    assert rows_of(there) == [("10", 1), ("2000", 1)]
    folders = {f.split("/")[-2] for f in there.inputFiles()}
    assert 1 <= len(folders) <= 3
    # Between the smallest and the largest key of their files, so it is the Bloom filter that tells.
    absent = lookup(spark, path, "id", [str(i) for i in range(1001, 1011, 2)], SCHEMA)
    assert absent.collect() == [] and rows_scanned(absent) == 0
    one = lookup(spark, path, "id", ["1002"], SCHEMA)
    assert one.collect() == [("1002", 1)] and rows_scanned(one) > 0
    assert lookup(spark, str(tmp_path / "none"), "id", ["1"], SCHEMA).count() == 0


def test_a_table_stays_as_it_was_dealt(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_table(spark, path, keyed(spark, 0, 100, 1), ["id"], parts=4)
    upsert_table(spark, path, keyed(spark, 50, 150, 2), ["id"], parts=9)
    assert key_parts(spark, path) == 4 and len(files_by_folder(path)) == 4
    assert read_table(spark, path).groupBy("v").count().orderBy("v").collect() == [(1, 50), (2, 100)]
    # A key that comes as a number belongs where its text does.
    wide = keyed(spark, 0, 10, 3).withColumn("id", F.col("id").cast("long"))
    upsert_table(spark, path, wide, ["id"], schema=SCHEMA)
    assert read_table(spark, path, schema=SCHEMA).count() == 150


def test_null_keys_are_inserted_by_every_merge(spark, tmp_path):
    path = str(tmp_path / "t")
    for v in (1, 2):
        assert upsert_table(spark, path, frame(spark, [("a", v), (None, v)]), ["id"]) == 2
    assert rows_of(read_table(spark, path)) == sorted([("a", 2), (None, 1), (None, 2)], key=repr)
    safe = str(tmp_path / "safe")
    for v in (1, 2):
        upsert_table(spark, safe, frame(spark, [("a", v), (None, v)]), ["id"], null_safe=True)
    assert rows_of(read_table(spark, safe)) == sorted([("a", 2), (None, 2)], key=repr)


def test_a_refused_merge_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_table(spark, path, frame(spark, [("a", 1), ("b", 1)]), ["id"], not_null=["id"])
    for rows, reason in (([("a", 2), (None, 2)], "NOT NULL"), ([("a", 2), ("b", 2), ("b", 3)], "several source rows")):
        with pytest.raises(PySparkException, match=reason):
            upsert_table(spark, path, frame(spark, rows), ["id"], not_null=["id"])
        assert rows_of(read_table(spark, path)) == [("a", 1), ("b", 1)]


def test_folders_that_lose_their_last_row_go(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = struct("id string, v int, _op string")
    remove = {"delete_when": F.col("_op") == "d"}
    rows = [(str(i), i, "u") for i in range(6)]
    upsert_table(spark, path, frame(spark, rows, schema), ["id"], parts=64, **remove)
    upsert_table(spark, path, frame(spark, [(k, None, "d") for k, _, _ in rows[1:]], schema), ["id"], **remove)
    assert rows_of(read_table(spark, path)) == [("0", 0)]
    assert len(files_by_folder(path)) == 1


def test_expired_rows_leave_with_their_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_table(spark, path, keyed(spark, 0, 100, 1), ["id"], parts=2)
    upsert_table(spark, path, keyed(spark, 100, 101, 2), ["id"], expired=F.col("v") < 2)
    left = [len(names) for names in files_by_folder(path).values()]
    assert len(left) == 2 and 0 < read_table(spark, path).filter("v = 1").count() < 100


def test_tables_written_otherwise_are_refused(spark, tmp_path):
    flat = str(tmp_path / "flat")
    frame(spark, [("a", 1)]).write.parquet(flat)
    os.remove(f"{flat}/_SUCCESS")
    assert table_exists(spark, flat)
    with pytest.raises(RuntimeError, match="not written by a merge"):
        upsert_table(spark, flat, frame(spark, [("b", 2)]), ["id"])
    old = str(tmp_path / "old")
    frame(spark, [("a", 1)]).write.parquet(f"{old}/snapshot-00000001")
    with pytest.raises(RuntimeError, match="numbered snapshots"):
        upsert_table(spark, old, frame(spark, [("b", 2)]), ["id"])


class Lost(Exception):
    """The driver goes away."""


@pytest.mark.parametrize("moment", ["before", "between"])
def test_a_lost_driver_loses_nothing(spark, tmp_path, monkeypatch, moment):
    """The merge stops when its rows are complete: before the first partition goes, or when one is gone already."""
    path = str(tmp_path / "t")
    merge_daily(spark, path, [("a", 1, 0), ("b", 2, 1), ("c", 3, 2)])
    write = tables.write_table

    def lost(df, target, mode="append", *rest, **options):
        if mode == "overwrite_partitions":
            if moment == "between":
                paths.delete(spark, f"{path}/day={DAYS[0]}")
            raise Lost
        write(df, target, mode, *rest, **options)

    monkeypatch.setattr(tables, "write_table", lost)
    with pytest.raises(Lost):
        merge_daily(spark, path, [("a", 10, 0), ("b", 20, 1)])
    assert ("c", 3, 2) in read_daily(spark, path)  # readers skip what waits
    monkeypatch.undo()
    # The next merge, of something else, finishes the lost one first.
    merge_daily(spark, path, [("c", 30, 2)])
    assert read_daily(spark, path) == [("a", 10, 0), ("b", 20, 1), ("c", 30, 2)]
    assert tables.PENDING not in paths.child_dirs(spark, path)


def test_incomplete_rows_are_dropped(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_table(spark, path, keyed(spark, 0, 10, 1), ["id"], parts=2)
    keyed(spark, 0, 5, 9).write.parquet(f"{path}/{tables.PENDING}/_key_of_2=0")
    os.remove(f"{path}/{tables.PENDING}/_key_of_2=0/_SUCCESS")
    assert read_table(spark, path).count() == 10
    upsert_table(spark, path, keyed(spark, 0, 5, 2), ["id"])
    assert read_table(spark, path).groupBy("v").count().orderBy("v").collect() == [(1, 5), (2, 5)]


def test_columns_beyond_the_declared_ones_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    declared = frame(spark, []).schema
    upsert_table(spark, path, frame(spark, [("a", 1), ("b", 2)]).withColumn("note", F.lit("x")), ["id"])
    upsert_table(spark, path, frame(spark, [("b", 3), ("c", 4)]), ["id"], schema=declared)
    whole = read_table(spark, path, merge_schema=True)
    assert rows_of(whole, "id", declared.names[1], "note") == [("a", 1, "x"), ("b", 3, "x"), ("c", 4, None)]

    parted = str(tmp_path / "parted")
    merge_daily(spark, parted, [("a", 1, 0)])
    wide = daily(spark, [("b", 2, 0)]).withColumn("note", F.lit("y"))
    wide.write.mode("append").partitionBy("day").parquet(parted)
    merge_daily(spark, parted, [("a", 3, 0)])
    kept = spark.read.option("mergeSchema", "true").parquet(parted).orderBy("id")
    assert [r["note"] for r in kept.collect()] == [None, "y"]


def test_merge_statement_names_its_own_source(spark, monkeypatch):
    said = []
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: said.append(text))
    for _ in range(2):
        tables._merge_into(frame(spark, [("a", 1)]), "delta.`/t`", ["id"])
    assert said[0].startswith("MERGE INTO delta.`/t` AS target USING oreline_")
    assert "ON target.id = source.id" in said[0] and said[0] != said[1]
    monkeypatch.undo()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("oreline_")]


def test_upsert_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert upsert_table(spark, path, frame(spark, []), ["id"]) == 0
    assert not table_exists(spark, path)
    assert upsert_table(spark, path, frame(spark, [("a", 1), ("b", 2)]), ["id"]) == 2
    assert upsert_table(spark, path, frame(spark, [("b", 20), ("c", 30)]), ["id"]) == 2
    assert rows_of(read_table(spark, path)) == [("a", 1), ("b", 20), ("c", 30)]
    before = files_by_folder(path)
    assert upsert_table(spark, path, frame(spark, []), ["id"]) == 0
    assert files_by_folder(path) == before
    with pytest.raises(PySparkException, match="several source rows"):
        upsert_table(spark, path, frame(spark, [("b", 1), ("b", 2)]), ["id"])
    with pytest.raises(PySparkException, match="NOT NULL"):
        upsert_table(spark, path, frame(spark, [(None, 1)]), ["id"], not_null=["id"])
    assert rows_of(read_table(spark, path)) == [("a", 1), ("b", 20), ("c", 30)]
    scratch = paths.child_dirs(spark, paths.scratch_root(spark))
    assert not [d for d in scratch if d.startswith("upsert-")]


def test_upsert_table_with_deletes_and_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = struct("id string, v int, _op string")
    remove = F.col("_op") == "d"
    upsert_table(spark, path, frame(spark, [("a", 1, "u"), ("b", 2, "u"), ("z", None, "d")], schema), ["id"], delete_when=remove)
    assert rows_of(read_table(spark, path)) == [("a", 1), ("b", 2)]
    upsert_table(spark, path, frame(spark, [("a", None, "d"), ("c", 3, "c")], schema), ["id"], delete_when=remove)
    assert rows_of(read_table(spark, path)) == [("b", 2), ("c", 3)]
    upsert_table(spark, path, frame(spark, [("c", 4, "x")], struct("id string, v int, w string")), ["id"], evolve=True)
    assert rows_of(read_table(spark, path, merge_schema=True), "id", "v", "w") == [("b", 2, None), ("c", 4, "x")]


DAYS = [dt.date(2024, 1, d) for d in range(1, 6)]
DAILY = struct("id string, v int, day date")


def daily(spark, rows):
    return frame(spark, [(k, v, None if d is None else DAYS[d]) for k, v, d in rows], DAILY)


def merge_daily(spark, path, rows, **options):
    return upsert_table(spark, path, daily(spark, rows), ["id"], match_also=["day"], partition_by="day", schema=DAILY, **options)


def read_daily(spark, path):
    rows = read_table(spark, path, schema=DAILY).collect()
    return sorted(((r.id, r.v, None if r.day is None else DAYS.index(r.day)) for r in rows), key=repr)


def test_partitioned_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_daily(spark, path, [("a", 1, 0), ("b", 2, 2), ("c", 3, 4), ("d", 4, 3)])
    before = {d: os.listdir(f"{path}/day={DAYS[d]}") for d in (0, 2, 3, 4)}
    merge_daily(spark, path, [("a", 10, 0), ("e", 5, 4), ("a", 7, 1)])
    assert read_daily(spark, path) == [("a", 10, 0), ("a", 7, 1), ("b", 2, 2), ("c", 3, 4), ("d", 4, 3), ("e", 5, 4)]
    after = {d: os.listdir(f"{path}/day={DAYS[d]}") for d in (0, 2, 3, 4)}
    assert [d for d in before if set(before[d]) != set(after[d])] == [0, 4]


def test_undated_rows_are_inserted_by_every_run(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("a", 1, 0), ("a", 2, None), ("b", 3, None)]
    for _ in range(2):
        assert merge_daily(spark, path, rows) == 3
    assert read_daily(spark, path) == sorted([("a", 1, 0), *[("a", 2, None), ("b", 3, None)] * 2], key=repr)
    only_undated = str(tmp_path / "u")
    assert merge_daily(spark, only_undated, [("a", 1, None)]) == 1
    assert merge_daily(spark, only_undated, [("a", 1, None)], null_safe=True) == 1


def test_undated_rows_with_null_safe_matching(spark, tmp_path):
    path = str(tmp_path / "t")
    for v in (1, 2):
        merge_daily(spark, path, [("a", v, 0), ("a", v, None), ("b", v, None)], null_safe=True)
    merge_daily(spark, path, [("c", 9, 1)], null_safe=True)
    assert read_daily(spark, path) == sorted([("a", 2, 0), ("a", 2, None), ("b", 2, None), ("c", 9, 1)], key=repr)


def test_ambiguous_partitioned_source(spark, tmp_path):
    path = str(tmp_path / "t")
    twice = [("a", 1, 0), ("a", 2, 0)]
    merge_daily(spark, path, twice)
    assert len(read_daily(spark, path)) == 2
    with pytest.raises(PySparkException, match="several source rows"):
        merge_daily(spark, path, twice)
    merge_daily(spark, path, twice, on_duplicate="keep_any")
    assert len(read_daily(spark, path)) == 1


def test_invalid_table_options(spark, tmp_path):
    source = daily(spark, [("a", 1, 0)])
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="match condition"):
        upsert_table(spark, path, source, ["id"], partition_by="day")
    with pytest.raises(ValueError, match="partitioned"):
        upsert_table(spark, path, source, ["id", "day"], partition_by="day", delete_when=F.col("v") == 1)
    with pytest.raises(ValueError, match="plain merge"):
        upsert_table(spark, path, source, ["id"], guard="v", fmt="delta")


@pytest.mark.parametrize("options", [{}, {"on_duplicate": "trust"}, {"guard": "v"}])
def test_a_small_source_is_merged_without_a_shuffle_of_the_table(spark, tmp_path, monkeypatch, options):
    path, plans, files = str(tmp_path / "t"), [], []
    upsert_table(spark, path, keyed(spark, 0, 1000, 1), ["id"], parts=8, **options)
    publish = tables.publish

    def watched(df, *rest):
        plans.append(plan_of(df))
        files.extend(df.inputFiles())
        return publish(df, *rest)

    monkeypatch.setattr(tables, "publish", watched)
    few = keyed(spark, 5, 6, 2)
    upsert_table(spark, path, few, ["id"], **options)
    (plan,) = plans
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert len({f.split("/")[-2] for f in files if f"{path}/" in f}) == 1
    assert read_table(spark, path).groupBy("v").count().orderBy("v").collect() == [(1, 999), (2, 1)]


@pytest.mark.parametrize("options", [{}, {"on_duplicate": "trust"}, {"guard": "v"}, {"null_safe": True}])
def test_a_new_table_is_written_once(spark, tmp_path, monkeypatch, options):
    """Straight to its folders: neither staged nor kept aside, as it replaces nothing."""
    path = str(tmp_path / "t")
    nothing = keyed(spark, 0, 1, 7).withColumn("id", F.lit(None).cast("string"))
    rows = keyed(spark, 0, 1000, 1).unionByName(nothing)

    def unwanted(*_, **__):
        raise AssertionError("written twice")

    with monkeypatch.context() as patched:
        patched.setattr(tables, "publish", unwanted)
        patched.setattr(tables, "staged", unwanted)
        assert upsert_table(spark, path, rows.limit(0), ["id"], parts=4, **options) == 0 and not tables.table_exists(spark, path)
        assert upsert_table(spark, path, rows, ["id"], parts=4, **options) == 1001
    assert [len(names) for names in files_by_folder(path).values()] == [1] * 5 and key_parts(spark, path) == 4
    assert read_table(spark, path).groupBy("v").count().orderBy("v").collect() == [(1, 1000), (7, 1)]
    assert upsert_table(spark, path, keyed(spark, 0, 10, 2), ["id"], **options) == 10
    assert read_table(spark, path).groupBy("v").count().orderBy("v").collect() == [(1, 990), (2, 10), (7, 1)]


def test_compaction(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(4):
        write_table(daily(spark, [(f"k{i}", i, d) for d in range(3)]), path, partition_by=["day"])
    before = read_daily(spark, path)
    compact(spark, path, ["day"], F.col("day") <= F.lit(DAYS[1]))
    assert read_daily(spark, path) == before
    assert [len(part_files(f"{path}/day={DAYS[d]}")) for d in range(3)] == [1, 1, 4]
    state = str(tmp_path / "s")
    upsert_table(spark, state, keyed(spark, 0, 100, 1), ["id"], parts=2)
    for _ in range(3):
        for file in spark.read.parquet(f"{state}/_key_of_2=1").inputFiles():
            spark.read.parquet(file).limit(1).write.mode("append").parquet(f"{state}/_key_of_2=1")
    rows = read_table(spark, state).count()
    assert [len(names) for names in files_by_folder(state).values()] != [1, 1]
    compact(spark, state)
    assert [len(names) for names in files_by_folder(state).values()] == [1, 1]
    assert read_table(spark, state).count() == rows and key_parts(spark, state) == 2
    with pytest.raises(ValueError):
        compact(spark, path)


def test_compaction_keeps_partition_values_and_late_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    for part, schema, row in (("01", "v int, p string", (1, "01")), ("01", "v int, w string, p string", (2, "x", "01"))):
        write_table(spark.createDataFrame([row], schema), path, partition_by=["p"])
    compact(spark, path, ["p"])
    assert os.path.isdir(f"{path}/p=01") and not os.path.isdir(f"{path}/p=1")
    got = read_table(spark, path, schema=struct("v int, w string, p string"))
    assert rows_of(got) == [(1, None, "01"), (2, "x", "01")]


def test_partitioned_upsert_without_a_declared_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    options = {"match_also": ["p"], "partition_by": "p"}
    upsert_table(spark, path, frame(spark, [("a", 1, "01"), ("b", 1, "02")], struct("id string, v int, p string")), ["id"], **options)
    wider = struct("id string, v int, w string, p string")
    upsert_table(spark, path, frame(spark, [("a", 2, "x", "01")], wider), ["id"], evolve=True, **options)
    upsert_table(spark, path, frame(spark, [("b", 3, "02"), ("c", 3, "01")], struct("id string, v int, p string")), ["id"], **options)
    got = read_table(spark, path, schema=wider)
    assert rows_of(got) == [("a", 2, "x", "01"), ("b", 3, None, "02"), ("c", 3, None, "01")]


def test_added_column_reads_as_null(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(frame(spark, [("a", 1)]), path)
    wider = struct("id string, v int, w string")
    write_table(frame(spark, [("b", 2, "x")], wider), path)
    expected = [("a", 1, None), ("b", 2, "x")]
    assert rows_of(read_table(spark, path, merge_schema=True), "id", "v", "w") == expected
    assert rows_of(read_table(spark, path, schema=wider)) == expected


def test_a_failed_swap_keeps_the_complete_rows(spark, tmp_path):
    from oreline.sinks.tables import staged

    folder = paths.scratch_root(spark)
    with pytest.raises(RuntimeError), staged(frame(spark, [("a", 1)]), "swap-test", keep_on_error=True):
        raise RuntimeError
    (kept,) = [d for d in paths.child_dirs(spark, folder) if d.startswith("swap-test")]
    assert rows_of(spark.read.parquet(f"{folder}/{kept}")) == [("a", 1)]
    with pytest.raises(RuntimeError), staged(frame(spark, [("a", 1)]), "gone-test"):
        raise RuntimeError
    assert not [d for d in paths.child_dirs(spark, folder) if d.startswith("gone-test")]


@pytest.mark.parametrize("threshold", ["-1", "1m"])
def test_partitioned_merge_never_shuffles_the_table_by_date(spark, tmp_path, monkeypatch, threshold):
    path, plans, files = str(tmp_path / "t"), [], []
    merge_daily(spark, path, [("a", 1, 0), ("b", 2, 2), ("c", 3, 4)])
    publish = tables.publish

    def watched(df, *rest):
        plans.append(plan_of(df))
        files.extend(df.inputFiles())
        return publish(df, *rest)

    monkeypatch.setattr(tables, "publish", watched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        merge_daily(spark, path, [("a", 10, 0), ("e", 5, 4)])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    (plan,) = plans
    assert "hashpartitioning(day" not in plan and "LeftSemi" not in plan
    read = {day for day in DAYS for f in files if f"{path}/day={day}/" in f}
    assert read == {DAYS[0], DAYS[4]}


def test_write_options(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = frame(spark, [(str(i), i) for i in range(10)]).coalesce(1)
    write_table(rows, path, compression="gzip", max_records_per_file=4)
    files = part_files(path)
    assert len(files) == 3 and all(".gz." in f for f in files)


def test_catalog_tables_follow_the_data(spark, tmp_path):
    layout = Layout(str(tmp_path), table_prefix="t1_")
    entity = ENTITIES["grade"]
    table = layout.silver_table(entity)
    ensure_table(spark, table)
    assert spark.table("silver.t1_grade").count() == 0
    columns = [(F.lit("1") if f.name == "id" else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema]
    upsert_table(spark, table.path, spark.range(1).select(*columns), ["id"], schema=table.schema)
    ensure_table(spark, table)
    assert spark.table("silver.t1_grade").count() == 1
    described = {r.key: r.value for r in spark.sql("show tblproperties silver.t1_grade").collect()}
    assert described["layer"] == "silver"

    gold = layout.report_table()
    ensure_table(spark, gold)
    report = spark.sql(
        "select date'2024-01-01' learn_date, 1L student_id, 's' class_regular_session_id, 'p' study_program, "
        "timestamp'2024-01-01 00:00:00' _gold_updated_at"
    )
    write_table(report, gold.path, partition_by=["learn_date"])
    ensure_table(spark, gold)
    assert spark.sql("select study_program from gold.t1_student_session_report where learn_date = '2024-01-01'").collect() == [("p",)]


def test_views(spark):
    register_views(spark, {"one": frame(spark, [("a", 1)]), "two": frame(spark, [("a", 2)])})
    assert spark.sql("select one.v + two.v s from one join two using (id)").collect() == [(3,)]


def test_shared_folder_is_the_configured_one(spark):
    assert paths.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
