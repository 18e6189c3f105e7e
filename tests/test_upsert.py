import pytest
from conftest import plan_of, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from oreline.operators import check_not_null, duplicate_keys, upsert

SCHEMA = "id string, v int"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def test_update_insert_untouched(spark):
    target = frame(spark, [("a", 1), ("b", 2)])
    source = frame(spark, [("b", 20), ("c", 30)])
    assert rows_of(upsert(target, source, ["id"])) == [("a", 1), ("b", 20), ("c", 30)]


def test_null_keys_match_nothing(spark):
    target = frame(spark, [(None, 1), ("a", 1)])
    source = frame(spark, [(None, 2), ("a", 5)])
    assert rows_of(upsert(target, source, ["id"])) == [("a", 5), (None, 1), (None, 2)]
    assert rows_of(upsert(target, source, ["id"], null_safe=True)) == [("a", 5), (None, 2)]


def test_composite_key_with_partition_column(spark):
    schema = "student long, session string, day date, v int"
    target = frame(spark, [], schema).unionByName(
        spark.sql("select 1L student, 's' session, date'2024-01-01' day, 1 v union all select 1L, 's', null, 2")
    )
    source = spark.sql(
        "select 1L student, 's' session, date'2024-01-01' day, 10 v union all select 1L, 's', date'2024-01-02', 20 "
        "union all select 1L, 's', null, 30"
    )
    got = upsert(target, source, ["student", "session"], match_also=["day"])
    assert sorted(r.v for r in got.collect()) == [2, 10, 20, 30]


def test_several_source_rows_for_one_target_row_fail(spark):
    target = frame(spark, [("a", 1)])
    twice = frame(spark, [("a", 2), ("a", 3)])
    with pytest.raises(PySparkException, match="several source rows"):
        upsert(target, twice, ["id"]).collect()
    assert len(rows_of(upsert(target, twice, ["id"], on_duplicate="keep_any"))) == 1


def test_duplicates_that_match_nothing_are_all_inserted(spark):
    target = frame(spark, [("a", 1)])
    source = frame(spark, [("b", 2), ("b", 3)])
    assert rows_of(upsert(target, source, ["id"])) == [("a", 1), ("b", 2), ("b", 3)]


def test_keep_any_keeps_all_null_keys(spark):
    target = frame(spark, [("a", 1)])
    source = frame(spark, [(None, 2), (None, 3), ("a", 4), ("a", 4)])
    assert rows_of(upsert(target, source, ["id"], on_duplicate="keep_any")) == [("a", 4), (None, 2), (None, 3)]


def test_new_source_column(spark):
    target = frame(spark, [("a", 1), ("b", 2)])
    source = frame(spark, [("b", 20, "x")], "id string, v int, w string")
    with pytest.raises(ValueError, match="evolve"):
        upsert(target, source, ["id"])
    assert rows_of(upsert(target, source, ["id"], evolve=True)) == [("a", 1, None), ("b", 20, "x")]


def test_target_column_the_source_lacks_is_kept(spark):
    target = frame(spark, [("a", 1, "x"), ("b", 2, "y")], "id string, v int, w string")
    source = frame(spark, [("b", 20), ("c", 30)])
    assert rows_of(upsert(target, source, ["id"])) == [("a", 1, "x"), ("b", 20, "y"), ("c", 30, None)]


def test_guard_keeps_the_newer_row(spark):
    target = frame(spark, [("a", 5), ("b", 5), ("c", 5), (None, 1)])
    source = frame(spark, [("a", 4), ("b", 6), ("d", 1), (None, 0)])
    got = upsert(target, source, ["id"], guard="v")
    assert rows_of(got) == [("a", 5), ("b", 6), ("c", 5), ("d", 1), (None, 0), (None, 1)]


def test_guard_tie_keeps_the_target(spark):
    target = frame(spark, [("a", 5, "old")], "id string, v int, w string")
    source = frame(spark, [("a", 5, "new")], "id string, v int, w string")
    assert rows_of(upsert(target, source, ["id"], guard="v")) == [("a", 5, "old")]


def test_deletes_remove_their_key(spark):
    target = frame(spark, [("a", 1), ("b", 2)])
    source = frame(spark, [("a", None, "d"), ("b", 20, "u"), ("z", None, "d")], "id string, v int, _op string")
    got = upsert(target, source, ["id"], delete_when=F.col("_op") == "d")
    assert rows_of(got) == [("b", 20)]


def test_an_old_delete_does_not_remove_a_newer_row(spark):
    schema = "id string, v int, _op string"
    target = frame(spark, [("a", 5), ("b", 5)])
    source = frame(spark, [("a", 4, "d"), ("b", 6, "d"), ("c", 1, "u")], schema)
    got = upsert(target, source, ["id"], guard="v", delete_when=F.col("_op") == "d")
    assert rows_of(got) == [("a", 5), ("c", 1)]


def test_source_derived_from_the_target(spark):
    target = frame(spark, [("a", 1), ("b", 2), (None, 9)])
    source = target.filter("v = 1").withColumn("v", F.col("v") * 10)
    assert rows_of(upsert(target, source, ["id"])) == [("a", 10), ("b", 2), (None, 9)]


def test_small_source_leaves_the_target_unshuffled(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("v")).write.parquet(path)
    source = str(tmp_path / "s")
    spark.range(10).select(F.col("id").cast("string").alias("id"), F.lit(2).alias("v")).write.parquet(source)
    got = upsert(spark.read.parquet(path), spark.read.parquet(source), ["id"], on_duplicate="trust")
    plan = plan_of(got)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert got.count() == 1000 and got.filter("v = 2").count() == 10


def test_constraint_and_duplicates(spark):
    df = frame(spark, [("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 2)])
    assert rows_of(duplicate_keys(df, ["id"])) == [("a", 2)]
    with pytest.raises(PySparkException, match="NOT NULL column id"):
        check_not_null(df, ["id"]).collect()
    assert rows_of(check_not_null(df.filter("id is not null"), ["id"]), "id") == [("a",), ("a",), ("b",)]


KEYS = st.sampled_from(["a", "b", "c", "d"])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    target=st.dictionaries(KEYS, st.integers(0, 9)),
    source=st.dictionaries(KEYS, st.integers(10, 19)),
    nulls=st.tuples(st.integers(0, 2), st.integers(0, 2)),
)
def test_merge_model(spark, target, source, nulls):
    rows = lambda d, n: [*d.items(), *[(None, -1)] * n]
    t, s = frame(spark, rows(target, nulls[0])), frame(spark, rows(source, nulls[1]))
    expected = sorted(rows({**target, **source}, sum(nulls)), key=repr)
    once = upsert(t, s, ["id"])
    assert rows_of(once) == expected
    keyed = s.filter("id is not null")
    assert rows_of(upsert(once, keyed, ["id"])) == expected
