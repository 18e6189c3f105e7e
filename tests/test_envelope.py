import datetime as dt
import json

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from oreline.functions import decode_envelope, grade_band, image_columns, int_date, int_date_between, to_bronze, undecodable
from oreline.functions.envelope import event_date
from oreline.operators import strip_columns
from oreline.spec import BATCH, ENTITIES, EntitySpec, struct

THING = EntitySpec("thing", "id string, n int, label string")


def message(op="u", after=None, before=None, ts_ms=1_704_067_200_000, **extra):
    return json.dumps({"payload": {"op": op, "ts_ms": ts_ms, "before": before, "after": after, **extra}})


def decode(records, *values, **options):
    df = decode_envelope(records(list(values)), THING.after_schema, **options)
    return [r.asDict() for r in df.orderBy("_kafka_offset").collect()]


def test_full_after_image_and_ignored_siblings(records):
    value = json.loads(message("c", {"id": "a", "n": 1, "label": "x", "unknown": [1, 2]}))
    value["schema"] = {"type": "struct"}
    (row,) = decode(records, json.dumps(value))
    assert (row["_op"], row["_ts_ms"], row["id"], row["n"], row["label"]) == ("c", 1_704_067_200_000, "a", 1, "x")


def test_delete_has_no_business_columns(records):
    (row,) = decode(records, message("d", None, {"id": "a", "n": 1, "label": "x"}))
    assert (row["_op"], row["id"], row["n"], row["label"]) == ("d", None, None, None)


def test_before_key_is_kept_on_request(records):
    deleted, live = decode(
        records, message("d", None, {"id": "a", "n": 1}), message("u", {"id": "b"}), before_key="id"
    )
    assert deleted["_before_key"] == "a"
    assert live["_before_key"] is None and live["id"] == "b"


def test_before_image_is_kept_on_request(records):
    before = {"id": "a", "n": 1, "label": "x"}
    (row,) = decode(records, message("u", {"id": "a", "n": 2}, before), columns=["n"], before_image=True)
    assert row["_before"].asDict() == before and row["n"] == 2
    (plain,) = decode(records, message("u", {"id": "a", "n": 2}, before))
    assert "_before" not in plain


@pytest.mark.parametrize("value", [None, "garbage", "", "[1]", "{}"])
def test_undecodable_values_give_null_columns(records, value):
    df = to_bronze(records([value]), THING)
    row = df.first()
    assert [row[c] for c in ("_op", "_ts_ms", "id", "n", "label", "_event_date")] == [None] * 6
    assert row["_kafka_offset"] == 0
    assert undecodable(df).count() == 1


def test_one_bad_field_does_not_spoil_the_row(records):
    text_in_int, too_big = decode(
        records, message(after={"id": "a", "n": "xx", "label": "p"}), message(after={"id": "b", "n": 2**40, "label": "q"})
    )
    assert (text_in_int["id"], text_in_int["n"], text_in_int["label"]) == ("a", None, "p")
    assert (too_big["id"], too_big["n"], too_big["label"]) == ("b", None, "q")


def test_object_in_a_string_field_is_its_json_text(records):
    (row,) = decode(
        records,
        message(after={"id": "a", "label": {"k": 1}}, transaction={"id": "t1"}),
        meta=("op", "ts_ms", "transaction"),
    )
    assert json.loads(row["label"]) == {"k": 1}
    assert json.loads(row["_transaction"]) == {"id": "t1"}


def test_column_list_decodes_only_those(records):
    df = decode_envelope(records([message(after={"id": "a", "n": 3, "label": "x"})]), THING.after_schema, columns=["n"])
    assert [c for c in df.columns if not c.startswith("_")] == ["n"]
    assert df.first()["n"] == 3


def test_binary_values_are_decoded(records):
    df = records([message(after={"id": "a"})]).withColumn("value", F.col("value").cast("binary"))
    assert decode_envelope(df, THING.after_schema).first()["id"] == "a"


def test_class_session_keeps_the_finer_clocks(records):
    entity = ENTITIES["class_regular_session"]
    row = to_bronze(records([message(after={"id": "s"}, ts_us=5, ts_ns=6)]), entity).first()
    assert (row["_ts_us"], row["_ts_ns"]) == (5, 6)
    assert "_ts_us" not in to_bronze(records([]), ENTITIES["study_program"]).columns


@pytest.mark.parametrize("name", sorted(ENTITIES))
def test_bronze_rows_match_the_declared_schema(records, name):
    entity = ENTITIES[name]
    produced = to_bronze(records([message(after={"id": "1"})]), entity)
    declared = [(f.name, f.dataType) for f in entity.bronze_schema.fields if f.name != "_batch"]
    assert [(f.name, f.dataType) for f in produced.schema.fields] == declared


@pytest.mark.parametrize("zone", ["UTC", "Asia/Ho_Chi_Minh", "America/New_York"])
def test_event_date_is_the_utc_day_in_any_zone(spark, zone):
    day = 86_400_000
    values = [0, -1, day - 1, day, 1_704_067_199_999, 1_704_067_200_000, None, 2**62]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(v,) for v in values], "ms long").select("ms", event_date(F.col("ms")).alias("d"))
        got = {r.ms: r.d for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got[0] == got[day - 1] == dt.date(1970, 1, 1)
    assert got[-1] == dt.date(1969, 12, 31)
    assert got[day] == dt.date(1970, 1, 2)
    assert got[1_704_067_199_999] == dt.date(2023, 12, 31)
    assert got[1_704_067_200_000] == dt.date(2024, 1, 1)
    assert got[None] is None and got[2**62] is None


def test_int_dates(spark):
    df = spark.createDataFrame([(20260402,), (20545,), (20261399,), (None,)], "n int")
    assert [r[0] for r in df.select(int_date(F.col("n"))).collect()] == [dt.date(2026, 4, 2), None, None, None]
    days = spark.createDataFrame([(20545,), (0,), (None,)], "n int").select(int_date(F.col("n"), "epoch_days"))
    assert [r[0] for r in days.collect()] == [dt.date(2026, 4, 2), dt.date(1970, 1, 1), None]
    with pytest.raises(ValueError):
        int_date(F.col("n"), "roman")


@pytest.mark.parametrize("encoding,n", [("yyyymmdd", [20260331, 20260401, 20260430, 20260501]), ("epoch_days", [20543, 20544, 20573, 20574])])
def test_raw_range_agrees_with_the_decoded_range(spark, encoding, n):
    df = spark.createDataFrame([(v,) for v in n], "n int")
    kept = df.filter(int_date_between(F.col("n"), "2026-04-01", "2026-04-30", encoding))
    decoded = df.filter(int_date(F.col("n"), encoding).between("2026-04-01", "2026-04-30"))
    assert rows_of(kept) == rows_of(decoded) == [(n[1],), (n[2],)]


def test_grade_bands(spark):
    df = spark.createDataFrame([(v,) for v in (None, 0, 1, 5, 6, 9, 10)], "v int")
    labels = [r[0] for r in df.select(grade_band(F.col("v"))).collect()]
    assert labels == ["Others", "Others", "Tiểu học", "Tiểu học", "THCS", "THCS", "Others"]


def test_struct_declaration():
    assert struct("a string, b bigint").simpleString() == "struct<a:string,b:bigint>"
    widths = {name: len(spec.after_schema) for name, spec in ENTITIES.items()}
    assert widths == {
        "class_regular_session": 30,
        "class_regular_session_student": 9,
        "report_monthly_learning_student_info": 19,
        "study_program": 15,
        "grade": 8,
    }


def test_images_are_kept_whole(records):
    entity = EntitySpec("thing", "id string", image=True)
    texts = [
        '{"payload": {"op": "c", "ts_ms": 1, "after": {"id": "a", "n": 7, "s": "x", "deep": {"y": [1, null]}, "z": null}}}',
        '{"payload": {"op": "d", "ts_ms": 1, "after": null, "before": {"id": "a"}}}',
        '{"payload": {"op": "c", "ts_ms": 1, "after": {"id": "b", "n": "not a number"}}}',
        "garbage",
        None,
    ]
    log = to_bronze(records(texts), entity)
    assert [f.name for f in log.schema] == [f.name for f in entity.bronze_schema if f.name != BATCH]
    found = image_columns(log, struct("n bigint, s string")).withColumn("whole", F.to_json("_image"))
    assert rows_of(found, "id", "n", "s") == sorted(
        [("a", 7, "x"), (None, None, None), ("b", None, None), (None, None, None), (None, None, None)], key=repr
    )
    assert rows_of(found.filter("id = 'a'"), "whole") == [('{"deep":{"y":[1,null]},"id":"a","n":7,"s":"x","z":null}',)]
    assert "_image" not in strip_columns(log).columns
