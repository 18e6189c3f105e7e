"""Every registered query against its SQL twin in another engine."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from oreline import checks

TYPES = {
    "boolean": "BOOLEAN",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
}


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    for file in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(file).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{file}'")
    return con


def test_every_query_has_a_twin():
    assert set(checks.QUERIES) == set(checks.ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(checks.QUERIES))
def test_query(spark, sf_dir, oracle, name):
    df = contract.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    cursor = oracle.execute(contract.oracle_sql()[name])
    described = {d[0]: str(d[1]) for d in cursor.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == described
    order = [list(described).index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=repr) == expected
    assert expected


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["learn_date", "student_id", "class_regular_session_id", "study_program"]
    assert df.count() == 3930
    assert df.filter("learn_date is null").count() == 3342
