"""Every registered query against its SQL in DuckDB on the smallest tables."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from jornada.catalogue import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    expected = Counter(tuple(plain(v) for v in row) for row in cursor.fetchall())
    assert Counter(tuple(plain(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect()) == expected


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
