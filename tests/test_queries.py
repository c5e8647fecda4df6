"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entries
from tideline.plans.oracles import ORACLES
from tideline.plans.queries import QUERIES

TABLES = ("events", "lineitem")
SPARK_TO_SQL = {
    "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "timestamp": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def _plain(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def _rows(rows):
    return Counter(tuple(_plain(v) for v in row) for row in rows)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert ORACLES.items() <= entries.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, name):
    frame = entries.queries()[name](spark, sf_dir)
    columns = sorted(frame.columns)
    found = _rows(frame.select(*[f"`{c}`" for c in columns]).collect())

    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    result = connection.sql(entries.oracle_sql()[name])
    assert sorted(result.columns) == columns
    types = dict(zip(result.columns, map(str, result.types)))
    assert {f.name: SPARK_TO_SQL[f.dataType.simpleString()] for f in frame.schema} == types
    order = [result.columns.index(c) for c in columns]
    expected = _rows(tuple(row[i] for i in order) for row in result.fetchall())
    assert found == expected


def test_entry(spark):
    frame = entries.entry(spark)
    assert frame.columns[-1] == "slope_per_day"
    assert frame.count() > 0
