"""Every registered query against its SQL on the smallest tables."""

import datetime
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from tidemark.queries import all_oracles, all_queries

SF = os.environ.get("TIDEMARK_TEST_TABLES", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return value.isoformat() if isinstance(value, datetime.datetime) else repr(value)


def normalised(columns, rows):
    places = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(plain(r[p]) for p in places) for r in rows)


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())


def test_the_contract_holds_all_queries():
    assert set(all_queries()) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_agrees_with_its_sql(spark, name):
    df = entry_points.queries()[name](spark, SF)
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = con.execute(entry_points.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert normalised(df.columns, df.collect()) == normalised(columns, result.fetchall())


def test_entry_returns_rows(spark):
    assert entry_points.entry(spark).count() > 0
