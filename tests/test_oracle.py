"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SMALL):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{name}'")
    return con


def text_rows(frame):
    columns = sorted(frame.columns)
    return sorted(map(tuple, frame[columns].astype(str).values.tolist()))


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    got = QUERIES[name](spark, SMALL).toArrow()
    want = duck.sql(SQL[name]).to_arrow_table()
    types = lambda t: {f.name: str(f.type).replace("large_", "").replace(", tz=UTC", "") for f in t.schema}
    assert types(got) == types(want)
    assert text_rows(got.to_pandas()) == text_rows(want.to_pandas())


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
