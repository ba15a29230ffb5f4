"""Every query that has SQL gives the rows that DuckDB gives for it."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from ledgerloom.plans import audit_queries, queries, replay_queries, warehouse_queries

SF = "/root/testdata/sf0.001"
ALL = queries.QUERIES | warehouse_queries.QUERIES | audit_queries.QUERIES | replay_queries.QUERIES
SQL = queries.SQL | warehouse_queries.SQL | audit_queries.SQL | replay_queries.SQL


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def rows(frame):
    cols = sorted(frame.columns)
    values = frame[cols].astype(object)
    return cols, sorted(map(tuple, values.where(values.notna(), None).values.tolist()), key=str)


@pytest.mark.parametrize("name", sorted(ALL))
def test_equals_sql(spark, duck, name):
    found = rows(ALL[name](spark, SF).toPandas())
    assert name in SQL
    assert found == rows(duck.sql(SQL[name]).df())


def test_entry():
    import __spark_entry__ as entry

    assert {*ALL} <= {*entry.queries()} and {*SQL} <= {*entry.oracle_sql()} and entry.oracle_sql().keys() <= entry.queries().keys()
