from __future__ import annotations

import re
from pathlib import Path

import duckdb
import pytest

from ledgerloom.llm import registry


def test_one_query_for_each_operator():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in registry.QUERIES] == sorted(int(re.match(r"op(\d+)_", n)[1]) for n in registry.QUERIES) == list(range(1, 14))
    assert registry.SQL.keys() <= registry.QUERIES.keys()


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_equals_sql(spark, sf, name):
    sf = sf.replace("0.001", "0.01")
    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    want = con.sql(registry.SQL[name]).df()
    cols = sorted(want.columns)
    found = registry.QUERIES[name](spark, sf).toPandas()
    assert sorted(found.columns) == cols
    told = lambda d: sorted(map(tuple, d[cols].astype(object).values.tolist()), key=str)
    assert told(found) == told(want)
