"""Queries over files and stores against their SQL."""

from collections import Counter

import duckdb
import pytest

from skein import file_queries  # noqa: F401
from skein import queries

D = "/root/testdata/sf0.001"
NAMES = [n for n in queries.SQL if n.split("_")[0] in {f"q{k}" for k in (74, 75, 76, 77, 78, 80, 81, 82, 83, 84, 85, 86, 87)}]


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("part", "lineitem", "customer", "supplier", "orders", "embeddings"):
        con.sql(f"create view {t} as select * from '{D}/{t}.parquet'")
    want = con.sql(queries.SQL[name])
    got = queries.Q[name](spark, D)
    assert sorted(got.columns) == sorted(want.columns)
    assert Counter(map(tuple, got.select(*want.columns).collect())) == Counter(want.fetchall())
