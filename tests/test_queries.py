"""Every registered query, compared with its SQL twin at the smallest scale."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = Counter(tuple(tuple(r[c]) if isinstance(r[c], list) else r[c] for c in columns) for r in df.collect())
    assert got
    if name in SQL:
        cur = duck.execute(SQL[name])
        names = [c[0] for c in cur.description]
        assert sorted(names) == columns
        want = Counter(tuple(r[names.index(c)] for c in columns) for r in cur.fetchall())
        assert got == want


def test_flagship(spark):
    assert entry.entry(spark).columns == ["wind_bin", "point_of_sail", "n", "sum_vmc"]
