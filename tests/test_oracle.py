"""Every query with SQL gives the rows that DuckDB gives, at the smallest scale."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = lambda v: round(v, 6) if isinstance(v, float) and not math.isnan(v) else v
    return sorted(names), sorted((tuple(plain(v[i]) for i in order) for v in values), key=repr)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    want = duck.sql(entry.oracle_sql()[name])
    got = entry.queries()[name](spark, SF)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


def test_every_query_runs(spark):
    without = sorted(set(entry.queries()) - set(entry.oracle_sql()))
    for name in without:
        assert entry.queries()[name](spark, SF).columns, name
    assert entry.entry(spark).count() > 0
