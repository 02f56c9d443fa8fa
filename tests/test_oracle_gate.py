"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "pages"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    return "∅" if v is None else (v.isoformat() if hasattr(v, "isoformat") else str(v))


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


import __spark_entry__ as E
from balancete import registry  # noqa: E402

NAMES = sorted(registry.QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    sql = E.oracle_sql().get(name)
    assert sql is not None, "every registered query has an oracle"
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == _rows(cols, cur.fetchall())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "COMPETENCIA"
    assert df.count() > 0
