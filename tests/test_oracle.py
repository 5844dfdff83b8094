"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as se  # noqa: E402
from catalog import queries as _q  # noqa: E402
from compare import TABLES, digest  # noqa: E402

SF = "/root/testdata/sf0.001"
ORACLE = se.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(_q.REGISTRY))
def test_query_matches_oracle(spark, con, name):
    df = se.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    assert name in ORACLE, f"{name} has no oracle"
    rel = con.sql(ORACLE[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(rel.columns, orows)[0]


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert set(df.columns) >= {"period_grain", "period_start", "active_users", "churned_users"}
    assert df.count() > 0
