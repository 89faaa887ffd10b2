"""Every registered query against its DuckDB oracle on the smallest tables."""


import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from lakeforge.plans.catalog import REGISTRY
from tools.oracle_check import TABLES, rows_key

ORACLE = E.oracle_sql()
NAMES = sorted(REGISTRY)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["activity_hour", "net", "total_event", "avg_mag", "max_mag", "hash_id"]


def test_every_query_is_registered_and_has_an_oracle():
    assert set(NAMES) <= set(E.queries()) and set(NAMES) <= set(ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    scols, srows = df.columns, [tuple(r) for r in df.collect()]
    assert srows  # a query without rows shows nothing
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert sorted(c.lower() for c in scols) == sorted(c.lower() for c in ocols)
    assert rows_key(scols, srows) == rows_key(ocols, res.fetchall())
