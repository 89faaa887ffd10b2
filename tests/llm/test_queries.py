"""Registered queries with SQL, against DuckDB; and the names of all."""

import re

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, rows_key

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = [n for n in E.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries()


@pytest.mark.parametrize("name", ["op6_license_scan", "op9_exact_dedup", "op12_hard_negatives"])
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_key(df.columns, [tuple(r) for r in df.collect()]) == rows_key(columns, res.fetchall())
