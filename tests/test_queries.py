"""Every registered driver query against its DuckDB oracle at sf0.001, and the
flagship entry point."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from changeflow.plans.queries import QUERIES
from tools.check_oracles import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        if os.path.exists(path):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return c


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["user_id", "status", "amount", "k", "deleted_at", "_lsn"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    scols, srows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols, orows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(scols) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(scols, srows)[0] == digest(ocols, orows)[0]
