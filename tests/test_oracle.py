"""Every registered query against its DuckDB SQL twin on the smallest driver tables."""

import duckdb
import pytest

import __spark_entry__ as E
from ledgerlens.plans import registry
from tools.oracle_check import TABLES, table_hash

KEYS = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_every_analytics_query_has_oracle():
    assert set(registry.queries()) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf_small, duck, key):
    sdf = E.queries()[key](spark, sf_small)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert table_hash(sdf.columns, srows, 12)[0] == table_hash(dcols, drows, 12)[0]


def test_entry_flagship(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and "gm_sum" in df.columns and "week_start" in df.columns
