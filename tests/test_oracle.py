"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from weir.plans import catalog, oracle
from weir.plans.fixtures import TABLES

SF = "/root/testdata/sf0.001"
ORACLE = oracle.oracle_sql()


def _canon(cols, rows):
    import sys, os
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "scripts"))
    from check_oracle import digest
    return digest(cols, rows)[0]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _canon(df.columns, srows) == _canon(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["path", "events", "bytes"]
    assert df.count() > 0
