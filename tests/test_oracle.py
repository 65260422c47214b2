"""Every query with an oracle matches DuckDB on sf0.001 (the driver checks sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, canon

SF = "/root/testdata/sf0.001"
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert canon(srows, df.columns) == canon(drows, dcols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["tax_year", "lower_bound", "upper_bound", "property_count"]
    assert df.count() > 0


ROWS_ONLY = sorted(set(E.queries()) - set(ORACLE))


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_queries_run(spark, name):
    df = E.queries()[name](spark, SF)
    assert len(set(df.columns)) == len(df.columns)
    assert df.count() > 0
