"""Every registered query against its DuckDB oracle on the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracles import TABLES, rows_of
from tests.conftest import SF_SMALL

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, duck, name):
    sp = E.queries()[name](spark, SF_SMALL).toPandas()
    if name not in ORACLES:
        assert len(sp.columns) > 0
        return
    dd = duck.sql(ORACLES[name]).df()
    sc, sr = rows_of(sp)
    dc, dr = rows_of(dd)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 6
    assert df.columns == ["measure", "count", "percent"]
