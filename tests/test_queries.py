"""Every registered query against its DuckDB oracle on sf0.001 (the same
gate the driver applies at sf0.01)."""
import duckdb
import pytest

import __spark_entry__ as E
from genoflux.queries import registry
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(registry.all_queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    oracle = E.oracle_sql().get(name)
    if oracle is None:
        pytest.skip("no oracle")
    cur = con.execute(oracle)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["id", "status"]
    assert df.count() > 0
