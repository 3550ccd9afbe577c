"""Every registered query against its SQL oracle (DuckDB) on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from stratum.plans.catalog import QUERIES
from stratum.plans.oracle import ORACLE
from tests.conftest import SMALL_SF
from tools.oracle_check import TABLES, norm

@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL_SF}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["yr", "party_name", "seg", "total_amount"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL_SF)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    want = sorted((tuple(norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert got == want
