"""Every query with an SQL oracle, on the smallest tables."""

import glob
import os

import duckdb
import pytest
from check_oracles import canonical

import __spark_entry__ as entry_module

BASE = "/root/testdata/sf0.001"
ORACLES = entry_module.oracle_sql()
QUERIES = entry_module.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in glob.glob(f"{BASE}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_three_bands(spark):
    rows = {r["risk_category"]: r["customers"] for r in entry_module.entry(spark).collect()}
    assert set(rows) == {"Low Risk", "Medium Risk", "High Risk"}
    assert rows["Low Risk"] == 0 and sum(rows.values()) == 150


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, con, name):
    df = QUERIES[name](spark, BASE)
    got = canonical(df.columns, df.collect())
    rel = con.execute(ORACLES[name])
    want = canonical([d[0] for d in rel.description], rel.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]
