"""Every registered query against its SQL twin at the smallest scale."""

import glob
import os

import duckdb
import pytest
from check_oracle import compare

import __spark_entry__ as contract

BASE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(BASE), reason="no test data")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in glob.glob(f"{BASE}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


# Long fits without a twin; test_cluster covers them on small vectors.
FITS = {"sweep_k", "cluster_corpus"}


@pytest.mark.parametrize("name", [n for n in contract.queries() if n not in FITS])
def test_query_matches_sql(spark, con, name):
    got = contract.queries()[name](spark, BASE).toPandas()
    assert len(got) > 0
    sql = contract.oracle_sql().get(name)
    if sql is not None:
        assert compare(got, con.execute(sql).df()) == "ok"


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["cluster_label", "disposition", "n_rows", "pct_of_cluster"]
    assert df.count() > 0


def test_every_sql_twin_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
