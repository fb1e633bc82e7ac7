"""Every registered query against its DuckDB oracle (the driver's gate, at sf0.001)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_mod
from tessera.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    # queries of the optional subpackage that SQL cannot express are tested beside it
    assert set(QUERIES) == set(ORACLES)
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "sequence"


@pytest.mark.parametrize("name", sorted(entry_mod.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry_mod.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    srows = sorted(repr(tuple(_norm(r[c]) for c in cols)) for r in sdf.collect())
    rel = duck.sql(entry_mod.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    drows = sorted(repr(tuple(_norm(r[i]) for i in idx)) for r in rel.fetchall())
    assert srows == drows
