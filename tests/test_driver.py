"""Every registered driver query against its DuckDB oracle on the smallest tables."""
import math

import duckdb
import pytest

import __spark_entry__ as entry
from waymark.plans import driver
from waymark.sources.tables import DRIVER_TABLES, table_path

from conftest import SF_SMALL, plan_text

QUERIES = {k: v for k, v in entry.queries().items() if k in driver.QUERIES}
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 6)
    return v.isoformat() if hasattr(v, "isoformat") else v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return con


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = df.collect()
    res = duck.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, rows) == _rows(ocols, res.fetchall())
    text = plan_text(df)
    for slow in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert slow not in text, f"{name} runs Python in its plan"
    assert "ExistingRDD" not in text, f"{name} scans an RDD"
    for pairs in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert pairs not in text, f"{name} pairs every row with every row"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
