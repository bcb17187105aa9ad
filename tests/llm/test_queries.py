"""Registered queries over the smallest given tables, against DuckDB or brute force."""

import duckdb
import pytest
from test_dedup import _removed, _substrings
from test_packing import _check_packed, _pieces

import __spark_entry__ as entry
from waymark.llm import suffix_dedup
from waymark.llm.queries import ORACLE_SQL, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    got = [tuple(r) for r in df.collect()]
    found = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    expected = [tuple(r[names.index(c)] for c in df.columns) for r in found.fetchall()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def _documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


def test_suffix_dedup_on_documents(spark):
    out = suffix_dedup.dedup_substrings(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()
    assert _removed(out) == _counts(_substrings(_documents(spark)))
    query = QUERIES["op2_suffix_dedup"](spark, SMALL).collect()
    assert sum(r.n_removed for r in query) == sum(s["end"] - s["start"] for r in out for s in r.spans) > 0


def _counts(rows):
    out = {}
    for r in rows:
        out[r] = out.get(r, 0) + 1
    return out


def test_packing_of_documents(spark):
    out = QUERIES["op3_best_fit_packing"](spark, SMALL).collect()
    assert _counts((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == _counts(_pieces(_documents(spark), 2048))
    assert _check_packed(out, 2048) <= -(-sum(r.length for r in out) // 2048) + 1
