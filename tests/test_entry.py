"""The registered queries against their SQL oracle on the smallest test tables."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF001
from speechlens.plans import catalog

TABLES = ["documents", "benchmark", "labels", "conversations", "embeddings"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["query_id", "rank", "doc_id", "speech_start", "name",
                          "political_party", "date", "score"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) & set(catalog.QUERIES)))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF001)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(sdf.columns, srows) == _digest(dcols, drows)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(entry.oracle_sql())))
def test_query_without_oracle_runs(spark, name):
    assert entry.queries()[name](spark, SF001).count() > 0
