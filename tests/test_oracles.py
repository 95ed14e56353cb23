"""Every registered query with an oracle agrees with DuckDB at sf0.001."""

import hashlib
import os

import duckdb
import pytest

import __spark_entry__ as entry
from paths import SF_SMALL

TABLES = ["region", "nation", "customer", "orders", "lineitem", "events", "documents", "embeddings", "benchmark",
          "pages", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6))
    return str(v)


def _digest(rows):
    return hashlib.sha1("\n".join(sorted("|".join(map(_norm, r)) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    srows = [tuple(r[c] for c in cols) for r in df.collect()]
    rel = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    idx = sorted(range(len(dcols)), key=lambda i: dcols[i])
    drows = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    assert cols == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(srows) == _digest(drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["origin", "head_rev", "tree_id", "revision_id", "snapshot_id"]
