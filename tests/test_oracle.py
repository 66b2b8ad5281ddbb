"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

TABLES = ("lineitem", "orders", "events", "documents", "embeddings", "labels")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return c


def canon(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    fix = lambda v: "NaN" if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(fix(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    onames = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(onames)
    assert canon(df.columns, rows) == canon(onames, res.fetchall())


def test_entry_runs(spark):
    out = E.entry(spark)
    assert out.count() > 0 and "total_trips" in out.columns


def test_every_query_of_the_library_has_an_oracle():
    without = set(E.queries()) - set(E.oracle_sql())
    assert all(k == "pipeline" or k.startswith("op") for k in without)
