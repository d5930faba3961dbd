"""Every registered query against its SQL counterpart in DuckDB, over whole tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

from fleetmart.plans.catalog import all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return None if v is None else str(v)


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", list(all_queries()))
def test_matches_sql(spark, duck, name):
    q = all_queries()[name]
    assert q.sql, "every query here has a SQL counterpart"
    df = q.run(spark, SF_DIR)
    got = bag(df.columns, df.collect())
    result = duck.execute(q.sql)
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    want = bag(names, result.fetchall())
    assert got == want, (list((got - want).elements())[:3], list((want - got).elements())[:3])
    if name != "ledger_watermark":
        assert sum(got.values()) > 0
