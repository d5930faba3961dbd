"""The registered text queries against their SQL counterparts in DuckDB, over whole tables."""

import os
from collections import Counter

import duckdb
import pytest

from fleetmart.llm.queries import QUERIES, SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    result = con.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    got, want = bag(df.columns, df.collect()), bag(names, result.fetchall())
    assert got == want, (list((got - want).elements())[:3], list((want - got).elements())[:3])
    assert sum(got.values()) > 0


@pytest.mark.parametrize(("name", "label", "least"), [("op3_toxicity", "toxic", 0.75), ("op4_quality", "quality", 0.95)])
def test_held_out_ranking(spark, name, label, least):
    """Scores of documents whose labels were not learned rank the labels (small tables hold few toxic rows)."""
    sf = "/root/testdata/sf0.01"
    rows = QUERIES[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").select("score", label, "predicted").collect()
    assert all(0 <= r[0] <= 1 and r[2] == int(r[0] >= 0.3) for r in rows)
    ones, zeros = [r[0] for r in rows if r[1] == 1], [r[0] for r in rows if r[1] == 0]
    area = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / (len(ones) * len(zeros))
    assert area > least
