"""Ordered operators against plain Python, with one key holding most of the rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from fleetmart.operators import joins as J
from fleetmart.operators import timeline as TL

T0 = dt.datetime(2024, 1, 1)


def data(seed=3, n=400):
    r = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if r.random() < 0.6 else r.choice(["a", "b", None])
        ts = None if r.random() < 0.03 else T0 + dt.timedelta(seconds=r.randrange(0, 6 * 86400), microseconds=r.randrange(10**6))
        out.append((i, key, ts, r.choice([None, float(r.randrange(50))]), r.random() < 0.2))
    return out


SCHEMA = "id int, k string, ts timestamp, v double, mark boolean"


@pytest.mark.parametrize("width", [3600, TL.DAY, 30 * TL.DAY])
def test_context_equals_plain_scan(spark, width):
    src = data()
    out = TL.with_context(spark.createDataFrame(src, SCHEMA), ["k"], ["ts", "id"], lag={"p": "v", "pid": "id"}, lead={"nid": "id"}, fill={"f": "v"}, first={"fid": "id"}, width=width)
    got = {r["id"]: (r["p"], r["pid"], r["nid"], r["f"], r["fid"]) for r in out.collect()}
    assert len(got) == len(src)
    for key in ("hot", "a", "b"):
        line = sorted([x for x in src if x[1] == key and x[2]], key=lambda x: (x[2], x[0]))
        known = None
        for i, x in enumerate(line):
            known = x[3] if x[3] is not None else known
            prev, nxt = (line[i - 1] if i else None), (line[i + 1] if i + 1 < len(line) else None)
            assert got[x[0]] == (prev and prev[3], prev and prev[0], nxt and nxt[0], known, line[0][0])
    for x in src:
        if x[1] is None or x[2] is None:
            assert got[x[0]] == (None,) * 5


@pytest.mark.parametrize("how", ["left", "inner"])
def test_asof_equals_brute_force(spark, how):
    src = data(5)
    left = [x for x in src if x[0] % 2 == 0]
    right = [x for x in src if x[0] % 2 == 1]
    right += [(1000 + x[0], x[1], x[2], x[3], x[4]) for x in right[:40]]  # ties in time
    tol = 7200
    out = TL.asof_nearest(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), ["k"], "ts", "ts", tol, {"rid": "id"}, ["id"], how)
    got = {r["id"]: r["rid"] for r in out.collect()}
    for x in left:
        best = min(
            (abs((x[2] - y[2]).total_seconds()), y[2], y[0]) for y in right if x[1] and y[1] == x[1] and x[2] and y[2] and abs((x[2] - y[2]).total_seconds()) <= tol
        )[2] if any(x[1] and y[1] == x[1] and x[2] and y[2] and abs((x[2] - y[2]).total_seconds()) <= tol for y in right) else None
        if how == "inner" and best is None:
            assert x[0] not in got
        else:
            assert got[x[0]] == best


def test_asof_edges(spark):
    left = spark.createDataFrame([(1, "a", T0)], "id int, k string, ts timestamp")
    for gap, hit in ((0, True), (3600, True), (-3600, True), (3601, False)):
        right = spark.createDataFrame([(9, "a", T0 + dt.timedelta(seconds=gap))], "id int, k string, ts timestamp")
        assert (TL.asof_nearest(left, right, ["k"], "ts", "ts", 3600, {"r": "id"}, ["id"]).first()["r"] == 9) == hit
    both = spark.createDataFrame([(7, "a", T0 + dt.timedelta(seconds=60)), (8, "a", T0 - dt.timedelta(seconds=60))], "id int, k string, ts timestamp")
    assert TL.asof_nearest(left, both, ["k"], "ts", "ts", 3600, {"r": "id"}, ["id"]).first()["r"] == 8  # earlier one


def test_followers(spark):
    src = data(8)
    out = TL.without_follower(spark.createDataFrame(src, SCHEMA), ["k"], "ts", F.col("mark"))
    got = {r["id"] for r in out.collect()}
    for x in src:
        if x[4] or not x[2]:
            continue
        end = dt.datetime.combine(x[2].date() + dt.timedelta(days=2), dt.time())
        followed = x[1] is not None and any(y[4] and y[1] == x[1] and y[2] and x[2] <= y[2] <= end for y in src)
        assert (x[0] in got) == (not followed)


def test_range_min(spark):
    src = [x for x in data(9) if x[1] and x[2]]
    got = {r["id"]: r["m"] for r in TL.range_min(spark.createDataFrame(src, SCHEMA), ["k"], "ts", "v", 1800, "m").collect()}
    sec = lambda t: int((t - T0).total_seconds())
    for x in src:
        near = [y[3] for y in src if y[1] == x[1] and abs(sec(y[2]) - sec(x[2])) <= 1800 and y[3] is not None]
        assert got[x[0]] == (min(near) if near else None)


def test_salted_join_keeps_every_row(spark):
    fact = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("k"), "id")
    side = spark.createDataFrame([("hot", 1), ("hot", 2), ("7", 3), ("x", 4)], "k string, w int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = rows(fact.join(side, "k", how))
        assert rows(J.salted_join(fact, side, ["k"], how, salts=8, hot_rows=500)) == want
        assert rows(J.fact_join(fact, side, ["k"], how, max_rows=1, hot_rows=500)) == want
        assert rows(J.fact_join(fact, side, ["k"], how, computed=True)) == want
    with pytest.raises(ValueError):
        J.fact_join(fact, side, ["k"], "right")


def test_settled_copies_live_in_the_named_folder(spark):
    from fleetmart.operators.settle import settle

    copy = settle(spark.range(5))
    assert spark.conf.get("spark.checkpoint.dir") in copy.inputFiles()[0] and copy.count() == 5
    assert not J.is_small(spark.range(11), 10) and J.is_small(spark.range(10), 10)


def test_interval_join_equals_brute_force(spark):
    r = random.Random(4)
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    facts = [(i, r.choice("ab"), day(r.randrange(0, 200))) for i in range(200)]
    spans = [(j, r.choice("ab"), day(s := r.randrange(-50, 180)), None if r.random() < 0.3 else day(s + r.randrange(-3, 90))) for j in range(40)]
    f = spark.createDataFrame(facts, "id int, imo string, d date")
    s = spark.createDataFrame(spans, "sid int, imo string, lo date, hi date")
    want = sorted((a[0], b[0]) for a in facts for b in spans if a[1] == b[1] and b[2] <= a[2] <= (b[3] or day(150)))
    for extra in ({}, {"bucket_days": 5}, {"clip": ("2024-01-01", "2024-08-01")}):
        out = J.interval_join(f, s, "imo", "d", "lo", "hi", str(day(150)), **extra)
        assert sorted((x["id"], x["sid"]) for x in out.collect()) == want


def test_top_row_is_one_whole_row(spark):
    df = spark.createDataFrame([("a", 1, None, 5), ("a", 2, "x", None), ("b", 1, "y", 1)], "k string, n int, s string, v int")
    assert rows(TL.top_row(df, ["k"], ["n"])) == [("a", 2, "x", None), ("b", 1, "y", 1)]


def test_no_key_is_one_task_and_no_pairs(spark):
    """Windows are cut by time bucket, joins are equi joins, nothing runs in Python."""
    src = spark.createDataFrame(data(), SCHEMA)
    frames = [
        TL.with_context(src, ["k"], ["ts", "id"], lag={"p": "v"}, fill={"f": "v"}),
        TL.asof_nearest(src, src, ["k"], "ts", "ts", 3600, {"r": "id"}, ["id"]),
        TL.without_follower(src, ["k"], "ts", F.col("mark")),
        TL.range_min(src, ["k"], "ts", "v", 60, "m"),
    ]
    for df in frames:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan
