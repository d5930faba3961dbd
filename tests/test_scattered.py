"""Scattered tables against brute force: Delaunay property, hull, affine values, missing nodes, flat and small clouds."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetmart.operators import interpolate as I
from fleetmart.operators import scattered as X

SCHEMA = "ship_class string, draft double, speed double, trim double, power double"


def read(spark, points, at):
    cloud = X.cloud(spark.createDataFrame(points, SCHEMA), "ship_class")
    facts = spark.createDataFrame([(i, *a) for i, a in enumerate(at)], "id int, ship_class string, a double, b double, c double")
    out = X.interpolated(facts, cloud, "ship_class", (F.col("a"), F.col("b"), F.col("c")), "power")
    assert out.columns == ["ship_class", "id", "a", "b", "c", "power"] and out.count() == len(at)
    return {r.id: r.power for r in out.collect()}


def brute_cells(points):
    """Every four points whose sphere holds no other point."""
    found = set()
    for cell in itertools.combinations(range(len(points)), 4):
        edges = points[list(cell[1:])] - points[cell[0]]
        if abs(np.linalg.det(edges)) < 1e-9:
            continue
        centre = points[cell[0]] + np.linalg.solve(edges, 0.5 * (edges**2).sum(axis=1))
        radius = ((points[cell[0]] - centre) ** 2).sum()
        if all(((points[i] - centre) ** 2).sum() >= radius for i in range(len(points)) if i not in cell):
            found.add(cell)
    return found


def value(points, values, cells, x):
    for cell in cells:
        p = points[list(cell)]
        w = np.linalg.solve(np.vstack([p.T, np.ones(4)]), [*x, 1])
        if (w >= -1e-9).all():
            return float(w @ values[list(cell)])
    return None


@pytest.mark.parametrize("seed", range(4))
def test_tetrahedra_are_delaunay(seed):
    points = np.random.default_rng(seed).uniform(0, 1, (18, 3))
    points = (points - points.min(axis=0)) / (points.max(axis=0) - points.min(axis=0))  # the cut is made in units of the axes
    assert {tuple(sorted(c)) for c in X.tetrahedra(points).tolist()} == brute_cells(points)


def test_values_against_brute_force(spark):
    rng = np.random.default_rng(7)
    table, at, want = [], [], []
    for name in ("A", "B"):
        points = rng.uniform(0, 1, (25, 3))
        points = (points - points.min(axis=0)) / (points.max(axis=0) - points.min(axis=0))
        values = rng.uniform(100, 200, 25)
        cells = brute_cells(points)
        table += [(name, *map(float, p), float(v)) for p, v in zip(points, values)]
        for x in [*rng.uniform(-0.1, 1.1, (150, 3)), *points, *(points[:5] + points[5:10]) / 2]:
            at.append((name, *map(float, x)))
            want.append(value(points, values, cells, x))
    at += [("C", 0.5, 0.5, 0.5), (None, 0.5, 0.5, 0.5), ("A", None, 0.5, 0.5), ("A", math.nan, 0.5, 0.5)]
    got = read(spark, table, at)
    assert 50 < sum(w is not None for w in want) < len(want)
    for i, w in enumerate(want):
        assert (got[i] is None) == (w is None) and (w is None or math.isclose(got[i], w, rel_tol=1e-6)), (at[i], got[i], w)
    assert all(got[i] is None for i in range(len(want), len(at)))


def test_grid_with_a_node_missing(spark):
    """Where the regular reading has a hole, the cloud closes it; an affine table is met exactly, at the nodes any table."""
    power = lambda d, s, t: 3 * d - 2 * s + 5 * t + 7
    nodes = [(d, s, t) for d in (8.0, 10.0, 13.0) for s in (10.0, 12.0, 15.0) for t in (-1.0, 0.0, 2.0)]
    whole = [("A", *n, power(*n)) for n in nodes if n != (10.0, 12.0, 0.0)]
    at = [("A", float(d), float(s), float(t)) for d, s, t in np.random.default_rng(1).uniform([8, 10, -1], [13, 15, 2], (200, 3))]
    got = read(spark, whole, at)
    assert all(math.isclose(got[i], power(*a[1:]), rel_tol=1e-9) for i, a in enumerate(at))
    facts = spark.createDataFrame([(9.0, 11.0, 0.5)], "a double, b double, c double").withColumn("ship_class", F.lit("A"))
    regular = I.grid_power(facts, spark.createDataFrame(whole, SCHEMA), "ship_class", F.col("a"), F.col("b"), F.col("c"), "p")
    assert regular.first()["p"] is None
    odd = [("A", *n, math.sin(i) * 50) for i, n in enumerate(nodes)]
    got = read(spark, odd, [r[:4] for r in odd])
    assert all(math.isclose(got[i], r[4], rel_tol=1e-6, abs_tol=1e-6) for i, r in enumerate(odd))


def test_small_flat_and_repeated_clouds(spark):
    corners = [(0.0, 0.0, 0.0), (1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, 1.0)]
    points = [("three", *p, 1.0) for p in corners[:3]] + [("flat", x, y, 0.0, 1.0) for x in (0.0, 1.0) for y in (0.0, 1.0)]
    points += [("four", *p, v) for p, v in zip(corners, (0.0, 1.0, 2.0, 3.0))] + [("four", *corners[3], 9.0), ("four", 0.5, None, 0.5, 4.0), ("four", 0.1, 0.1, 0.1, None)]
    got = read(spark, points, [("three", 0.2, 0.2, 0.0), ("flat", 0.5, 0.5, 0.0), ("four", 0.25, 0.25, 0.25), ("four", 0.6, 0.6, 0.6), ("four", 0.0, 0.0, 1.0)])
    assert got[0] is None and got[1] is None and math.isclose(got[2], 0.25 * (1 + 2 + 9)) and got[3] is None and math.isclose(got[4], 9.0)
    assert read(spark, [], [("A", 0.0, 0.0, 0.0)]) == {0: None}


def test_one_join_on_the_box(spark):
    table = [("A", float(x), float(y), float(z), 1.0) for x in range(3) for y in range(3) for z in range(3)]
    cloud = X.cloud(spark.createDataFrame(table, SCHEMA), "ship_class")
    facts = spark.range(1000).selectExpr("CASE WHEN id % 2 = 0 THEN 'A' ELSE 'B' END AS ship_class", "id % 3 / 1.5 AS a", "id % 7 / 3.5 AS b", "id % 5 / 2.5 AS c")
    plan = X.interpolated(facts, cloud, "ship_class", (F.col("a"), F.col("b"), F.col("c")), "power")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan and plan.count("HashJoin") + plan.count("SortMergeJoin") <= 4
