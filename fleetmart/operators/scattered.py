"""Linear interpolation between scattered points, as one join per fact.

A reference table is a cloud of (draft, speed, trim) points with a value, per class; it need not be a grid. Each class's
cloud is cut once into tetrahedra (Delaunay: no point lies inside the sphere through the corners of another one), in one
small task per class. The tetrahedra are stored in the boxes of a regular index that they reach into, one row for each
box with an array of tetrahedra. A fact joins its box and takes the first tetrahedron whose four barycentric weights are
not negative; the weights are columns, the value is their mix. Facts outside the cloud's hull get NULL.

Where more than four points lie on one sphere the cut isn't unique; a fixed, tiny displacement of the points decides, so
it is the same in every run. Points of a class that occur twice count once, with their largest value.

Defined results: NULL coordinates or an unknown class give NULL, points with a NULL coordinate or value are left out; a
class of fewer than five points, or of points on one plane, has at most what its tetrahedra hold; on a face that two
tetrahedra share they give the same value.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.operators.settle import settle

BOXES = 8  # boxes of the index along each axis
EDGE = 1e-9  # weights so far below zero still count as inside
_FACES = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (1, 2, 3))


def _spheres(p: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres and squared radii of the spheres through the corners of cells."""
    a = p[cells[:, 0]]
    edges = p[cells[:, 1:]] - a[:, None]
    to = np.linalg.solve(edges, 0.5 * (edges**2).sum(axis=2)[..., None])[..., 0]
    return a + to, (to**2).sum(axis=1)


def tetrahedra(points: np.ndarray) -> np.ndarray:
    """Corner numbers of the Delaunay tetrahedra of distinct points, one point inserted after the other; flat ones, which hold
    no fact, are left out."""
    n = len(points)
    if n < 4:
        return np.zeros((0, 4), int)
    low, high = points.min(axis=0), points.max(axis=0)
    unit = (points - low) / np.where(high > low, high - low, 1.0)
    moved = unit + 1e-7 * np.random.default_rng(0).uniform(-1, 1, unit.shape)
    around = np.array([[-50, -50, -50], [200, -50, -50], [-50, 200, -50], [-50, -50, 200]], float)
    p = np.vstack([moved, around])
    cells = np.array([[n, n + 1, n + 2, n + 3]])
    centres, radii = _spheres(p, cells)
    for i in range(n):
        hit = ((centres - p[i]) ** 2).sum(axis=1) < radii
        faces = np.sort(np.concatenate([cells[hit][:, f] for f in _FACES]), axis=1)
        faces, times = np.unique(faces, axis=0, return_counts=True)
        fresh = np.column_stack([faces[times == 1], np.full((times == 1).sum(), i)])  # the hole's border, seen from the point
        c, r = _spheres(p, fresh)
        cells, centres, radii = np.concatenate([cells[~hit], fresh]), np.concatenate([centres[~hit], c]), np.concatenate([radii[~hit], r])
    cells = cells[(cells < n).all(axis=1)]
    volume = np.abs(np.linalg.det(unit[cells[:, 1:]] - unit[cells[:, :1]]))
    return cells[volume > 1e-6 * max(1e-3, volume.max(initial=0))]


@dataclass(frozen=True)
class Cloud:
    """Point tables made ready: per class the bounds, and the boxes with their tetrahedra."""

    bounds: DataFrame
    boxes: DataFrame
    axes: tuple[str, str, str]


_CELL = T.StructType([T.StructField(c, T.DoubleType()) for c in [f"w{k}{d}" for k in range(3) for d in "xyz1"] + [f"v{k}" for k in range(4)]])


def _boxes(kind: T.DataType, cls: str, axes: tuple[str, str, str], value: str, boxes: int):
    """From a class's points to its rows (class, i, j, k, cells)."""

    def run(points: pd.DataFrame) -> pd.DataFrame:
        p, v = points[list(axes)].to_numpy(float), points[value].to_numpy(float)
        cells = tetrahedra(p)
        low, high = p.min(axis=0), p.max(axis=0)
        step = np.where(high > low, (high - low) / boxes, 1.0)
        held: dict[tuple, list] = {}
        for cell in cells:
            corners = p[cell]
            # weight k of a point x is (x - corner 3) . column k of the inverse
            inverse = np.linalg.inv(corners[:3] - corners[3])
            row = [x for k in range(3) for x in (*inverse[:, k], -(corners[3] @ inverse[:, k]))] + v[cell].tolist()
            first, last = (np.clip(np.floor((c - low) / step), 0, boxes - 1).astype(int) for c in (corners.min(axis=0), corners.max(axis=0)))
            for i in range(first[0], last[0] + 1):
                for j in range(first[1], last[1] + 1):
                    for k in range(first[2], last[2] + 1):
                        held.setdefault((i, j, k), []).append(dict(zip(_CELL.names, row, strict=True)))
        name = points[cls].iloc[0]
        return pd.DataFrame([(name, *at, listed) for at, listed in sorted(held.items())], columns=[cls, "_i", "_j", "_k", "_cells"])

    schema = T.StructType([T.StructField(cls, kind), *(T.StructField(c, T.IntegerType()) for c in ("_i", "_j", "_k")), T.StructField("_cells", T.ArrayType(_CELL))])
    return run, schema


def cloud(points: DataFrame, cls: str, axes: tuple[str, str, str] = ("draft", "speed", "trim"), value: str = "power", boxes: int = BOXES) -> Cloud:
    """Point tables cut into tetrahedra, worked out once and stored. A class is one table of a ship type, cut in one task."""
    known = [F.col(c).cast("double").alias(c) for c in axes]
    distinct = points.select(cls, *known, F.col(value).cast("double").alias(value)).dropna().groupBy(cls, *axes).agg(F.max(value).alias(value))
    distinct = settle(distinct)
    run, schema = _boxes(points.schema[cls].dataType, cls, axes, value, boxes)
    ordered = distinct.groupBy(cls).applyInPandas(lambda df: run(df.sort_values(list(axes))), schema)
    ends = [f(a).alias(f"_{n}{d}") for f, n in ((F.min, "lo"), (F.max, "hi")) for a, d in zip(axes, "xyz", strict=True)]
    return Cloud(settle(distinct.groupBy(cls).agg(*ends)), settle(ordered), axes)


def _weights(cell: Column, at: dict[str, Column]) -> list[Column]:
    own = [cell[f"w{k}x"] * at["x"] + cell[f"w{k}y"] * at["y"] + cell[f"w{k}z"] * at["z"] + cell[f"w{k}1"] for k in range(3)]
    return [*own, 1 - own[0] - own[1] - own[2]]


def interpolated(facts: DataFrame, ready: Cloud, cls: str, at: tuple[Column, Column, Column], out: str, boxes: int = BOXES) -> DataFrame:
    """Facts with the value at their place, NULL outside. Bounds and boxes are stored tables: Spark broadcasts them by
    their size or else joins them on class, and class and box."""
    valued = facts.withColumns({f"_{d}": c.cast("double") for d, c in zip("xyz", at, strict=True)}).join(ready.bounds, cls, "left")

    def box(d: str) -> Column:
        low, high, x = F.col(f"_lo{d}"), F.col(f"_hi{d}"), F.col(f"_{d}")
        number = F.least(F.floor((x - low) / F.nullif(high - low, F.lit(0.0)) * boxes), F.lit(boxes - 1)).cast("int")
        return F.when((x >= low) & (x <= high), F.coalesce(number, F.lit(0)))

    keyed = valued.withColumns({f"_{n}": box(d) for n, d in zip("ijk", "xyz", strict=True)})
    hit = keyed.join(ready.boxes, [cls, "_i", "_j", "_k"], "left")
    place = {d: F.col(f"_{d}") for d in "xyz"}
    holds = lambda cell: F.least(*_weights(cell, place)) >= -EDGE
    held = hit.withColumn("_cell", F.get(F.filter("_cells", holds), F.lit(0)))
    mix = sum((w * F.col("_cell")[f"v{k}"] for k, w in enumerate(_weights(F.col("_cell"), place))), F.lit(0.0))
    gone = ["_cell", "_cells", "_i", "_j", "_k", *(f"_{n}{d}" for n in ("", "lo", "hi") for d in "xyz")]
    return held.withColumn(out, mix).drop(*gone)
