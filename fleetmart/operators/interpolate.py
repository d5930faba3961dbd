"""Interpolation on reference curves and grids, as joins with precomputed pieces.

A grid row belongs to a class and a (draft, speed, trim) node of a regular grid. The grid is turned once into *cells*
that hold their eight corner values. A fact row then needs one equi join to its cell; the rest is arithmetic in
generated code. Outside the grid, or where a corner is missing, the result is NULL.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from fleetmart.functions.columns import ratio
from fleetmart.operators.settle import settle

# Trim table class and limit (percent) per ship number.
TRIM_LIMITS = {
    "5500TEU": {"9290799": 1.2},
    "5600TEU": {"9535199": 7.0},
    "6500TEU": {"9306287": 30.5, "9306184": 29.0, "9306160": 28.0},
    "6600TEU": {"9395525": 20.3, "9400071": 20.3},
    "D37": {"9102095": 13.5, "9178202": 35.3, "9124469": 29.1, "9178197": 19.9},
    "N43": {"9414060": 9.5, "9414084": 7.3},
    "C38": {"9680102": 13.3},
    "CHR": {"9428449": 2.1, "9428451": 2.2, "9478286": 3.5, "9478298": 2.1, "9478303": 1.7, "9478315": 1.7},
}
# Engine load (percent) at which a ship's consumption curve is read.
CURVE_LOAD = {imo: 80.0 for imo in (*TRIM_LIMITS["D37"], *TRIM_LIMITS["N43"], *TRIM_LIMITS["C38"])}
# Domain searched for the ideal trim.
TRIM_LOW, TRIM_HIGH, TRIM_STEPS = -2.0, 4.0, 50


def trim_limit_rows(limits: Mapping[str, Mapping[str, float]] = TRIM_LIMITS) -> list[tuple[str, str, float]]:
    return [(imo, cls, lim) for cls, ships in limits.items() for imo, lim in ships.items()]


def on_line(x: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Value at x of the line through two points; the first point's value when they coincide."""
    return F.when(x0 == x1, y0).otherwise(y0 + (y1 - y0) * ratio(x - x0, x1 - x0))


def curve_at(curve: DataFrame, key: str, x: str, ys: list[str], at: Column, digits: int = 6) -> DataFrame:
    """Each key's curve read at one point by linear interpolation; NULL outside the curve.

    The bracketing points come from one map-side-combined aggregation, without sorting the curve.
    """
    point = F.struct(F.col(x).alias("x"), *[F.col(y).alias(y) for y in ys])
    low = F.max_by(point, F.when(F.col(x) <= at, F.col(x))).alias("_lo")
    high = F.min_by(point, F.when(F.col(x) >= at, F.col(x))).alias("_hi")
    lo, hi = F.col("_lo"), F.col("_hi")
    read = curve.groupBy(key).agg(low, high, F.max(at).alias("_at"))
    return read.select(
        key, *[F.round(on_line(F.col("_at"), lo["x"], lo[y], hi["x"], hi[y]), digits).alias(y) for y in ys]
    )


def with_curve_floor(reports: DataFrame, curve: DataFrame, loads: Mapping[str, float] = CURVE_LOAD) -> DataFrame:
    """Reports (imo) with their ship's consumption curve read at its load: ``sfoc_st``, ``sfoc_min`` and ``sfoc_max``, NULL
    for ships without a curve or outside it. ``curve`` holds (imo, mrc_load, sfoc, sfoc_tolereance_min,
    sfoc_tolereance_max); engine maintenance of tankers is judged by ``sfoc_min``."""
    at = F.create_map(*[F.lit(x) for pair in loads.items() for x in pair])
    points = curve.select(
        F.col("imo").cast("string").alias("_imo"), F.col("mrc_load").cast("double").alias("x"), F.col("sfoc").alias("sfoc_st"),
        F.col("sfoc_tolereance_min").alias("sfoc_min"), F.col("sfoc_tolereance_max").alias("sfoc_max"),
    ).filter(F.col("_imo").isin(list(loads)))
    read = curve_at(points, "_imo", "x", ["sfoc_st", "sfoc_min", "sfoc_max"], at[F.col("_imo")])
    return reports.join(read, F.col("imo").cast("string") == F.col("_imo"), "left").drop("_imo")


AXES = ("draft", "speed", "trim")


def axes(nodes: DataFrame, cls: str) -> DataFrame:
    """Sorted node values of each axis per class; as long as the reference grid's axes."""
    return nodes.groupBy(cls).agg(*[F.array_sort(F.collect_set(a)).alias(f"_{a}s") for a in AXES])


def corner_rows(nodes: DataFrame, lines: DataFrame, cls: str, dims: tuple[str, ...] = AXES) -> DataFrame:
    """Grid cells over ``dims``: lower node, next node (``_<dim>1``) and corner values ``_p<bits>``, one bit per dim.

    Each dim doubles the corners with one look ahead along its lines of nodes; a look that passes over a missing
    node finds another one than the axis says, and leaves NULL corners.
    """
    def following(d: str) -> Column:
        return F.array_min(F.filter(f"_{d}s", lambda v: v > F.col(d)))

    out, corners = nodes.join(lines, cls), ["_p"]
    for d in dims:
        along = Window.partitionBy(cls, *[a for a in AXES if a != d]).orderBy(d)
        ahead = F.lead(F.struct(F.col(d).alias("at"), *corners)).over(along)
        out = out.withColumn("_far", ahead).withColumn(f"_{d}1", following(d))
        met = F.col("_far.at") == F.col(f"_{d}1")
        sides = {f"{c}0": F.col(c) for c in corners} | {f"{c}1": F.when(met, F.col(f"_far.{c}")) for c in corners}
        out = out.filter(F.col(f"_{d}1").isNotNull()).withColumns(sides).drop("_far", *corners)
        corners = [f"{c}{bit}" for c in corners for bit in "01"]
    return out.drop(*[f"_{a}s" for a in AXES])


@dataclass(frozen=True)
class Cells:
    """A grid made ready: its cells with eight corners each, its axes per class, and the longest of them."""

    rows: DataFrame
    lines: DataFrame
    longest: Row


def grid_cells(grid: DataFrame, cls: str) -> Cells:
    """The cells of a (small) reference grid, worked out once and stored, for any number of readings."""
    nodes = settle(grid.groupBy(cls, *AXES).agg(F.max("power").alias("_p")))
    lines = settle(axes(nodes, cls))
    longest = lines.agg(*[F.max(F.size(f"_{a}s")).alias(a) for a in AXES]).first()
    return Cells(settle(corner_rows(nodes, lines, cls)), lines, longest)


UNROLLED_NODES = 64


def node_below(axis: Column, x: Column, longest: int) -> Column:
    """Lower end of the axis interval that holds x; the last interval includes its upper end.

    Axes of ordinary length are searched by plain comparisons, which stay in generated code.
    """
    if longest > UNROLLED_NODES:
        low = F.array_max(F.filter(F.slice(axis, 1, F.greatest(F.size(axis) - 1, F.lit(1))), lambda v: v <= x))
    else:
        steps = [
            F.when((F.size(axis) > i + 1) & (F.get(axis, F.lit(i)) <= x), F.get(axis, F.lit(i))) for i in reversed(range(max(longest - 1, 1)))
        ]
        low = F.coalesce(*steps)
    return F.when(x <= F.element_at(axis, -1), low)


def blend(corners: Mapping[str, Column], shares: list[Column]) -> Column:
    """Multilinear mix of corner values ({bits: value}); shares are the position in the cell, 0 to 1 per dim."""
    level = dict(corners)
    for i in reversed(range(len(shares))):
        level = {b[:i]: level[b[:i] + "0"] * (1 - shares[i]) + level[b[:i] + "1"] * shares[i] for b in {k[:i] + "0" for k in level}}
    return level[""]


def in_cells(facts: DataFrame, ready: Cells, cells: DataFrame, cls: str, at: Mapping[str, Column]) -> DataFrame:
    """Facts with the columns of the cell they fall into (NULL outside) and ``_s_<axis>``, their position in it from
    0 to 1; ``at`` is {axis: fact value}. Each step is its own projection, so no expression is repeated inside
    another one. Axes and cells are stored tables: Spark broadcasts them by their size or else joins them."""
    valued = facts.withColumns({f"_x_{a}": x for a, x in at.items()}).join(ready.lines, cls, "left")
    placed = valued.withColumns({f"_{a}0": node_below(F.col(f"_{a}s"), F.col(f"_x_{a}"), ready.longest[a] or 0) for a in at})
    keyed = cells.withColumnsRenamed({a: f"_{a}0" for a in at})
    hit = placed.drop(*[f"_{a}s" for a in AXES]).join(keyed, [cls, *[f"_{a}0" for a in at]], "left")
    within = lambda a: ratio(F.col(f"_x_{a}") - F.col(f"_{a}0"), F.col(f"_{a}1") - F.col(f"_{a}0"))
    return hit.withColumns({f"_s_{a}": within(a) for a in at}).drop(*[f"_x_{a}" for a in at], *[f"_{a}{n}" for a in at for n in "01"])


def grid_power(facts: DataFrame, grid: DataFrame | Cells, cls: str, draft: Column, speed: Column, trim: Column, out: str) -> DataFrame:
    """Trilinear power at each fact's (draft, speed, trim)."""
    ready = grid if isinstance(grid, Cells) else grid_cells(grid, cls)
    hit = in_cells(facts, ready, ready.rows, cls, {"draft": draft, "speed": speed, "trim": trim})
    corners = {f"{i:03b}": F.col(f"_p{i:03b}") for i in range(8)}
    power = blend(corners, [F.col(f"_s_{a}") for a in AXES])
    return hit.withColumn(out, power).drop(*[f"_p{b}" for b in corners], *[f"_s_{a}" for a in AXES])


def candidate_lines(flat: DataFrame, cls: str) -> DataFrame:
    """Per (draft, speed) cell, the candidate trims worth a look with their four corner values.

    Power is linear between trim nodes, so within each stretch only the first and last candidate can be
    the least: the list is at most twice as long as the trim axis.
    """
    step = (TRIM_HIGH - TRIM_LOW) / (TRIM_STEPS - 1)
    index = lambda c, way: way((c - TRIM_LOW) / step).cast("int")
    lo = F.greatest(index(F.col("trim") - 1e-12, F.ceil), F.lit(0))
    hi = F.least(index(F.col("_trim1") + 1e-12, F.floor), F.lit(TRIM_STEPS - 1))
    ends = flat.withColumns({"_lo": lo, "_hi": hi}).filter("_lo <= _hi").withColumn("_i", F.explode(F.array_distinct(F.array("_lo", "_hi"))))
    t = F.lit(TRIM_LOW) + F.col("_i") * F.lit(step)
    w = ratio(t - F.col("trim"), F.col("_trim1") - F.col("trim"))
    along = {b: F.col(f"_p{b}0") * (1 - w) + F.col(f"_p{b}1") * w for b in ("00", "01", "10", "11")}
    known = ends.select(cls, "draft", "_draft1", "speed", "_speed1", t.alias("t"), *[v.alias(f"p{b}") for b, v in along.items()]).dropna()
    line = F.array_sort(F.collect_set(F.struct("t", "p00", "p01", "p10", "p11"))).alias("_line")
    return known.groupBy(cls, "draft", "speed", "_draft1", "_speed1").agg(line)


def ideal_trim(facts: DataFrame, grid: DataFrame | Cells, cls: str, draft: Column, speed: Column, out: str = "trim_ideal") -> DataFrame:
    """Trim of least power among evenly spaced candidates; the smallest such trim on a tie.

    The candidates are compared inside each row: no product of rows is formed.
    """
    ready = grid if isinstance(grid, Cells) else grid_cells(grid, cls)
    hit = in_cells(facts, ready, candidate_lines(ready.rows, cls), cls, {"draft": draft, "speed": speed})
    u, v = F.col("_s_draft"), F.col("_s_speed")
    power = lambda n: blend({b: n[f"p{b}"] for b in ("00", "01", "10", "11")}, [u, v])
    best = F.array_min(F.transform("_line", lambda n: F.struct(F.round(power(n), 9).alias("p"), n["t"].alias("t"))))
    return hit.withColumn(out, best["t"]).drop("_line", "_s_draft", "_s_speed")
