"""Anti, interval, role and lookup joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetmart.functions import columns as X
from fleetmart.operators import interpolate as I
from fleetmart.operators import scattered as Sc
from fleetmart.operators import joins as J
from fleetmart.operators import timeline as TL
from fleetmart.operators.settle import settle
from fleetmart.plans import merges as M
from fleetmart.plans.catalog.base import day_sql, day_text, load, long, query, shown, shown_sql, stamp, stamp_sql

OPEN_END = "2024-02-01"

# Crew rotations from the events: a user's sign-up starts a duty that ends the day before the next sign-up.
_CREW_SQL = """w AS (SELECT user_id AS imo, ts, event_id, lead(CAST(ts AS DATE)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM events WHERE event_type = 'signup'),
crew AS (SELECT imo AS crew_imo, CAST(ts AS DATE) AS start_date, nxt AS end_date, CASE WHEN event_id % 2 = 0 THEN 'Master' ELSE 'Chief Engineer' END AS rank,
  concat('Crew', CAST(event_id % 50 AS VARCHAR(9))) AS full_name, concat('DBN', CAST(event_id AS VARCHAR(9))) AS dbn FROM w)"""


def crew(spark, sf_dir):
    src = load(spark, sf_dir, "events").filter(F.col("event_type") == "signup").select("user_id", "ts", "event_id")
    duty = TL.with_context(src.withColumn("d", F.to_date("ts")), ["user_id"], ["ts", "event_id"], lead={"end_date": "d"})
    n = F.col("event_id")
    return duty.select(
        F.col("user_id").alias("imo"), F.col("d").alias("start_date"), "end_date",
        F.when(n % 2 == 0, F.lit("Master")).otherwise(F.lit("Chief Engineer")).alias("rank"),
        F.concat(F.lit("Crew"), (n % 50).cast("string")).alias("full_name"), F.concat(F.lit("DBN"), n.cast("string")).alias("dbn"),
    )


def ship_days(spark, sf_dir):
    src = load(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return src.select("event_id", F.col("user_id").alias("imo"), F.to_date("ts").alias("date"))


_ON_BOARD = f"""{_CREW_SQL}, f AS (SELECT event_id, user_id AS imo, CAST(ts AS DATE) AS date FROM events WHERE event_type = 'purchase'),
b AS (SELECT f.*, crew.* FROM f JOIN crew ON crew_imo = imo AND start_date <= date AND date <= coalesce(end_date, DATE '{OPEN_END}'))"""


@query(
    "interval_join_crew",
    f"""WITH {_ON_BOARD} SELECT CAST(event_id AS BIGINT) AS event_id, {day_sql('start_date')} AS start_day, dbn, full_name FROM b""",
)
def _(spark, sf_dir):
    days = ship_days(spark, sf_dir)
    clip = days.agg(F.min("date").cast("string"), F.max("date").cast("string")).first()
    out = J.interval_join(days, crew(spark, sf_dir), "imo", "date", "start_date", "end_date", OPEN_END, bucket_days=8, clip=tuple(clip) if clip[0] else None)
    return out.select(long(F.col("event_id")).alias("event_id"), day_text(F.col("start_date")).alias("start_day"), "dbn", "full_name")


@query(
    "interval_join_busy",
    f"""WITH {_ON_BOARD} SELECT CAST(event_id AS BIGINT) AS event_id, {day_sql('start_date')} AS start_day, dbn, full_name FROM b""",
)
def _(spark, sf_dir):
    """The same where pieces of more than a few facts are cut into days."""
    out = J.interval_join(ship_days(spark, sf_dir), crew(spark, sf_dir), "imo", "date", "start_date", "end_date", OPEN_END, bucket_days=8, clip=("1990-01-01", "2030-01-01"), piece_rows=3, salts=2)
    return out.select(long(F.col("event_id")).alias("event_id"), day_text(F.col("start_date")).alias("start_day"), "dbn", "full_name")


@query(
    "role_pivot_join",
    f"""WITH {_ON_BOARD}, r AS (SELECT event_id, arg_min(full_name, (start_date, full_name, dbn)) FILTER (WHERE lower(rank) = 'master') AS captain,
  arg_min(dbn, (start_date, full_name, dbn)) FILTER (WHERE lower(rank) = 'master') AS captain_dbn,
  arg_min(full_name, (start_date, full_name, dbn)) FILTER (WHERE lower(rank) = 'chief engineer') AS engineer FROM b GROUP BY event_id)
SELECT CAST(f.event_id AS BIGINT) AS event_id, captain, captain_dbn, engineer FROM f LEFT JOIN r USING (event_id)""",
)
def _(spark, sf_dir):
    days = ship_days(spark, sf_dir)
    on_board = J.interval_join(days, crew(spark, sf_dir), "imo", "date", "start_date", "end_date", OPEN_END, bucket_days=8)
    roles = J.role_columns(
        on_board, ["event_id"], "rank", ["start_date", "full_name", "dbn"],
        {"master": {"captain": "full_name", "captain_dbn": "dbn"}, "chief engineer": {"engineer": "full_name"}},
    )
    return days.select("event_id").join(roles, "event_id", "left").select(long(F.col("event_id")).alias("event_id"), "captain", "captain_dbn", "engineer")


@query(
    "role_join",
    f"""WITH f AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END AS op1, (o_custkey * 7 + 3) % 2000 AS op2, o_orderdate FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '2000-06-01')
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, a.c_mktsegment AS segment, a.c_name AS operator_secondary_code, b.c_name AS operator_secondary_code2,
  CASE WHEN a.c_custkey IS NOT NULL THEN 'Captain' END AS role_alias, CASE WHEN b.c_custkey IS NOT NULL THEN 'Chief Engineer' END AS role_alias2
FROM f LEFT JOIN customer a ON a.c_custkey = op1 LEFT JOIN customer b ON b.c_custkey = op2""",
)
def _(spark, sf_dir):
    facts = load(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_custkey").cast("string")).otherwise("").alias("operator_id"),
        ((F.col("o_custkey") * 7 + 3) % 2000).cast("string").alias("operator_id2"), F.col("o_orderdate").alias("report_date_utc"), F.lit("r").alias("status"),
    )
    dim = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("operator_id"), F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("discharge_book_number"),
        F.lit("f").alias("source_file_name"),
    )
    nobody = dim.withColumn("operator_id", F.lit(""))  # crew rows without an id
    out = M.reports_with_operators(facts, dim.unionByName(nobody), "2000-06-01")
    return out.select(long(F.col("o_orderkey")).alias("o_orderkey"), "segment", "operator_secondary_code", "operator_secondary_code2", "role_alias", "role_alias2")


@query(
    "three_way_join",
    f"""WITH d AS (SELECT user_id, CAST(ts AS DATE) AS d, event_type, value FROM events),
a AS (SELECT user_id, d, sum(value) AS fuel FROM d WHERE event_type = 'click' GROUP BY 1, 2),
b AS (SELECT user_id, d, max(value) AS noon FROM d WHERE event_type = 'signup' GROUP BY 1, 2),
c AS (SELECT user_id, d, count(*) AS n FROM d WHERE event_type IN ('view', 'error') GROUP BY 1, 2)
SELECT CAST(user_id AS BIGINT) AS ship, {day_sql('d')} AS day, {shown_sql('fuel')} AS fuel, {shown_sql('noon')} AS noon, CAST(n AS BIGINT) AS n
FROM a JOIN b USING (user_id, d) JOIN c USING (user_id, d)""",
)
def _(spark, sf_dir):
    src = load(spark, sf_dir, "events").select(F.col("user_id").alias("ship"), F.to_date("ts").alias("d"), "event_type", "value")
    kind = F.col("event_type")
    fuel = src.filter(kind == "click").groupBy("ship", "d").agg(F.sum("value").alias("fuel"))
    noon = src.filter(kind == "signup").groupBy("ship", "d").agg(F.max("value").alias("noon"))
    engine = src.filter(kind.isin("view", "error")).groupBy("ship", "d").agg(F.count(F.lit(1)).alias("n"))
    out = J.same_day_join([fuel, noon, engine], ["d", "ship"])
    return out.select(long(F.col("ship")).alias("ship"), day_text(F.col("d")).alias("day"), shown(F.col("fuel")).alias("fuel"), shown(F.col("noon")).alias("noon"), "n")


@query(
    "anti_join_new_files",
    f"""SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, {stamp_sql('o_orderdate')} AS last_modified FROM orders o
WHERE o_orderdate > TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '2000-01-01' AND NOT EXISTS (
  SELECT 1 FROM orders h WHERE h.o_orderkey = o.o_orderkey AND h.o_orderkey % 3 <> 0 AND h.o_orderstatus IN ('F', 'P')
  AND h.o_orderdate + INTERVAL (CASE WHEN h.o_orderkey % 5 = 0 THEN 1 ELSE 0 END) DAY = o.o_orderdate)""",
)
def _(spark, sf_dir):
    from fleetmart.operators.ledger import new_files, select_files

    src = load(spark, sf_dir, "orders")
    path = F.col("o_orderkey").cast("string")
    listing = src.select(path.alias("filepath"), path.alias("filename"), F.col("o_orderdate").alias("last_modified"), F.lit(1).alias("size"))
    moved = F.when(F.col("o_orderkey") % 5 == 0, F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("o_orderdate"))
    status = F.when(F.col("o_orderstatus") == "F", F.lit("ingested")).when(F.col("o_orderstatus") == "P", F.lit("pending")).otherwise(F.lit("failed"))
    held = src.filter(F.col("o_orderkey") % 3 != 0).select(
        path.alias("filepath"), moved.alias("last_modified"), F.lit("csv").alias("format"), status.alias("status")
    )
    window = ("1996-01-01", "2000-01-01")
    out = new_files(select_files(listing, None, 0, *window), held, "csv", *window)
    return out.select(F.col("filepath").cast("bigint").alias("o_orderkey"), stamp(F.col("last_modified")).alias("last_modified"))


@query(
    "lookup_broadcast",
    "SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, n_name AS team, CAST(n_regionkey AS BIGINT) AS kind FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey AND n_nationkey < 20",
)
def _(spark, sf_dir):
    dim = load(spark, sf_dir, "nation").filter("n_nationkey < 20").select(
        F.concat(F.lit("ship "), F.col("n_nationkey").cast("string")).alias("ship"), F.col("n_name").alias("team"), long(F.col("n_regionkey")).alias("kind")
    )
    key = F.concat(F.lit("SHIP "), F.col("s_nationkey").cast("string"))
    out = J.lookup(load(spark, sf_dir, "supplier"), dim, key, "ship")
    return out.select(long(F.col("s_suppkey")).alias("s_suppkey"), "team", "kind")


@query(
    "lookup_required",
    "SELECT CAST(c_custkey AS BIGINT) AS c_custkey, n_name AS vessel_type FROM customer JOIN nation ON n_nationkey = c_nationkey AND n_regionkey < 3",
)
def _(spark, sf_dir):
    dim = load(spark, sf_dir, "nation").filter("n_regionkey < 3").select(F.col("n_nationkey").cast("string").alias("ship"), F.col("n_name").alias("vessel_type"))
    out = J.lookup(load(spark, sf_dir, "customer"), dim, F.col("c_nationkey").cast("string"), "ship", required=True)
    return out.select(long(F.col("c_custkey")).alias("c_custkey"), "vessel_type")


_FLEETS = {"B787": ["Brand#1", "Brand#2", "Brand#17"], "A339": ["Brand#3", "Brand#4"], "A350": ["Brand#4", "Brand#25"]}
_LIMITS = {"ECONOMY": 1.2, "SMALL": 30.5, "PROMO": 7.0}


@query(
    "lookup_map",
    f"""SELECT CAST(p_partkey AS BIGINT) AS p_partkey, CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#17') THEN 'B787'
  WHEN p_brand IN ('Brand#3', 'Brand#4') THEN 'A339' WHEN p_brand = 'Brand#25' THEN 'A350' END AS vehicle,
  {shown_sql("CASE p_type WHEN 'ECONOMY' THEN 1.2 WHEN 'SMALL' THEN 30.5 WHEN 'PROMO' THEN 7.0 END")} AS trim_limit FROM part""",
)
def _(spark, sf_dir):
    return load(spark, sf_dir, "part").select(
        long(F.col("p_partkey")).alias("p_partkey"), X.reverse_look_up(_FLEETS, F.col("p_brand")).alias("vehicle"),
        shown(X.look_up(_LIMITS, F.col("p_type"))).alias("trim_limit"),
    )


# Interpolation: a consumption curve per brand from the parts, a trim grid per return flag from the lines.

@query(
    "interp_1d",
    f"""WITH c AS (SELECT p_brand AS imo, CAST(p_size AS DOUBLE) * 2 AS x, max(p_retailprice) / 7 AS y, min(p_retailprice) / 11 AS z FROM part GROUP BY 1, 2),
lo AS (SELECT imo, arg_max((x, y, z), x) AS p FROM c WHERE x <= 51.0 GROUP BY imo), hi AS (SELECT imo, arg_min((x, y, z), x) AS p FROM c WHERE x >= 51.0 GROUP BY imo),
j AS (SELECT k.imo, lo.p[1] AS x0, lo.p[2] AS y0, lo.p[3] AS z0, hi.p[1] AS x1, hi.p[2] AS y1, hi.p[3] AS z1 FROM (SELECT DISTINCT imo FROM c) k LEFT JOIN lo USING (imo) LEFT JOIN hi USING (imo))
SELECT imo, {shown_sql('CASE WHEN x0 = x1 THEN y0 ELSE y0 + (y1 - y0) * (51.0 - x0) / nullif(x1 - x0, 0) END')} AS y,
  {shown_sql('CASE WHEN x0 = x1 THEN z0 ELSE z0 + (z1 - z0) * (51.0 - x0) / nullif(x1 - x0, 0) END')} AS z FROM j""",
)
def _(spark, sf_dir):
    curve = load(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("imo"), (F.col("p_size").cast("double") * 2).alias("x")).agg(
        (F.max("p_retailprice") / 7).alias("y"), (F.min("p_retailprice") / 11).alias("z")
    )
    out = I.curve_at(curve, "imo", "x", ["y", "z"], F.lit(51.0))
    return out.select("imo", shown(F.col("y")).alias("y"), shown(F.col("z")).alias("z"))


_GRID_SQL = """g AS (SELECT l_returnflag AS ship_class, CAST(l_linenumber AS DOUBLE) AS draft, floor(l_quantity / 10) * 10.0 AS speed,
  round(l_discount * 50) - 2.0 AS trim, max(l_extendedprice) / 970.0 AS power FROM lineitem GROUP BY 1, 2, 3, 4)"""
_POINTS_SQL = """f AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag AS ship_class, l_linenumber + l_tax * 7 AS draft,
  l_quantity + 0.37 AS speed, l_discount * 61 - 2.13 AS trim FROM lineitem)"""


def grid(spark, sf_dir):
    """A grid is a stored reference table; this one is derived, so it is stored first."""
    lines = load(spark, sf_dir, "lineitem")
    nodes = lines.groupBy(
        F.col("l_returnflag").alias("ship_class"), F.col("l_linenumber").cast("double").alias("draft"),
        (F.floor(F.col("l_quantity") / 10) * 10.0).cast("double").alias("speed"), (F.round(F.col("l_discount") * 50) - 2.0).alias("trim"),
    ).agg((F.max("l_extendedprice") / 970.0).alias("power"))
    return settle(nodes)


def points(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_returnflag").alias("ship_class"), (F.col("l_linenumber") + F.col("l_tax") * 7).alias("draft"),
        (F.col("l_quantity") + 0.37).alias("speed"), (F.col("l_discount") * 61 - 2.13).alias("trim"),
    )


# cell corners by plain inequality on the axis values; trim bracketed on the nodes of the cell's own corner line
def cells_sql(grid_sql: str) -> str:
    return f"""{grid_sql}, ds AS (SELECT ship_class, draft AS d0, lead(draft) OVER (PARTITION BY ship_class ORDER BY draft) AS d1 FROM (SELECT DISTINCT ship_class, draft FROM g)),
ss AS (SELECT ship_class, speed AS s0, lead(speed) OVER (PARTITION BY ship_class ORDER BY speed) AS s1 FROM (SELECT DISTINCT ship_class, speed FROM g)),
cells AS (SELECT ds.ship_class, d0, d1, s0, s1 FROM ds JOIN ss ON ds.ship_class = ss.ship_class WHERE d1 IS NOT NULL AND s1 IS NOT NULL),
dm AS (SELECT ship_class, max(draft) AS dmax, max(speed) AS smax FROM g GROUP BY 1),
line AS (SELECT c.*, a.trim AS t, a.power AS p00, b.power AS p10, e.power AS p01, h.power AS p11 FROM cells c
  JOIN g a ON a.ship_class = c.ship_class AND a.draft = d0 AND a.speed = s0
  LEFT JOIN g b ON b.ship_class = c.ship_class AND b.draft = d1 AND b.speed = s0 AND b.trim = a.trim
  LEFT JOIN g e ON e.ship_class = c.ship_class AND e.draft = d0 AND e.speed = s1 AND e.trim = a.trim
  LEFT JOIN g h ON h.ship_class = c.ship_class AND h.draft = d1 AND h.speed = s1 AND h.trim = a.trim)"""


_CELLS_SQL = cells_sql(_GRID_SQL)
AT_CORNERS = "(p00 * (1 - u) * (1 - v) + p10 * u * (1 - v) + p01 * (1 - u) * v + p11 * u * v)"


def grid_power_sql(grid_sql: str, facts: str, draft: str, speed: str, trim: str, out: str) -> str:
    """CTEs that end in ``gp``: the rows of CTE ``facts`` (with ship_class) plus their trilinear power."""
    axis = lambda n, c: f"""{n}x AS (SELECT ship_class, {c} AS {n}0, lead({c}) OVER w AS {n}1, max({c}) OVER (PARTITION BY ship_class) AS {n}m
  FROM (SELECT DISTINCT ship_class, {c} FROM g) WINDOW w AS (PARTITION BY ship_class ORDER BY {c}))"""  # noqa: E731
    held = lambda n, c: f"LEFT JOIN {n}x ON {n}x.ship_class = f.ship_class AND {n}0 <= {c} AND ({c} < {n}1 OR ({c} = {n}1 AND {n}1 = {n}m))"
    bits = [f"{i:03b}" for i in range(8)]
    corner = "\n  ".join(
        f"LEFT JOIN g c{b} ON c{b}.ship_class = p.ship_class AND c{b}.draft = d{b[0]} AND c{b}.speed = s{b[1]} AND c{b}.trim = t{b[2]}" for b in bits
    )
    weight = lambda b: " * ".join(x if bit == "1" else f"(1 - {x})" for x, bit in zip("uvw", b))
    return f"""{grid_sql}, {axis('d', 'draft')}, {axis('s', 'speed')}, {axis('t', 'trim')},
p AS (SELECT f.*, d0, d1, s0, s1, t0, t1, ({draft} - d0) / (d1 - d0) AS u, ({speed} - s0) / (s1 - s0) AS v, ({trim} - t0) / (t1 - t0) AS w
  FROM {facts} f {held('d', draft)} {held('s', speed)} {held('t', trim)}),
gp AS (SELECT p.*, {' + '.join(f'c{b}.power * {weight(b)}' for b in bits)} AS {out} FROM p
  {corner})"""


@query(
    "interp_grid",
    f"""WITH {_POINTS_SQL}, {grid_power_sql(_GRID_SQL, 'f', 'f.draft', 'f.speed', 'f.trim', 'power')}
SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_partkey AS BIGINT) AS l_partkey, {shown_sql('power')} AS power FROM gp""",
)
def _(spark, sf_dir):
    out = I.grid_power(points(spark, sf_dir), grid(spark, sf_dir), "ship_class", F.col("draft"), F.col("speed"), F.col("trim"), "power")
    return out.select(*[long(F.col(k)).alias(k) for k in ("l_orderkey", "l_linenumber", "l_partkey")], shown(F.col("power")).alias("power"))


# scattered tables: every four points of a class whose sphere holds no other point, in units of the class's extent
def _det(u: str, v: str, w: str) -> str:
    return f"({u}x * ({v}y * {w}z - {v}z * {w}y) - {u}y * ({v}x * {w}z - {v}z * {w}x) + {u}z * ({v}x * {w}y - {v}y * {w}x))"


def _with(sides: tuple[str, str, str], d: str) -> str:
    """The determinant of the edges with one axis replaced by the halved squares of their lengths: a coordinate of the sphere's centre."""
    edges = [{a: f"h{k}" if a == d else f"e{k}{a}" for a in "xyz"} for k in sides]
    (p, q, r) = edges
    return f"({p['x']} * ({q['y']} * {r['z']} - {q['z']} * {r['y']}) - {p['y']} * ({q['x']} * {r['z']} - {q['z']} * {r['x']}) + {p['z']} * ({q['x']} * {r['y']} - {q['y']} * {r['x']}))"


_CLOUD_SQL = f"""raw AS (SELECT p_type AS ship_class, avg(p_size) AS draft, avg(p_partkey % 200) AS speed, avg(p_partkey * p_partkey % 101) AS trim, max(p_retailprice) AS power FROM part GROUP BY p_type, p_size % 11),
ext AS (SELECT ship_class, min(draft) AS x0, max(draft) AS x1, min(speed) AS y0, max(speed) AS y1, min(trim) AS z0, max(trim) AS z1 FROM raw GROUP BY ship_class),
pts AS (SELECT ship_class, row_number() OVER (PARTITION BY ship_class ORDER BY draft, speed, trim) AS i, (draft - x0) / (x1 - x0) AS x, (speed - y0) / (y1 - y0) AS y, (trim - z0) / (z1 - z0) AS z, power FROM raw JOIN ext USING (ship_class)),
quads AS (SELECT a.ship_class, a.i AS ai, b.i AS bi, c.i AS ci, d.i AS di, a.x AS ax, a.y AS ay, a.z AS az, a.power AS pa, b.power AS pb, c.power AS pc, d.power AS pd,
  {', '.join(f'{q}.{d} - a.{d} AS e{k}{d}' for k, q in ((1, 'b'), (2, 'c'), (3, 'd')) for d in 'xyz')}
  FROM pts a JOIN pts b ON b.ship_class = a.ship_class AND b.i > a.i JOIN pts c ON c.ship_class = a.ship_class AND c.i > b.i JOIN pts d ON d.ship_class = a.ship_class AND d.i > c.i),
halves AS (SELECT *, {', '.join(f'(e{k}x * e{k}x + e{k}y * e{k}y + e{k}z * e{k}z) / 2 AS h{k}' for k in (1, 2, 3))}, {_det('e1', 'e2', 'e3')} AS det FROM quads),
spheres AS (SELECT *, {', '.join(f"{_with(('1', '2', '3'), d)} / det AS m{d}" for d in 'xyz')} FROM halves WHERE abs(det) > 1e-9),
cells AS (SELECT * FROM spheres s WHERE NOT EXISTS (SELECT 1 FROM pts p WHERE p.ship_class = s.ship_class AND p.i NOT IN (ai, bi, ci, di)
  AND (p.x - ax - mx) * (p.x - ax - mx) + (p.y - ay - my) * (p.y - ay - my) + (p.z - az - mz) * (p.z - az - mz) < mx * mx + my * my + mz * mz))"""


@query(
    "interp_scattered",
    f"""WITH {_CLOUD_SQL},
f AS (SELECT p_partkey, p_type AS ship_class, (25.5 + (p_size - 25.5) / 8 - x0) / (x1 - x0) AS x, (99.5 + (p_partkey % 200 - 99.5) / 8 - y0) / (y1 - y0) AS y, (50 + (p_partkey * 31 % 101 - 50) / 8 - z0) / (z1 - z0) AS z
  FROM part JOIN ext ON p_type = ship_class),
g AS (SELECT f.p_partkey, cells.*, f.x - ax AS fx, f.y - ay AS fy, f.z - az AS fz FROM f JOIN cells USING (ship_class)),
w AS (SELECT *, {_det('f', 'e2', 'e3')} / det AS wb, {_det('e1', 'f', 'e3')} / det AS wc, {_det('e1', 'e2', 'f')} / det AS wd FROM g),
hit AS (SELECT p_partkey, min(pa * (1 - wb - wc - wd) + pb * wb + pc * wc + pd * wd) AS power FROM w WHERE least(wb, wc, wd, 1 - wb - wc - wd) >= -1e-9 GROUP BY p_partkey)
SELECT CAST(f.p_partkey AS BIGINT) AS p_partkey, CASE WHEN power IS NOT NULL THEN {shown_sql('power', 3)} END AS power FROM f LEFT JOIN hit USING (p_partkey)""",
)
def _(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    key = F.col("p_partkey")
    table = part.groupBy(F.col("p_type").alias("ship_class"), F.col("p_size") % 11).agg(
        F.avg("p_size").alias("draft"), F.avg(key % 200).alias("speed"), F.avg(key * key % 101).alias("trim"), F.max("p_retailprice").alias("power")
    )
    facts = part.select(
        "p_partkey", F.col("p_type").alias("ship_class"), (25.5 + (F.col("p_size") - 25.5) / 8).alias("draft"), (99.5 + (key % 200 - 99.5) / 8).alias("speed"), (50 + (key * 31 % 101 - 50) / 8).alias("trim")
    )
    out = Sc.interpolated(facts, Sc.cloud(table, "ship_class"), "ship_class", (F.col("draft"), F.col("speed"), F.col("trim")), "power")
    return out.select(long(key).alias("p_partkey"), shown(F.col("power"), 3).alias("power"))


@query(
    "ideal_trim",
    f"""WITH {_CELLS_SQL}, f AS (SELECT DISTINCT l_returnflag AS ship_class, l_linenumber + l_tax * 7 AS draft, l_quantity + 0.37 AS speed FROM lineitem),
h AS (SELECT row_number() OVER () AS id, f.* FROM f),
j AS (SELECT h.id, line.t, (h.draft - d0) / (d1 - d0) AS u, (h.speed - s0) / (s1 - s0) AS v, p00, p10, p01, p11 FROM h
  JOIN dm ON dm.ship_class = h.ship_class
  JOIN line ON line.ship_class = h.ship_class AND d0 <= h.draft AND (h.draft < d1 OR (h.draft = d1 AND d1 = dmax)) AND s0 <= h.speed AND (h.speed < s1 OR (h.speed = s1 AND s1 = smax))),
n AS (SELECT id, t, {AT_CORNERS} AS q, lead(t) OVER (PARTITION BY id ORDER BY t) AS t1, lead({AT_CORNERS}) OVER (PARTITION BY id ORDER BY t) AS q1 FROM j),
c AS (SELECT i, -2.0 + i * (6.0 / 49) AS x FROM range(50) r(i)),
e AS (SELECT id, x, CASE WHEN x = t THEN q ELSE q + (q1 - q) * (x - t) / nullif(t1 - t, 0) END AS p FROM n JOIN c ON t <= x AND (x < t1 OR (t1 IS NULL AND x = t))),
best AS (SELECT id, arg_min(x, (round(p, 9), x)) AS ideal FROM e WHERE p IS NOT NULL GROUP BY id)
SELECT ship_class, {shown_sql('draft')} AS draft, {shown_sql('speed')} AS speed, {shown_sql('ideal')} AS trim_ideal FROM h LEFT JOIN best USING (id)""",
)
def _(spark, sf_dir):
    facts = points(spark, sf_dir).select("ship_class", "draft", "speed").distinct()
    out = I.ideal_trim(facts, grid(spark, sf_dir), "ship_class", F.col("draft"), F.col("speed"))
    return out.select("ship_class", shown(F.col("draft")).alias("draft"), shown(F.col("speed")).alias("speed"), shown(F.col("trim_ideal")).alias("trim_ideal"))
