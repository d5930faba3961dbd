"""Ordered operators, as-of and range joins on the events table (ship = user)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetmart.functions.columns import weighted_mean
from fleetmart.operators import timeline as TL
from fleetmart.operators.aggregates import latest_known
from fleetmart.plans import noon as N
from fleetmart.plans.catalog import adapters as A
from fleetmart.plans.catalog.base import day_sql, day_text, load, long, query, shown, shown_sql, stamp, stamp_sql
from fleetmart.plans.report_consolidation import stand_in_noons

ORDER = ["ts", "event_id"]
HOUR6 = 6 * TL.HOUR


def event_id():
    return long(F.col("event_id")).alias("event_id")


def events(spark, sf_dir):
    return load(spark, sf_dir, "events")


@query(
    "counter_delta",
    f"""WITH d AS (SELECT event_id, round(value / 7.3 - lag(value / 7.3) OVER (PARTITION BY user_id ORDER BY ts, event_id), 1) AS delta FROM events)
SELECT CAST(event_id AS BIGINT) AS event_id, {shown_sql('delta')} AS delta FROM d""",
)
def _(spark, sf_dir):
    src = events(spark, sf_dir).withColumn("counter", F.col("value") / 7.3)
    out = TL.with_context(src, ["user_id"], ORDER, lag={"previous": "counter"})
    return out.select(event_id(), shown(F.round(F.col("counter") - F.col("previous"), 1)).alias("delta"))


@query(
    "next_report",
    f"SELECT CAST(event_id AS BIGINT) AS event_id, {stamp_sql('lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)')} AS next_ts FROM events",
)
def _(spark, sf_dir):
    out = TL.with_context(events(spark, sf_dir), ["user_id"], ORDER, lead={"next_ts": "ts"})
    return out.select(event_id(), stamp(F.col("next_ts")).alias("next_ts"))


@query(
    "prev_port",
    """WITH w AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
SELECT CAST(event_id AS BIGINT) AS event_id, CASE WHEN event_type = 'signup' AND value > 50 THEN prev ELSE event_type END AS port FROM w""",
)
def _(spark, sf_dir):
    out = TL.with_context(events(spark, sf_dir), ["user_id"], ORDER, lag={"prev": "event_type"})
    arriving = (F.col("event_type") == "signup") & (F.col("value") > 50)
    return out.select(event_id(), F.when(arriving, F.col("prev")).otherwise(F.col("event_type")).alias("port"))


_LEGS = "CASE WHEN event_id % 3 = 0 THEN '\\N' WHEN event_id % 5 = 0 THEN NULL ELSE concat('P', CAST(event_id % 11 AS VARCHAR(9))) END"


def voyage_reports(spark, sf_dir):
    n = F.col("event_id")
    target = F.when(n % 3 == 0, F.lit("\\N")).when(n % 5 != 0, F.concat(F.lit("P"), (n % 11).cast("string")))
    kind = F.when(F.col("event_type").isin("signup", "view"), F.lit("N")).when(F.col("event_type") == "click", F.lit("A")).otherwise(F.lit("D"))
    return events(spark, sf_dir).select(
        "event_id", F.col("user_id").alias("ship"), "ts", F.to_date("ts").alias("day"), kind.alias("report_type"),
        F.col("event_type").alias("from_port"), target.alias("to_port"),
    )


_FILLED = f"""WITH a AS (SELECT event_id, user_id AS ship, ts, event_type AS from_port, nullif({_LEGS}, '\\N') AS to_port,
  CASE WHEN event_type IN ('signup', 'view') THEN 'N' WHEN event_type = 'click' THEN 'A' ELSE 'D' END AS report_type FROM events),
b AS (SELECT *, last_value(to_port IGNORE NULLS) OVER (PARTITION BY ship ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lastp FROM a),
c AS (SELECT event_id, ship, ts, report_type, CASE WHEN to_port IS NULL THEN lastp ELSE from_port END AS from_port, coalesce(to_port, lastp) AS to_port FROM b)"""


@query("forward_fill", f"{_FILLED} SELECT CAST(event_id AS BIGINT) AS event_id, from_port, to_port FROM c")
def _(spark, sf_dir):
    out = N.with_voyage_ports(voyage_reports(spark, sf_dir), order=("ts", "event_id"))
    return out.select(event_id(), "from_port", "to_port")


@query(
    "latest_per_key",
    f"""{_FILLED}, d AS (SELECT *, row_number() OVER (PARTITION BY ship, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn FROM c WHERE report_type IN ('N', 'A'))
SELECT CAST(event_id AS BIGINT) AS event_id, CAST(ship AS BIGINT) AS ship, report_type, from_port, to_port FROM d WHERE rn = 1""",
)
def _(spark, sf_dir):
    out = N.noon_reports(voyage_reports(spark, sf_dir), order=("ts", "event_id"))
    return out.select(event_id(), long(F.col("ship")).alias("ship"), "report_type", "from_port", "to_port")


@query(
    "nearest_noon",
    f"""WITH a AS (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY abs(hour(ts) - 12), ts, event_id) AS rn FROM events)
SELECT CAST(event_id AS BIGINT) AS event_id, CAST(user_id AS BIGINT) AS ship, {day_sql('ts')} AS day FROM a WHERE rn = 1""",
)
def _(spark, sf_dir):
    src = events(spark, sf_dir).select(
        "event_id", F.col("user_id").alias("ship"), "ts", F.to_date("ts").alias("day"), F.abs(F.hour("ts") - 12).alias("away")
    )
    out = TL.top_row(src, ["ship", "day"], ["away", "ts", "event_id"], latest=False)
    return out.select(event_id(), long(F.col("ship")).alias("ship"), day_text(F.col("day")).alias("day"))


@query(
    "time_limit_window",
    f"""WITH a AS (SELECT *, first_value(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS f FROM events)
SELECT CAST(event_id AS BIGINT) AS event_id, {stamp_sql("least(ts - INTERVAL 26 HOUR, f)")} AS time_limit FROM a""",
)
def _(spark, sf_dir):
    out = TL.with_context(events(spark, sf_dir), ["user_id"], ORDER, first={"first_ts": "ts"})
    limit = F.least(F.col("ts") - F.expr("INTERVAL 26 HOUR"), F.col("first_ts"))
    return out.select(event_id(), stamp(limit).alias("time_limit"))


@query(
    "range_frame_min",
    f"""WITH e AS (SELECT event_id, value, CASE WHEN event_id % 37 > 0 THEN ts END AS ts, CASE WHEN event_id % 41 > 0 THEN user_id END AS user_id FROM events)
SELECT CAST(a.event_id AS BIGINT) AS event_id, CASE WHEN count(b.event_id) > 0 THEN {shown_sql('min(b.value)')} END AS low FROM e a
LEFT JOIN e b ON a.user_id = b.user_id AND abs(floor(epoch_us(a.ts) / 1000000.0) - floor(epoch_us(b.ts) / 1000000.0)) <= {HOUR6} GROUP BY a.event_id""",
)
def _(spark, sf_dir):
    n = F.col("event_id")
    gaps = events(spark, sf_dir).withColumns({"ts": F.when(n % 37 > 0, F.col("ts")), "user_id": F.when(n % 41 > 0, F.col("user_id"))})
    out = TL.range_min(gaps, ["user_id"], "ts", "value", HOUR6, "low")
    return out.select(event_id(), F.when(F.col("low").isNotNull(), shown(F.col("low"))).alias("low"))


@query(
    "asof_nearest",
    f"""WITH p AS (SELECT * FROM events WHERE event_type = 'purchase'), c AS (SELECT * FROM events WHERE event_type = 'click'),
j AS (SELECT p.event_id, c.event_id AS click_id, c.value AS click_value, abs(epoch_us(p.ts) - epoch_us(c.ts)) / 1e6 AS gap,
  row_number() OVER (PARTITION BY p.event_id ORDER BY abs(epoch_us(p.ts) - epoch_us(c.ts)), c.ts, c.event_id) AS rn
  FROM p JOIN c ON p.user_id = c.user_id AND abs(epoch_us(p.ts) - epoch_us(c.ts)) <= {HOUR6}::BIGINT * 1000000)
SELECT CAST(p.event_id AS BIGINT) AS event_id, CAST(j.click_id AS BIGINT) AS click_id, {shown_sql('j.click_value')} AS click_value, {shown_sql('j.gap')} AS time_diff
FROM p LEFT JOIN j ON p.event_id = j.event_id AND rn = 1""",
)
def _(spark, sf_dir):
    src = events(spark, sf_dir)
    left = src.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    right = src.filter(F.col("event_type") == "click").select("event_id", "user_id", "ts", "value")
    out = TL.asof_nearest(left, right, ["user_id"], "ts", "ts", HOUR6, {"click_id": "event_id", "click_value": "value"}, ["event_id"])
    return out.select(event_id(), long(F.col("click_id")).alias("click_id"), shown(F.col("click_value")).alias("click_value"), shown(F.col("time_diff")).alias("time_diff"))


@query(
    "asof_nearest_only",
    f"""WITH p AS (SELECT * FROM events WHERE event_type IN ('purchase', 'signup')), c AS (SELECT * FROM events WHERE event_type IN ('click', 'view')),
j AS (SELECT p.event_id, p.user_id, p.ts, c.event_id AS click_id, abs(epoch_us(p.ts) - epoch_us(c.ts)) / 1e6 AS gap,
  row_number() OVER (PARTITION BY p.event_id ORDER BY abs(epoch_us(p.ts) - epoch_us(c.ts)), c.ts, c.event_id) AS rn
  FROM p JOIN c ON p.user_id = c.user_id AND abs(epoch_us(p.ts) - epoch_us(c.ts)) <= {HOUR6}::BIGINT * 1000000),
m AS (SELECT * FROM j WHERE rn = 1)
SELECT CAST(a.event_id AS BIGINT) AS event_id, CAST(a.click_id AS BIGINT) AS click_id FROM m a
WHERE NOT EXISTS (SELECT 1 FROM m b WHERE a.user_id = b.user_id AND b.gap < a.gap
  AND abs(floor(epoch_us(a.ts) / 1000000.0) - floor(epoch_us(b.ts) / 1000000.0)) <= {2 * TL.HOUR})""",
)
def _(spark, sf_dir):
    src = events(spark, sf_dir).select("event_id", "user_id", "ts", "event_type")
    left = src.filter(F.col("event_type").isin("purchase", "signup")).drop("event_type")
    right = src.filter(F.col("event_type").isin("click", "view")).drop("event_type")
    out = TL.asof_nearest(left, right, ["user_id"], "ts", "ts", HOUR6, {"click_id": "event_id"}, ["event_id"], how="inner")
    kept = TL.nearest_only(out, ["user_id"], "ts", radius=2 * TL.HOUR)
    return kept.select(event_id(), long(F.col("click_id")).alias("click_id"))


@query(
    "range_anti_join",
    """SELECT CAST(a.event_id AS BIGINT) AS event_id FROM events a WHERE event_type <> 'signup' AND NOT EXISTS (
  SELECT 1 FROM events b WHERE b.user_id = a.user_id AND b.event_type = 'signup' AND b.ts >= a.ts AND b.ts <= CAST(CAST(a.ts AS DATE) + 2 AS TIMESTAMP))""",
)
def _(spark, sf_dir):
    return TL.without_follower(events(spark, sf_dir), ["user_id"], "ts", F.col("event_type") == "signup").select(event_id())


@query(
    "days_without_noon",
    f"""WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events)
SELECT CAST(user_id AS BIGINT) AS ship, {day_sql('d')} AS day FROM d WHERE NOT EXISTS (
  SELECT 1 FROM events e WHERE e.user_id = d.user_id AND CAST(e.ts AS DATE) = d.d AND event_type = 'signup')""",
)
def _(spark, sf_dir):
    out = TL.days_without(events(spark, sf_dir), ["user_id"], "ts", F.col("event_type") == "signup")
    return out.select(long(F.col("user_id")).alias("ship"), day_text(F.col("report_day")).alias("day"))


@query(
    "between_first_last",
    """WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events),
b AS (SELECT user_id, min(rn) AS lo, max(rn) AS hi FROM n WHERE event_type = 'signup' GROUP BY user_id)
SELECT CAST(event_id AS BIGINT) AS event_id FROM n JOIN b USING (user_id) WHERE rn BETWEEN lo AND hi""",
)
def _(spark, sf_dir):
    return TL.between_marks(events(spark, sf_dir), ["user_id"], ORDER, F.col("event_type") == "signup").select(event_id())


STAND_IN_SQL = f"""r AS ({A.REPORTS_SQL}),
s AS (SELECT *, max(CASE WHEN contains(eventTypesString, 'Noon') THEN 1 ELSE 0 END) OVER (PARTITION BY imo, CAST(date AS DATE)) AS anyn,
  row_number() OVER (PARTITION BY imo, CAST(date AS DATE) ORDER BY abs(hour(date) - 12), date, event_id) AS rn FROM r),
t AS (SELECT *, CASE WHEN anyn = 0 AND rn = 1 THEN
    CASE WHEN contains(eventTypesString, 'Departure') OR contains(eventTypesString, 'Port') THEN 'Noon In Port'
         WHEN regexp_matches(eventTypesString, 'AtSeaUnderwayUsingEngine|InPortMoored|AtSeaAnchoring|AtSeaDrifting') THEN 'Noon At Sea'
         ELSE eventTypesString END ELSE eventTypesString END AS report_type FROM s)"""


@query("override_coalesce", f"WITH {STAND_IN_SQL} SELECT CAST(event_id AS BIGINT) AS event_id, report_type FROM t")
def _(spark, sf_dir):
    return stand_in_noons(A.reports(spark, sf_dir), ["date", "event_id"]).select(event_id(), "report_type")


@query(
    "dedupe_keyed",
    """WITH a AS (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE), event_type ORDER BY ts, event_id) AS rn FROM events)
SELECT CAST(event_id AS BIGINT) AS event_id, event_type FROM a WHERE rn = 1""",
)
def _(spark, sf_dir):
    src = events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    return TL.top_row(src, ["user_id", "day", "event_type"], ORDER, latest=False).select(event_id(), "event_type")


@query(
    "latest_values",
    f"""WITH a AS (SELECT *, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS v, CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END AS t FROM events)
SELECT CAST(user_id AS BIGINT) AS ship, {day_sql('CAST(ts AS DATE)')} AS day,
  {shown_sql('arg_max(v, (ts, event_id)) FILTER (WHERE v IS NOT NULL)')} AS last_value, arg_max(t, (ts, event_id)) FILTER (WHERE t IS NOT NULL) AS last_type
FROM a GROUP BY user_id, CAST(ts AS DATE)""",
)
def _(spark, sf_dir):
    n = F.col("event_id")
    src = events(spark, sf_dir).withColumns(
        {"last_value": F.when(n % 3 != 0, F.col("value")), "last_type": F.when(n % 4 != 0, F.col("event_type")), "d": F.to_date("ts")}
    )
    out = src.groupBy("user_id", "d").agg(*latest_known(["last_value", "last_type"], ORDER))
    return out.select(long(F.col("user_id")).alias("ship"), day_text(F.col("d")).alias("day"), shown(F.col("last_value")).alias("last_value"), "last_type")


@query(
    "report_day_agg",
    f"""SELECT CAST(user_id AS BIGINT) AS ship, {day_sql('CAST(ts AS DATE)')} AS day, {shown_sql('sum(value)')} AS total,
  {shown_sql("coalesce(sum(value) FILTER (WHERE event_type = 'error'), 0)")} AS manoeuvring, {shown_sql("coalesce(sum(value) FILTER (WHERE event_type <> 'error'), 0)")} AS sailing,
  CAST(count(*) AS BIGINT) AS reports FROM events GROUP BY user_id, CAST(ts AS DATE)""",
)
def _(spark, sf_dir):
    v, manoeuvring = F.col("value"), F.col("event_type") == "error"
    out = events(spark, sf_dir).groupBy("user_id", F.to_date("ts").alias("d")).agg(
        F.sum(v).alias("total"), F.coalesce(F.sum(F.when(manoeuvring, v)), F.lit(0.0)).alias("m"),
        F.coalesce(F.sum(F.when(~manoeuvring, v)), F.lit(0.0)).alias("s"), F.count(F.lit(1)).alias("reports"),
    )
    return out.select(
        long(F.col("user_id")).alias("ship"), day_text(F.col("d")).alias("day"), shown(F.col("total")).alias("total"),
        shown(F.col("m")).alias("manoeuvring"), shown(F.col("s")).alias("sailing"), "reports",
    )


@query(
    "weighted_mean",
    f"""SELECT CAST(l_suppkey AS BIGINT) AS l_suppkey, {shown_sql('sum(l_extendedprice / 7 * w) / nullif(sum(w), 0)')} AS mean FROM
(SELECT *, CASE WHEN l_suppkey % 10 = 0 THEN 0 ELSE l_quantity END AS w FROM lineitem) GROUP BY l_suppkey""",
)
def _(spark, sf_dir):
    src = load(spark, sf_dir, "lineitem").withColumn("w", F.when(F.col("l_suppkey") % 10 == 0, F.lit(0.0)).otherwise(F.col("l_quantity")))
    out = src.groupBy(long(F.col("l_suppkey")).alias("l_suppkey")).agg(weighted_mean(F.col("l_extendedprice") / 7, F.col("w")).alias("mean"))
    return out.withColumn("mean", shown(F.col("mean")))
