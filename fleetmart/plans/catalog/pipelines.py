"""Whole pipelines: report consolidation, generator days, supplier merges, and the behaviours that build on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetmart.operators import behaviours as B
from fleetmart.operators import interpolate as I
from fleetmart.operators import project as P
from fleetmart.operators.joins import fact_join
from fleetmart.operators.settle import settle
from fleetmart.plans import generator_day as GD
from fleetmart.plans import merges as M
from fleetmart.plans import recorder as R
from fleetmart.plans import report_consolidation as RC
from fleetmart.plans.catalog import adapters as A
from fleetmart.plans.catalog import joins as CJ
from fleetmart.plans.catalog.base import day_sql, day_text, load, long, query, shown, shown_sql, stamp, stamp_sql
from fleetmart.plans.catalog.behaviours import result, result_sql
from fleetmart.plans.catalog.timeline import STAND_IN_SQL
from fleetmart.plans.trim import with_trim_percentages

# Report consolidation ------------------------------------------------------------------------------------------

_REST = "('AtSeaUnderwayUsingEngine', 'InPortMoored', 'AtSeaAnchoring', 'AtSeaDrifting')"
_CONSOLIDATED = f"""{STAND_IN_SQL.split('s AS (')[0].rstrip().rstrip(',')},
n AS (SELECT *, row_number() OVER (PARTITION BY imo ORDER BY date, event_id) AS pos FROM r),
b AS (SELECT imo, min(pos) AS lo, max(pos) AS hi FROM n WHERE contains(eventTypesString, 'Noon') GROUP BY imo),
k AS (SELECT n.* FROM n JOIN b USING (imo) WHERE pos BETWEEN lo AND hi AND eventTypesString NOT IN ('On Hire (In Port)', 'Noon At Sea | Entering Canal | Leaving Canal') AND time <= 30),
s AS (SELECT *, max(CASE WHEN contains(eventTypesString, 'Noon') THEN 1 ELSE 0 END) OVER (PARTITION BY imo, CAST(date AS DATE)) AS anyn,
  row_number() OVER (PARTITION BY imo, CAST(date AS DATE) ORDER BY abs(hour(date) - 12), date, event_id) AS rn FROM k),
t AS (SELECT *, CASE WHEN anyn = 0 AND rn = 1 THEN
    CASE WHEN contains(eventTypesString, 'Departure') OR contains(eventTypesString, 'Port') THEN 'Noon In Port'
         WHEN regexp_matches(eventTypesString, 'AtSeaUnderwayUsingEngine|InPortMoored|AtSeaAnchoring|AtSeaDrifting') THEN 'Noon At Sea'
         ELSE eventTypesString END ELSE eventTypesString END AS report_type FROM s),
q AS (SELECT *, contains(report_type, 'Noon') AS noon,
  min(CASE WHEN contains(report_type, 'Noon') THEN date END) OVER (PARTITION BY imo ORDER BY date RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nd FROM t),
nt AS (SELECT imo, date, min(report_type) AS ntype FROM t WHERE contains(report_type, 'Noon') GROUP BY imo, date),
u AS (SELECT q.*, ntype, CASE WHEN noon THEN q.date WHEN floor(epoch_us(nd) / 1e6) - floor(epoch_us(q.date) / 1e6) <= 26 * 3600 THEN nd
    WHEN nd IS NULL OR nd > CAST(CAST(q.date AS DATE) + 2 AS TIMESTAMP) THEN CAST(CAST(q.date AS DATE) + 1 AS TIMESTAMP) END AS noon_date,
  CASE WHEN noon THEN report_type WHEN floor(epoch_us(nd) / 1e6) - floor(epoch_us(q.date) / 1e6) <= 26 * 3600 THEN ntype ELSE report_type END AS noon_type
  FROM q LEFT JOIN nt ON nt.imo = q.imo AND nt.date = nd),
g AS (SELECT imo, noon_date, noon_type, count(*) FILTER (WHERE operationalMode IN {_REST}) AS sailing,
  {', '.join(f'sum({c}) FILTER (WHERE operationalMode IN {_REST}) AS {c}' for c in ('time', 'meHours', 'meHours1', 'aeCons', 'aeEnergyProd', 'meCons', 'meEnergyProd'))},
  sum(speedBosp * meHours1) FILTER (WHERE operationalMode IN {_REST}) / nullif(sum(meHours1) FILTER (WHERE operationalMode IN {_REST}), 0) AS speedBosp,
  sum(time) FILTER (WHERE operationalMode NOT IN {_REST}) AS manoeuvring_hours,
  arg_max(position, (date, event_id)) FILTER (WHERE position IS NOT NULL) AS position, arg_max(nextPortUnLocode, (date, event_id)) AS np, arg_max(prevPortUnLocode, (date, event_id)) AS pp
  FROM u WHERE noon_date IS NOT NULL GROUP BY imo, noon_date, noon_type HAVING sailing > 0),
pc AS (SELECT *, substr(regexp_replace(regexp_extract(position, '(?:Dep\\.|In\\sPort)\\s+(.*?)(?:\\s+PORT|$)', 1), 'PORT| |\\.', '', 'g'), 1, 4) AS code FROM g),
pn AS (SELECT *, CASE WHEN contains(noon_type, 'Port') THEN code ELSE pp END AS prevp, CASE WHEN contains(noon_type, 'Port') THEN code ELSE np END AS nextp FROM pc),
pl AS (SELECT *, lag(nextp) OVER (PARTITION BY imo ORDER BY noon_date, noon_type) AS lagp FROM pn)"""


@query(
    "report_consolidation",
    f"""WITH {_CONSOLIDATED} SELECT CAST(imo AS BIGINT) AS imo, {stamp_sql('noon_date')} AS noon_date, noon_type, {shown_sql('time')} AS time, {shown_sql('meCons')} AS meCons, {shown_sql('speedBosp')} AS speedBosp,
  {shown_sql('manoeuvring_hours')} AS manoeuvring_hours, prevp AS prevPort, CASE WHEN noon_type = 'Noon At Sea' AND position LIKE 'EOSP%' THEN lagp ELSE nextp END AS nextPort,
  {shown_sql('aeCons * 1000000 / nullif(aeEnergyProd, 0)')} AS aeSfoc, {shown_sql('meEnergyProd / nullif(meHours, 0)')} AS mePower FROM pl""",
)
def _(spark, sf_dir):
    out = RC.consolidate(A.reports(spark, sf_dir), tie=["event_id"])
    return out.select(
        long(F.col("imo")).alias("imo"), stamp(F.col("noon_date")).alias("noon_date"), "noon_type",
        *[shown(F.col(c)).alias(c) for c in ("time", "meCons", "speedBosp", "manoeuvring_hours")],
        F.col("prevPortUnLocode").alias("prevPort"), F.col("nextPortUnLocode").alias("nextPort"), shown(F.col("aeSfoc")).alias("aeSfoc"), shown(F.col("mePower")).alias("mePower"),
    )


# Generator days ------------------------------------------------------------------------------------------------

_HOURS_SQL = f"""c AS (SELECT event_id, user_id % 5 AS ship, ts, CASE user_id % 5 WHEN 0 THEN 'vessel_type_1' WHEN 1 THEN 'VESSEL_TYPE_2' WHEN 2 THEN 'vessel_type_3' ELSE 'none' END AS vessel_type,
  {', '.join(f'epoch_us(ts) / 3600000000.0 * {m} AS rh{i}' for i, m in ((1, 0.97), (2, 0.61), (3, 0.23), (4, 0.0)))},
  {', '.join(f'value * {m} AS kwh{i}' for i, m in ((1, 9.1), (2, 5.3), (3, 3.7), (4, 0.0)))}, value / 3.1 AS fuel_flow, value * 4.3 AS available_power FROM events),
l AS (SELECT *, {', '.join(f'round(rh{i} - lag(rh{i}) OVER (PARTITION BY ship ORDER BY ts, event_id), 1) AS g{i}' for i in (1, 2, 3, 4))} FROM c),
e AS (SELECT * FROM (VALUES ('VESSEL_TYPE_1', 1400.0, 1400.0, 1400.0, 1400.0, 0.8), ('VESSEL_TYPE_2', 2430.0, 3645.0, 3645.0, 3645.0, 0.9), ('VESSEL_TYPE_3', 1055.0, 1055.0, 1055.0, 1055.0, 0.8)) v(vt, m1, m2, m3, m4, lower_t)),
z AS (SELECT l.* EXCLUDE (kwh1, kwh2, kwh3, kwh4), {', '.join(f'CASE WHEN g{i} = 0 THEN 0.0 ELSE kwh{i} END AS kwh{i}' for i in (1, 2, 3, 4))}, e.* FROM l JOIN e ON vt = upper(vessel_type)),
y AS (SELECT *, ({' + '.join(f'(0.8 * m{i}) * (kwh{i} / m{i}) * g{i}' for i in (1, 2, 3, 4))}) / 0.96 AS demand, {' + '.join(f'0.8 * (0.8 * m{i}) * g{i}' for i in (1, 2, 3, 4))} AS room,
  kwh1 + kwh2 + kwh3 + kwh4 AS power, g1 + g2 + g3 + g4 AS hours, {' + '.join(f'CASE WHEN g{i} > 0 THEN 1 ELSE 0 END' for i in (1, 2, 3, 4))} AS cnt, list_reverse_sort([m1, m2, m3, m4]) AS big FROM z),
x0 AS (SELECT *, demand / nullif(room, 0) AS share, {', '.join(f"({' + '.join(f'big[{j}]' for j in range(1, k + 1))}) * 0.8 * 25 AS cap{k}" for k in (1, 2, 3, 4))} FROM y),
x1 AS (SELECT *, CASE WHEN coalesce({' OR '.join(f'(cnt = {k} AND demand <= cap{k}' + (f' AND demand > cap{k - 1}' if k > 1 else '') + ')' for k in (1, 2, 3, 4))}, FALSE) OR share >= 1 THEN 1.0 ELSE round(share, 3) END AS aeu,
  round(available_power / nullif(power + available_power, 0), 3) AS ap FROM x0),
x2 AS (SELECT *, CASE WHEN coalesce(ap <= 0.2 OR aeu = 1, FALSE) THEN 1 ELSE 0 END AS correct, (aeu - lower_t) * fuel_flow AS saving, (1 - lower_t) * fuel_flow AS best FROM x1
  WHERE NOT coalesce(kwh1 > m1 OR kwh2 > m2 OR kwh3 > m3 OR kwh4 > m4 OR hours = 0 OR (power = 0 AND hours > 0), FALSE)),
x3 AS (SELECT *, row_number() OVER (PARTITION BY ship, CAST(ts AS DATE), hour(ts) ORDER BY ts, correct NULLS FIRST, saving NULLS FIRST, best NULLS FIRST) AS rn FROM x2),
d AS (SELECT ship, CAST(ts AS DATE) AS report_date, lower_t, count(*) AS total_hours, sum(correct) AS good, coalesce(sum(saving), 0) AS saved, coalesce(sum(best), 0) AS best FROM x3 WHERE rn = 1 GROUP BY 1, 2, 3 HAVING count(*) >= 10),
days AS (SELECT ship, report_date, lower_t, total_hours, good, total_hours - good AS over_hours, CASE WHEN total_hours - good <= 3 THEN 1 ELSE 0 END AS epm_success, saved, best FROM d
  UNION ALL SELECT DISTINCT ship, CAST(ts AS DATE), 0, 0, 0, 0, 0, 0, 0 FROM c WHERE vessel_type = 'none')"""


def counters(spark, sf_dir):
    src = load(spark, sf_dir, "events")
    hours = F.unix_micros("ts") / 3_600_000_000.0
    kind = F.when(F.col("user_id") % 5 == 0, "vessel_type_1").when(F.col("user_id") % 5 == 1, "VESSEL_TYPE_2").when(F.col("user_id") % 5 == 2, "vessel_type_3").otherwise("none")
    return src.select(
        "event_id", (F.col("user_id") % 5).alias("ship"), "ts", kind.alias("vessel_type"),
        *[(hours * m).alias(f"rh{i}") for i, m in ((1, 0.97), (2, 0.61), (3, 0.23), (4, 0.0))],
        *[(F.col("value") * m).alias(f"kwh{i}") for i, m in ((1, 9.1), (2, 5.3), (3, 3.7), (4, 0.0))],
        (F.col("value") / 3.1).alias("fuel_flow"), (F.col("value") * 4.3).alias("available_power"),
    )


def generator_days(spark, sf_dir):
    return GD.generator_days(counters(spark, sf_dir), GD.engine_dimension(spark), tie=["event_id"])


@query(
    "generator_day",
    f"""WITH {_HOURS_SQL} SELECT CAST(ship AS BIGINT) AS ship, {day_sql('report_date')} AS report_date, {shown_sql('lower_t')} AS aeu_lower_threshold, CAST(total_hours AS BIGINT) AS total_hours, CAST(good AS BIGINT) AS total_good_hours,
  CAST(over_hours AS BIGINT) AS overproduced_hours, CAST(epm_success AS BIGINT) AS epm_success, {shown_sql('saved')} AS epm_fuel_saved, {shown_sql('best')} AS epm_best_fuel_saved FROM days""",
)
def _(spark, sf_dir):
    out = generator_days(spark, sf_dir)
    return out.select(
        long(F.col("ship")).alias("ship"), day_text(F.col("report_date")).alias("report_date"), shown(F.col("aeu_lower_threshold")).alias("aeu_lower_threshold"),
        *[long(F.col(c)).alias(c) for c in ("total_hours", "total_good_hours", "overproduced_hours", "epm_success")], *[shown(F.col(c)).alias(c) for c in ("epm_fuel_saved", "epm_best_fuel_saved")],
    )


@query(
    "behaviour_epm",
    f"""WITH {_HOURS_SQL}, r AS (SELECT *, CASE WHEN total_hours <= 3 THEN 'NOT_POSSIBLE__VOYAGE_TOO_SHORT' WHEN total_hours > 30 THEN 'FAULTY_DATA__INVALID_RUNNING_HOURS' ELSE '' END AS reason FROM days),
o AS (SELECT *, (reason = '' AND epm_success = 1) AS ok FROM r)
SELECT CAST(ship AS BIGINT) AS ship, {day_sql('report_date')} AS report_date, {shown_sql('saved')} AS net_savings, CAST(ok AS INTEGER) AS success, {shown_sql('CASE WHEN ok THEN saved ELSE 0 END')} AS savings,
  {shown_sql('CASE WHEN ok THEN best ELSE 0 END')} AS best_case_savings, reason FROM o""",
)
def _(spark, sf_dir):
    out = B.calculate(generator_days(spark, sf_dir), "Efficient_Power_Management")
    return out.select(
        long(F.col("ship")).alias("ship"), day_text(F.col("report_date")).alias("report_date"), shown(F.col("epm__net_savings")).alias("net_savings"), F.col("epm__success").cast("int").alias("success"),
        shown(F.col("epm__savings")).alias("savings"), shown(F.col("epm__best_case_savings")).alias("best_case_savings"), F.col("epm__reason").alias("reason"),
    )


# Tanker behaviours on curves and grids ------------------------------------------------------------------------

_CURVE_SQL = """cu AS (SELECT p_brand AS brand, CAST(p_size AS DOUBLE) * 2 AS x, 90 + min(p_retailprice) / 11 AS y FROM part GROUP BY 1, 2),
lo AS (SELECT brand, arg_max((x, y), x) AS p FROM cu WHERE x <= 80.0 GROUP BY 1), hi AS (SELECT brand, arg_min((x, y), x) AS p FROM cu WHERE x >= 80.0 GROUP BY 1),
sf AS (SELECT brand, round(CASE WHEN lo.p[1] = hi.p[1] THEN lo.p[2] ELSE lo.p[2] + (hi.p[2] - lo.p[2]) * (80.0 - lo.p[1]) / nullif(hi.p[1] - lo.p[1], 0) END, 6) AS sfoc_min FROM lo JOIN hi USING (brand) WHERE brand <> 'Brand#7')"""


@query(
    "behaviour_emo_curve",
    result_sql(
        f"""{_CURVE_SQL}, s AS ({A.SHIPS_SQL}),
a AS (SELECT s.*, 12 + l_suppkey % 20 AS allowed, emo_sfoc AS emo, me_hours AS hrs, me_power AS kwhrs, total_propulsion_consumption_new AS prop, total_generator_consumption_new AS gens, sfoc_min
  FROM s JOIN part ON p_partkey = l_partkey LEFT JOIN sf ON brand = p_brand),
b AS (SELECT a.*, emo * (hrs * kwhrs) / 1000 AS used, (emo - sfoc_min) / nullif(sfoc_min, 0) * 100 AS delta FROM a),
c AS (SELECT b.*, used / nullif(1 + delta / 100, 0) AS ideal FROM b),
x AS (SELECT c.*, ideal * (1 + allowed / 100.0) AS most, ideal * (1 - allowed / 100.0) AS least_f FROM c)""",
        [
            ("NOT_POSSIBLE__NOT_AT_SEA", "speed_bosp - 1 <= 0"),
            ("NOT_POSSIBLE__VOYAGE_TOO_SHORT", "voyage_time_hs < 6"),
            ("FAULTY_DATA__INVALID_RUNNING_HOURS", "hrs < 20 OR hrs > 30"),
            ("FAULTY_DATA__INVALID_SFOC", "emo < 50 OR emo > 400"),
            ("FAULTY_DATA__INVALID_KWHRS", "kwhrs > 10000"),
            ("FAULTY_DATA__INVALID_PROPULSION_CONSUMPTION", "prop <= 0 OR prop > 100"),
            ("FAULTY_DATA__INVALID_GENERATOR_CONSUMPTION", "gens <= 0 OR gens > 100"),
            ("FAULTY_DATA__SFOC_NOT_AVAILABLE", "sfoc_min IS NULL"),
            ("FAULTY_DATA__INVALID_DELTA_SFOC", "delta > 100"),
        ],
        "most - used", "most - used > 0 AND delta < allowed", best="CASE WHEN ok THEN most - least(least_f, used) ELSE 0 END",
    ),
)
def _(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    curve = part.groupBy(F.col("p_brand").alias("imo"), (F.col("p_size").cast("double") * 2).alias("mrc_load")).agg((90 + F.min("p_retailprice") / 11).alias("sfoc_tolereance_min"))
    curve = curve.withColumns({"sfoc": F.lit(1.0), "sfoc_tolereance_max": F.lit(2.0)})
    brands = {f"Brand#{i}": 80.0 for i in range(100) if i != 7}  # one ship without a curve
    s = fact_join(A.ships(spark, sf_dir), part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand")), ["l_partkey"], "inner")
    s = I.with_curve_floor(s.withColumn("imo", F.col("brand")), curve, brands).withColumns(
        {
            "steaming_hours": F.col("voyage_time_hs"), "mainenginerunninghrs": F.col("me_hours"), "main_engine_kwhrs": F.col("me_power"),
            "emo_delta_fuel": (12 + F.col("l_suppkey") % 20).cast("double"), "speedthroughwatermehrs": F.col("speed_bosp") - 1, "observeddistance": F.lit(10.0),
        }
    )
    return result(B.calculate(s, "Engine_Maintenance_Optimisation_Curve"), "emo")


_TRIM_GRID_SQL = """g AS (SELECT concat('C', CAST(l_suppkey % 4 AS VARCHAR)) AS ship_class, CAST(l_linenumber AS DOUBLE) AS draft, floor(l_quantity / 10) * 4.0 AS speed,
  round(l_discount * 50) - 2.0 AS trim, max(l_extendedprice) / 9700.0 AS power FROM lineitem GROUP BY 1, 2, 3, 4)"""


def trim_grid(spark, sf_dir):
    nodes = load(spark, sf_dir, "lineitem").groupBy(
        F.concat(F.lit("C"), (F.col("l_suppkey") % 4).cast("string")).alias("ship_class"), F.col("l_linenumber").cast("double").alias("draft"),
        (F.floor(F.col("l_quantity") / 10) * 4.0).cast("double").alias("speed"), (F.round(F.col("l_discount") * 50) - 2.0).alias("trim"),
    ).agg((F.max("l_extendedprice") / 9700.0).alias("power"))
    return settle(nodes)


def trim_limits(spark, sf_dir):
    n = F.col("s_suppkey")
    return load(spark, sf_dir, "supplier").filter(n % 5 != 0).select(
        (9_100_000 + n).cast("string").alias("imo"), F.concat(F.lit("C"), (n % 4).cast("string")).alias("ship_class"), (3.0 + n % 9).alias("trim_perc_limit")
    )


@query(
    "behaviour_trim",
    result_sql(
        f"""s AS ({A.SHIPS_SQL}), li AS (SELECT CAST(9100000 + s_suppkey AS VARCHAR) AS lim_imo, concat('C', CAST(s_suppkey % 4 AS VARCHAR)) AS ship_class, 3.0 + s_suppkey % 9 AS lim FROM supplier WHERE s_suppkey % 5 <> 0),
h AS (SELECT s.*, ship_class, lim, least(speed_bosp, 15.0) AS spd FROM s LEFT JOIN li ON lim_imo = imo),
{CJ.grid_power_sql(_TRIM_GRID_SQL, 'h', 'f.meandraft', 'f.spd', 'f.trim', 'pct')},
x AS (SELECT *, total_propulsion_consumption_new * 1000 AS fuel FROM gp)""",
        [
            ("NOT_POSSIBLE__TRIM_NOT_AVAILABLE", "lim IS NULL"),
            ("NOT_POSSIBLE__NOT_AT_SEA", "speed_bosp <= 0"),
            ("NOT_POSSIBLE__SPEED_UNDER_MIN", "speed_bosp < 11"),
            ("FAULTY_DATA__INVALID_SPEED", "speed_bosp > 20"),
            ("FAULTY_DATA__INVALID_MEAN_DRAFT", "meandraft > 20"),
            ("NOT_POSSIBLE__TANK_CLEANING", "tank_cleaning_consumption_mgo > 0"),
            ("NOT_POSSIBLE__BAD_WEATHER", "beaufort >= 6"),
            ("NOT_POSSIBLE__TRIM_OUT_OF_LIMITS", "pct IS NULL"),
        ],
        "CASE WHEN 1 + pct / 100 > 0 THEN fuel * ((1 + lim / 100) / (1 + pct / 100)) - fuel ELSE 0 END", "pct <= lim", best="CASE WHEN ok THEN fuel * (1 + lim / 100) - fuel ELSE 0 END",
    ),
)
def _(spark, sf_dir):
    s = A.ships(spark, sf_dir).withColumns({"speedthroughwatermehrs": F.col("speed_bosp"), "observeddistance": F.lit(10.0)})
    limits = trim_limits(spark, sf_dir)
    return result(B.calculate(with_trim_percentages(s, trim_grid(spark, sf_dir), limits, ideal=False), "Optimal_Trim"), "optimal_trim")


# Supplier merges ----------------------------------------------------------------------------------------------

@query(
    "merge_flights",
    f"""WITH p AS (SELECT event_id, user_id, ts, value, row_number() OVER (PARTITION BY user_id, ts ORDER BY concat('C', CAST(event_id % 4 AS VARCHAR)), event_id) AS one FROM events WHERE event_type IN ('purchase', 'signup')),
c AS (SELECT * FROM events WHERE event_type IN ('click', 'view')),
j AS (SELECT p.event_id, c.value AS burn, c.ts AS tts, row_number() OVER (PARTITION BY p.event_id ORDER BY abs(epoch_us(p.ts) - epoch_us(c.ts)), c.ts, c.value) AS rn
  FROM p JOIN c ON p.user_id = c.user_id AND abs(epoch_us(p.ts) - epoch_us(c.ts)) <= 3600::BIGINT * 1000000 WHERE one = 1)
SELECT concat('G', CAST(user_id AS VARCHAR)) AS aircraft_reg_code, {stamp_sql('ts')} AS ocurrence_datetime, {stamp_sql('tts')} AS target_ocurrence_datetime, {shown_sql('burn')} AS fuel_burn_cruise1,
  concat('C', CAST(event_id % 4 AS VARCHAR)) AS customer_code_upper, strftime(ts, '%Y%m%d%H%M%S') AS ocurrence_datetime_numeric FROM p JOIN j USING (event_id) WHERE rn = 1""",
)
def _(spark, sf_dir):
    src = load(spark, sf_dir, "events").withColumn("aircraft_reg_code", F.concat(F.lit("G"), F.col("user_id").cast("string")))
    kind, keep = F.col("event_type"), ["aircraft_reg_code", F.col("ts").alias("ocurrence_datetime")]
    flights = src.filter(kind.isin("purchase", "signup")).select(*keep, F.concat(F.lit("c"), (F.col("event_id") % 4).cast("string")).alias("customer_code"), F.col("event_id").alias("sourcefilename"))
    burned = src.filter(kind.isin("click", "view")).select(*keep, F.col("value").alias("fuel_burn_cruise1"), F.lit("x").alias("status"))
    out = M.flights_with_recordings(flights, burned)
    return out.select(
        "aircraft_reg_code", stamp(F.col("ocurrence_datetime")).alias("ocurrence_datetime"), stamp(F.col("target_ocurrence_datetime")).alias("target_ocurrence_datetime"),
        shown(F.col("fuel_burn_cruise1")).alias("fuel_burn_cruise1"), "customer_code_upper", "ocurrence_datetime_numeric",
    )


@query(
    "merge_ship_crew",
    f"""WITH w AS (SELECT user_id AS imo, ts, event_id, lead(CAST(ts AS DATE)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS end_date FROM events WHERE event_type = 'signup'),
crew AS (SELECT imo AS cimo, CAST(ts AS DATE) AS start_date, end_date, CASE WHEN event_id % 2 = 0 THEN 'master' ELSE 'chief engineer' END AS rank,
  concat('jo crew', CAST(event_id % 50 AS VARCHAR)) AS full_name, concat('DBN', CAST(event_id AS VARCHAR)) AS dbn FROM w),
r AS (SELECT user_id AS imo, CAST(ts AS DATE) AS date, min(('cap ' || CAST(event_id % 5 AS VARCHAR), 'eng ' || CAST(event_id % 3 AS VARCHAR))) AS names FROM events WHERE event_type = 'purchase' GROUP BY 1, 2),
b AS (SELECT r.imo, r.date, crew.* FROM r JOIN crew ON cimo = r.imo AND start_date <= r.date AND r.date <= coalesce(end_date, DATE '{CJ.OPEN_END}')),
g AS (SELECT imo, date, arg_min(full_name, (start_date, full_name, dbn)) FILTER (WHERE rank = 'master') AS captain_on_board, arg_min(dbn, (start_date, full_name, dbn)) FILTER (WHERE rank = 'chief engineer') AS engineer_dbn FROM b GROUP BY 1, 2)
SELECT CAST(r.imo AS BIGINT) AS imo, {day_sql('r.date')} AS day, concat('Cap ', right(names[1], 1)) AS reported__captain, captain_on_board, engineer_dbn FROM r LEFT JOIN g ON g.imo = r.imo AND g.date = r.date""",
)
def _(spark, sf_dir):
    src, n = load(spark, sf_dir, "events"), F.col("event_id")
    reports = src.filter(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("imo"), F.col("ts").alias("date"), F.concat(F.lit("CAP. "), (n % 5).cast("string")).alias("captain"), F.concat(F.lit("Eng "), (n % 3).cast("string")).alias("chiefEngineer")
    )
    duty = CJ.crew(spark, sf_dir)
    rotation = duty.select(
        "imo", F.lit("Jo Ann").alias("firstname"), F.col("full_name").alias("lastname"), "rank", "start_date", "end_date", F.col("dbn").alias("discharge_book_number")
    )
    out = M.reports_with_crew(reports, rotation, CJ.OPEN_END, latest_only=False)
    return out.select(
        long(F.col("imo")).alias("imo"), day_text(F.col("date")).alias("day"), "reported__captain", F.col("crew__captain").alias("captain_on_board"), F.col("crew__chiefEngineerDBN").alias("engineer_dbn")
    )


# Recorder files -----------------------------------------------------------------------------------------------

@query(
    "recorder_times",
    f"""WITH a AS (SELECT user_id, max(day(ts)) AS d, max(month(ts)) AS m, max(hour(ts) % 10) AS h1, max(CAST(hour(ts) // 10 AS BIGINT)) AS h10, max(minute(ts)) AS mi FROM events GROUP BY user_id),
t AS (SELECT user_id, CASE WHEN h1 + h10 * 10 < 24 THEN make_timestamp(2023, m, d, h1 + h10 * 10, mi, 0.0) END AS dep FROM a)
SELECT concat('file', CAST(user_id AS VARCHAR)) AS source_file_name, {stamp_sql('dep')} AS actual_departure, {stamp_sql('time_bucket(INTERVAL 10 MINUTE, dep)')} AS plan_departure, {stamp_sql('dep + INTERVAL 30 SECOND')} AS actual_arrival FROM t""",
)
def _(spark, sf_dir):
    src = load(spark, sf_dir, "events")
    records = src.select(
        F.concat(F.lit("file"), F.col("user_id").cast("string")).alias("source_file_name"), F.dayofmonth("ts").alias("day"), F.month("ts").alias("Month"),
        (F.hour("ts") % 10).alias("utc_hr_x1"), F.floor(F.hour("ts") / 10).alias("utc_hr_x10"), F.minute("ts").alias("gmt_min"), "value",
    )
    records = P.all_to_string(records)  # as ingested
    out = R.flight_times(records, "source_file_name", 2023)
    return out.select("source_file_name", *[stamp(F.col(c)).alias(c) for c in ("actual_departure", "plan_departure", "actual_arrival")])
