"""Projections, text and date functions, mappings, ledger, unions, pivots."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from fleetmart.functions import columns as X
from fleetmart.functions import dates as D
from fleetmart.functions import strings as St
from fleetmart.functions.registry import apply_formulas, with_columns
from fleetmart.operators import aggregates as G
from fleetmart.operators import filters as Fi
from fleetmart.operators import ledger as L
from fleetmart.operators import project as P
from fleetmart.operators.settle import scratch_dir
from fleetmart.plans.catalog import adapters as A
from fleetmart.plans.catalog.base import day_sql, day_text, load, long, query, shown, shown_sql, stamp, stamp_sql
from fleetmart.plans.mapping import Field, Mapping, apply_expressions, apply_mapping, ensure_fields
from fleetmart.plans.noon import fuel_by_type
from fleetmart.sources import keyed
from fleetmart.sources.files import snapshot
from fleetmart.sources.sinks import merged

import fleetmart.functions.formulas  # noqa: F401

# -- names, casts, keys


@query(
    "sanitize_columns",
    "SELECT CAST(p_partkey AS BIGINT) AS part_key_1, p_name AS the___name, p_brand AS brand_name, p_brand AS brand_name_1, p_type AS type__x FROM part",
)
def _(spark, sf_dir):
    raw = load(spark, sf_dir, "part").select(long(F.col("p_partkey")), "p_name", "p_brand", "p_brand", "p_type")
    raw = raw.toDF(*P.unique_names(["  Part Key.1 ", "The   Name!", "Brand Name", "Brand Name", "Type ,x"]))
    return P.canonical_header(P.blanks_to_underscores(P.sanitise_names(P.trim_names(raw))))


@query("order_columns", "SELECT p_brand, CAST(p_size AS BIGINT) AS p_size, CAST(p_partkey AS BIGINT) AS p_partkey, p_name FROM part")
def _(spark, sf_dir):
    src = load(spark, sf_dir, "part").select(long(F.col("p_partkey")).alias("p_partkey"), "p_name", "p_brand", long(F.col("p_size")).alias("p_size"))
    return P.columns_first(src, ["p_brand", "p_size"])


@query("cast_all_string", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders")
def _(spark, sf_dir):
    src = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("o_orderdate"))
    return P.all_to_string(src)


@query(
    "double_to_decimal",
    "SELECT CAST(p_partkey AS BIGINT) AS p_partkey, CAST(CAST(p_retailprice AS DECIMAL(18,5)) AS VARCHAR) AS price, CAST(CAST(p_retailprice / 7 AS DECIMAL(18,5)) AS VARCHAR) AS part_price FROM part",
)
def _(spark, sf_dir):
    src = load(spark, sf_dir, "part").select(long(F.col("p_partkey")).alias("p_partkey"), F.col("p_retailprice").alias("price"), (F.col("p_retailprice") / 7).alias("part_price"))
    out = P.doubles_to_decimal(src)
    return out.select("p_partkey", F.col("price").cast("string").alias("price"), F.col("part_price").cast("string").alias("part_price"))


@query("struct_to_json", """SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, concat('{"name":"', n_name, '","region":', CAST(n_regionkey AS VARCHAR), '}') AS place FROM nation""")
def _(spark, sf_dir):
    src = load(spark, sf_dir, "nation").select(long(F.col("n_nationkey")).alias("n_nationkey"), F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")).alias("place"))
    return P.structs_to_json(src)


@query(
    "decorate_metadata",
    """SELECT CAST(page_id AS BIGINT) AS page_id, regexp_extract(url, '[^/]*$') AS source_file_name, 'incomplete' AS status,
  '2024-07-07 16:10:17' AS ingestion_datetime, 'run-7' AS ingestion_job_run_id, url AS file_path FROM pages""",
)
def _(spark, sf_dir):
    src = load(spark, sf_dir, "pages").select(long(F.col("page_id")).alias("page_id"), "url")
    out = P.decorate(src, "run-7", "2024-07-07T16:10:17", name=F.regexp_extract("url", "[^/]*$", 0), path=F.concat(F.lit("dbfs:"), F.col("url")))
    return out.drop("url").withColumn("ingestion_datetime", stamp(F.col("ingestion_datetime")))


@query("url_decode_path", "SELECT CAST(page_id AS BIGINT) AS page_id, concat('/a b/', replace(url, '#', '+')) AS path FROM pages")
def _(spark, sf_dir):
    raw = F.concat(F.lit("file:///a%20b/"), F.regexp_replace("url", "#", "+"))
    return load(spark, sf_dir, "pages").select(long(F.col("page_id")).alias("page_id"), St.strip_scheme(St.decode_path(raw)).alias("path"))


@query("composite_key", "SELECT concat('VS_', CAST(o_orderkey AS VARCHAR), '_', o_orderstatus) AS event_openid FROM orders")
def _(spark, sf_dir):
    return load(spark, sf_dir, "orders").select(P.composite_key("vs", ["o_orderkey", "o_orderstatus"]).alias("event_openid"))


def _key_part_sql(expr: str) -> str:
    return f"coalesce(concat(length(CAST({expr} AS VARCHAR)), ':', CAST({expr} AS VARCHAR)), '-')" if expr == "o_orderkey" else f"CASE WHEN {expr} IS NULL THEN '-' ELSE concat(length({expr}), ':', {expr}) END"


# the first and last part are NULL for some orders, and hold separators
@query(
    "deterministic_id",
    f"""WITH o AS (SELECT o_orderkey, nullif(o_orderstatus, 'F') AS a, CASE WHEN o_orderkey % 3 > 0 THEN concat(o_orderpriority, '|', o_orderstatus) END AS b FROM orders)
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, sha256(concat({_key_part_sql('a')}, {_key_part_sql('o_orderkey')}, {_key_part_sql('b')})) AS id FROM o""",
)
def _(spark, sf_dir):
    n, status = F.col("o_orderkey"), F.col("o_orderstatus")
    keyed = load(spark, sf_dir, "orders").select(n, F.when(status != "F", status).alias("a"), F.when(n % 3 > 0, F.concat("o_orderpriority", F.lit("|"), status)).alias("b"))
    return keyed.select(long(n).alias("o_orderkey"), P.stable_id(["a", "o_orderkey", "b"]).alias("id"))


@query("content_checksum", "SELECT CAST(doc_id AS BIGINT) AS doc_id, sha256(text) AS etag FROM documents")
def _(spark, sf_dir):
    return load(spark, sf_dir, "documents").select(long(F.col("doc_id")).alias("doc_id"), F.sha2(F.col("text").cast("binary"), 256).alias("etag"))


@query("safe_ratio", f"SELECT {A.LINE_KEY[0]}, l_partkey, {shown_sql('l_extendedprice * 1000 / nullif(l_quantity - 25, 0)')} AS ratio FROM lineitem")
def _(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", shown(X.ratio(F.col("l_extendedprice") * 1000, F.col("l_quantity") - 25)).alias("ratio"))


# -- text and dates


@query(
    "string_cleaning",
    """SELECT CAST(c_custkey AS BIGINT) AS c_custkey, regexp_replace(c_name, '\\D', '', 'g') AS digits, regexp_replace(regexp_replace(c_name, '\\D', '', 'g'), '^0+', '') AS no_zeros,
  regexp_replace(concat(c_mktsegment, '  ', c_name), '\\s+', '', 'g') AS squeezed FROM customer""",
)
def _(spark, sf_dir):
    name = F.col("c_name")
    return load(spark, sf_dir, "customer").select(
        long(F.col("c_custkey")).alias("c_custkey"), St.digits_only(name).alias("digits"), St.strip_leading_zeros(St.digits_only(name)).alias("no_zeros"),
        St.squeeze_blanks(F.concat(F.col("c_mktsegment"), F.lit("  "), name)).alias("squeezed"),
    )


@query(
    "port_extract",
    f"""WITH r AS ({A.REPORTS_SQL}) SELECT CAST(event_id AS BIGINT) AS event_id,
  substr(regexp_replace(regexp_extract(position, '(?:Dep\\.|In\\sPort)\\s+(.*?)(?:\\s+PORT|$)', 1), 'PORT| |\\.', '', 'g'), 1, 4) AS port FROM r""",
)
def _(spark, sf_dir):
    return A.reports(spark, sf_dir).select(long(F.col("event_id")).alias("event_id"), St.port_code(F.col("position")).alias("port"))


@query(
    "name_cleaning",
    """WITH a AS (SELECT p_partkey, concat(p_name, ' Van. ', p_type, ' ', split_part(p_name, ' ', 2)) AS full_name FROM part),
b AS (SELECT p_partkey, full_name, list_filter(string_split_regex(full_name, '\\s+'), lambda x: x <> '') AS w FROM a),
c AS (SELECT *, list_filter(w, lambda x, i: list_position(w, x) = i) AS u FROM b)
SELECT CAST(p_partkey AS BIGINT) AS p_partkey, regexp_replace(lower(array_to_string(u, ' ')), '\\.', '', 'g') AS spoken,
  array_to_string(list_transform(w, lambda x: concat(upper(x[1]), lower(x[2:]))), ' ') AS title FROM c""",
)
def _(spark, sf_dir):
    full = F.concat_ws(" ", "p_name", F.lit("Van."), "p_type", F.split("p_name", " ")[1])
    return load(spark, sf_dir, "part").select(
        long(F.col("p_partkey")).alias("p_partkey"), St.spoken_name(full).alias("spoken"), St.title_words(full).alias("title")
    )


@query(
    "formula_text",
    """SELECT CAST(doc_id AS BIGINT) AS doc_id, CASE WHEN length(t) >= 3 THEN t END AS origin, coalesce(CASE WHEN length(t) >= 3 THEN t END, 'UNKNOWN') AS destination
FROM (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN lang ELSE source END AS t FROM documents)""",
)
def _(spark, sf_dir):
    t = F.when(F.col("doc_id") % 4 == 0, F.col("lang")).otherwise(F.col("source"))
    src = load(spark, sf_dir, "documents").select(long(F.col("doc_id")).alias("doc_id"), t.alias("origin"))
    long_names = apply_formulas(src, ["origin"], "tanker")
    return apply_formulas(long_names.withColumn("destination", F.col("origin")), ["destination"], "sea")


@query(
    "classify_report",
    f"""WITH r AS ({A.REPORTS_SQL}) SELECT CAST(event_id AS BIGINT) AS event_id, CASE WHEN contains(eventTypesString, 'Departure') OR contains(eventTypesString, 'Port') THEN 'Noon In Port'
  WHEN regexp_matches(eventTypesString, 'AtSeaUnderwayUsingEngine|InPortMoored|AtSeaAnchoring|AtSeaDrifting') THEN 'Noon At Sea' ELSE eventTypesString END AS kind FROM r""",
)
def _(spark, sf_dir):
    return A.reports(spark, sf_dir).select(long(F.col("event_id")).alias("event_id"), St.report_kind(F.col("eventTypesString")).alias("kind"))


_TEXTS = """CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y %H:%M:%S')
  WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000Z') WHEN 3 THEN 'not a date' ELSE NULL END"""


def date_texts():
    d, n = F.col("o_orderdate"), F.col("o_orderkey") % 5
    return (
        F.when(n == 0, stamp(d)).when(n == 1, F.date_format(d, "dd/MM/yyyy HH:mm:ss"))
        .when(n == 2, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'.000Z'")).when(n == 3, F.lit("not a date"))
    )


@query(
    "parse_dates",
    f"""WITH t AS (SELECT o_orderkey, {_TEXTS} AS txt FROM orders)
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, {stamp_sql("coalesce(try_strptime(txt, '%Y-%m-%d %H:%M:%S'), try_strptime(txt, '%Y-%m-%dT%H:%M:%S.%gZ'), try_strptime(txt, '%d/%m/%Y %H:%M:%S'))")} AS parsed FROM t""",
)
def _(spark, sf_dir):
    return load(spark, sf_dir, "orders").select(long(F.col("o_orderkey")).alias("o_orderkey"), D.normalised(date_texts()).alias("parsed"))


@query(
    "date_parts",
    f"""SELECT CAST(event_id AS BIGINT) AS event_id, {day_sql('ts')} AS day, CAST(hour(ts) AS BIGINT) AS hour, CAST(dayofweek(ts) AS BIGINT) AS weekday, CAST(year(ts) AS BIGINT) AS y, CAST(month(ts) AS BIGINT) AS m,
  CAST(day(ts) AS BIGINT) AS d, {day_sql('CAST(ts AS DATE) + 2')} AS ahead, {day_sql('CAST(ts AS DATE) - 1')} AS back, {stamp_sql('make_timestamp(epoch_ms(ts) // 60000 * 60000000)')} AS minute FROM events""",
)
def _(spark, sf_dir):
    ts = F.col("ts")
    return load(spark, sf_dir, "events").select(
        long(F.col("event_id")).alias("event_id"), day_text(ts).alias("day"), long(F.hour(ts)).alias("hour"), long(D.weekday_from_sunday(ts)).alias("weekday"),
        long(F.year(ts)).alias("y"), long(F.month(ts)).alias("m"), long(F.dayofmonth(ts)).alias("d"), day_text(F.date_add(ts, 2)).alias("ahead"), day_text(F.date_sub(ts, 1)).alias("back"),
        stamp(F.timestamp_millis(F.floor(F.unix_millis(ts) / 60000) * 60000)).alias("minute"),
    )


@query(
    "formula_times",
    f"""WITH a AS (SELECT o_orderkey, o_orderdate AS dep, o_orderdate + to_minutes(CAST(200 + o_orderkey % 600 AS INTEGER)) AS arr, o_orderkey % 40 AS taxi, (o_orderkey % 50) / 4.0 AS hs FROM orders)
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, {shown_sql("(date_diff('second', dep, arr) / 60.0 - taxi) / 60")} AS plnd_airborne_time, {stamp_sql('arr - to_microseconds(CAST(hs * 3600000000 AS BIGINT))')} AS ocurrence_datetime FROM a""",
)
def _(spark, sf_dir):
    n = F.col("o_orderkey")
    src = load(spark, sf_dir, "orders").select(
        long(n).alias("o_orderkey"), F.col("o_orderdate").alias("plnd_departure_time"),
        F.timestamp_seconds(F.unix_seconds("o_orderdate") + (200 + n % 600) * 60).alias("plnd_arrival_time"), (n % 40).alias("planned_taxi_time"), ((n % 50) / 4.0).alias("voyage_time_hs"),
    )
    out = apply_formulas(src, ["plnd_airborne_time"], "aviation").withColumn("arrival_datetime", F.col("plnd_arrival_time"))
    out = apply_formulas(out, ["ocurrence_datetime"], "sea")
    return out.select("o_orderkey", shown(F.col("plnd_airborne_time")).alias("plnd_airborne_time"), stamp(F.col("ocurrence_datetime")).alias("ocurrence_datetime"))


@query("duration_bucket", "SELECT l_orderkey, l_partkey, CASE WHEN h <= 3 THEN 'SHORT' WHEN h <= 6 THEN 'MID' ELSE 'LONG' END AS duration FROM (SELECT *, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity / 5 END AS h FROM lineitem)")
def _(spark, sf_dir):
    src = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", F.when(F.col("l_linenumber") != 7, F.col("l_quantity") / 5).alias("airborne_time"))
    return apply_formulas(src, ["duration"], "aviation").drop("airborne_time")


@query("unit_convert", f"SELECT l_orderkey, l_partkey, {shown_sql("CASE WHEN l_returnflag = 'N' THEN l_extendedprice / 7 * 0.454 ELSE l_extendedprice / 7 END")} AS kg FROM lineitem")
def _(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", shown(X.pounds_to_kg(F.col("l_extendedprice") / 7, F.col("l_returnflag") == "N")).alias("kg"))


@query(
    "assemble_datetime",
    f"""SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, {stamp_sql("time_bucket(INTERVAL 10 MINUTE, make_timestamp(CASE WHEN o_orderkey % 3 = 0 THEN 2025 ELSE year(o_orderdate) END, month(o_orderdate), least(day(o_orderdate), 28), o_orderkey % 10 + (o_orderkey % 2) * 10, o_orderkey % 10 + (o_orderkey % 5) * 10, 0.0))")} AS planned FROM orders""",
)
def _(spark, sf_dir):
    d, n = F.col("o_orderdate"), F.col("o_orderkey")
    year = F.when(n % 3 != 0, F.year(d) % 100)
    year = F.when(F.year(d) < 2000, F.when(n % 3 != 0, F.year(d))).otherwise(year)
    year = F.when(n % 3 == 0, F.lit(None)).otherwise(F.when(F.year(d) == 2000, F.lit(2000)).otherwise(year))
    hour, minute = D.from_units_and_tens(n % 10, n % 2), D.from_units_and_tens(n % 10, n % 5)
    ts = D.assemble_datetime(F.least(F.dayofmonth(d), F.lit(28)), F.month(d), year, hour, minute, 2025)
    return load(spark, sf_dir, "orders").select(long(n).alias("o_orderkey"), stamp(D.floor_minutes(ts, 10)).alias("planned"))


@query("json_props_extract", "SELECT CAST(event_id AS BIGINT) AS event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text FROM events")
def _(spark, sf_dir):
    as_map = F.from_json("props", "map<string,string>")
    return load(spark, sf_dir, "events").select(long(F.col("event_id")).alias("event_id"), as_map["k"].try_cast("bigint").alias("k"), F.get_json_object("props", "$.k").alias("k_text"))


@query(
    "engine_capacity",
    f"""WITH a AS (SELECT l_orderkey, l_partkey, list_reverse_sort([1000.0 + l_suppkey % 500, 1100.0 + l_partkey % 300, 900.0 + l_partkey % 700, 1055.0]) AS big FROM lineitem)
SELECT l_orderkey, l_partkey, {shown_sql('big[1]')} AS one, {shown_sql('big[1] + big[2]')} AS two, {shown_sql('list_sum(big)')} AS four FROM a""",
)
def _(spark, sf_dir):
    s = A.ships(spark, sf_dir)
    big = F.sort_array(F.array(*[F.col(f"aux_engine{i}_max_load") for i in (1, 2, 3, 4)]), asc=False)
    return s.select("l_orderkey", "l_partkey", shown(big[0]).alias("one"), shown(big[0] + big[1]).alias("two"), shown(F.aggregate(big, F.lit(0.0), lambda a, x: a + x)).alias("four"))


# -- mapping

CUSTOMER_MAPPING = Mapping(
    "AIR",
    [
        Field("operator_id", "string", ["crew_id", "cap_id"]),
        Field("customer_name", "string", ["name", "c_name"], regexp="^Customer#0000000[0-4]", default="other"),
        Field("balance", "number", ["c_acctbal"], regexp="^[0-9]", default=-1),
        Field("segment", "string", ["c_mktsegment"]),
        Field("active", "boolean", ["flag"]),
        Field("seen_at", "date", ["seen"]),
        Field("remarks", "string"),
        Field("load", "number", default=3),
    ],
)


@query(
    "apply_mapping",
    f"""SELECT regexp_replace(concat('00', CAST(c_custkey AS VARCHAR)), '^0+', '') AS operator_id, CASE WHEN regexp_matches(c_name, '^Customer#0000000[0-4]') THEN c_name ELSE 'other' END AS customer_name,
  {shown_sql("CASE WHEN c_acctbal >= 0 THEN c_acctbal ELSE -1 END")} AS balance, c_mktsegment AS segment, CAST(c_custkey % 2 AS INTEGER) AS active, '2024-05-01 10:00:00' AS seen_at,
  CAST(c_nationkey AS BIGINT) AS c_nationkey, 'Flight' AS event_id, 'AIR' AS dds_code, '2024-07-01' AS upload_date FROM customer""",
)
def _(spark, sf_dir):
    n = F.col("c_custkey")
    src = load(spark, sf_dir, "customer").select(
        F.concat(F.lit("00 "), n.cast("string"), F.lit(" ")).alias("cap_id"), "c_name", "c_mktsegment", F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("c_acctbal"),
        F.when(n % 2 == 1, F.lit("true")).otherwise(F.lit("false")).alias("flag"), F.lit("01/05/2024 10:00:00").alias("seen"), long(F.col("c_nationkey")).alias("c_nationkey"),
    )
    out = apply_mapping(src, CUSTOMER_MAPPING, "2024-07-01")
    return out.withColumns({"balance": shown(F.col("balance")), "active": F.col("active").cast("int")})


@query("ensure_fields", f"SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS remarks, {shown_sql('3')} AS load FROM customer")
def _(spark, sf_dir):
    src = load(spark, sf_dir, "customer").select(long(F.col("c_custkey")).alias("c_custkey"), F.col("c_mktsegment").alias("segment"))
    out = ensure_fields(src, CUSTOMER_MAPPING, only_optional=True)
    return out.withColumn("load", shown(F.col("load"))).select("c_custkey", "segment", "remarks", "load")


V2 = json.dumps(
    {"bronzeTables": {"orders": {"fieldMappings": [
        {"name": "event_key", "type": "string", "rawOptions": ["missing", "o_orderkey"], "outputSatellite": "SAT_Actual_Flight", "formula": "concat('E-', event_key)"},
        {"name": "operator_code", "type": "string", "rawOptions": ["o_custkey"], "outputSatellite": "SAT_CrewMember",
         "formula": "CASE WHEN operator_code RLIKE '^[0-9]+$' THEN regexp_replace(operator_code, '^0+', '') ELSE operator_code END"},
        {"name": "price", "type": "number", "rawOptions": ["o_totalprice"], "outputSatellite": "SAT_Actual_Flight", "formula": "price * 2"},
    ]}}}
)


@query(
    "apply_mapping_v2",
    f"SELECT concat('E-', CAST(o_orderkey AS VARCHAR)) AS event_key, regexp_replace(CAST(o_custkey AS VARCHAR), '^0+', '') AS operator_code, {shown_sql('o_totalprice * 2')} AS price FROM orders",
)
def _(spark, sf_dir):
    out = apply_expressions(load(spark, sf_dir, "orders"), Mapping.from_table_json(V2, "orders", "VS"))
    return out.withColumn("price", shown(F.col("price")))


@query(
    "apply_formulas",
    f"""WITH f AS ({A.FLIGHTS_SQL}) SELECT l_orderkey, l_partkey, {shown_sql('plnd_block_fuel * 1.005')} AS total_expected_fuel,
  {shown_sql("CASE WHEN vehicle = 'B787' THEN act_bloff_fuel * 0.454 ELSE act_bloff_fuel END")} AS fuel_burn_climb1_kg,
  {shown_sql('act_bloff_fuel - act_taxi_out_fuel')} AS act_takeoff_fuel, {shown_sql('act_bloff_fuel / 2 + act_taxi_in_fuel')} AS act_landing_fuel,
  {shown_sql('act_bloff_fuel - act_taxi_out_fuel - (act_bloff_fuel / 2 + act_taxi_in_fuel)')} AS act_trip_fuel,
  {shown_sql('greatest(fuel_burn_taxi_in1_kg, fuel_burn_taxi_in2_kg, fuel_burn_taxi_in3_kg, fuel_burn_taxi_in4_kg)')} AS fuel_burn_reti_main_engine,
  CASE WHEN vehicle LIKE 'B78%' THEN 'VS B787 Team' ELSE 'VSDefaultTeam' END AS team_name, CAST(dayofweek(ocurrence_datetime) AS BIGINT) AS weekday FROM f""",
)
def _(spark, sf_dir):
    f = A.flights(spark, sf_dir).withColumns({"act_blon_fuel": F.col("act_bloff_fuel") / 2, "fuel_burn_climb1": F.col("act_bloff_fuel")})
    names = ["act_trip_fuel", "total_expected_fuel", "fuel_burn_climb1_kg", "act_takeoff_fuel", "act_landing_fuel", "fuel_burn_reti_main_engine"]
    out = apply_formulas(f, [*names, "team_name", "weekday"], "aviation")
    return out.select("l_orderkey", "l_partkey", *[shown(F.col(n)).alias(n) for n in names], "team_name", long(F.col("weekday")).alias("weekday"))


_PHASES = ("climb", "cruise", "descent", "approach", "landing", "taxi_out", "take_off", "taxi_in")


def _burn_sql(phase: int, engine: int) -> str:
    return f"(q * {phase + 1} + {engine})"


def _kg_sql(expr: str) -> str:
    return f"(CASE WHEN vehicle = 'B787' THEN {expr} * 0.454 ELSE {expr} END)"


# line items as flights: every engine column, phase totals, taxi and flight times, vehicle, weight, id
@query(
    "formula_flight_events",
    f"""WITH f AS (SELECT *, concat('G-', l_suppkey % 4) AS reg, l_quantity AS q, l_orderkey % 30 AS roll, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS dep FROM lineitem),
v AS (SELECT *, CASE reg WHEN 'G-0' THEN 'B787' WHEN 'G-1' THEN 'B787' WHEN 'G-2' THEN 'A350' END AS vehicle FROM f)
SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_partkey AS BIGINT) AS l_partkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, vehicle,
  sha256(concat(length(reg), ':', reg, length(dep), ':', dep)) AS event_id, {shown_sql(_kg_sql('l_extendedprice'))} AS act_zero_fuel_weight_kg,
  {', '.join(f"{shown_sql(_kg_sql(_burn_sql(p, i)))} AS fuel_burn_{phase}{i}_kg" for p, phase in enumerate(_PHASES) for i in (1, 2, 3, 4))},
  {', '.join(f"{shown_sql(' + '.join(_kg_sql(_burn_sql(p, i)) for i in (1, 2, 3, 4)))} AS act_{phase}_fuel" for p, phase in enumerate(_PHASES[:4]))},
  {shown_sql(' + '.join(_kg_sql(_burn_sql(7, i)) for i in (1, 2, 3, 4)))} AS act_taxi_in_fuel,
  {shown_sql('CASE WHEN l_linenumber = 1 THEN 9 WHEN l_orderkey % 5 + l_orderkey % 3 > 0 THEN l_orderkey % 5 + l_orderkey % 3 ELSE 0 END')} AS planned_taxi_time,
  {shown_sql('CASE WHEN l_linenumber = 2 THEN 7 ELSE l_linenumber END')} AS taxi_in_minutes, {shown_sql('CASE WHEN roll > 0 THEN roll ELSE 11 END')} AS taxi_out_minutes,
  {shown_sql('CASE WHEN l_linenumber = 3 THEN q / 3600 ELSE q / 60 END')} AS plnd_flight_time_hs, {shown_sql('CASE WHEN l_linenumber = 4 THEN 5 * q / 60 ELSE q / 60 END')} AS actual_flight_time_hs FROM v""",
)
def _(spark, sf_dir):
    q, n, line, dep = F.col("l_quantity").cast("double"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_shipdate")
    later = lambda minutes: F.timestamp_seconds(F.unix_seconds(dep) + minutes * 60)
    src = load(spark, sf_dir, "lineitem").select(
        *[long(F.col(k)).alias(k) for k in ("l_orderkey", "l_partkey", "l_linenumber")],
        F.concat(F.lit("G-"), (F.col("l_suppkey") % 4).cast("string")).alias("aircraft_reg_code"), dep.alias("ocurrence_datetime"), F.col("l_extendedprice").alias("act_zero_fuel_weight"),
        *[(q * (p + 1) + i).alias(f"fuel_burn_{phase}{i}") for p, phase in enumerate(_PHASES) for i in (1, 2, 3, 4)],
        F.when(line == 1, 9).alias("planned_taxi_time"), (n % 5).alias("taxi_in_time_sched"), (n % 3).alias("taxi_out_time_sched"),
        F.when(line != 2, dep).alias("act_landing_time"), later(line).alias("act_blon_time"), F.lit(7.0).alias("taxi_in_minutes_measurement"),
        dep.alias("act_bloff_time"), later(n % 30).alias("act_takeoff_time"), F.lit(11.0).alias("taxi_out_minutes_measurement"),
        F.when(line != 3, q).alias("plnd_flight_time"), q.alias("plnd_flight_time_secs"), F.when(line != 4, q).alias("actual_flight_time"),
        *[q.alias(f"{part}_duration") for part in ("cruise", "approach", "landing", "toc", "tod")],
    )
    numbers = [f"fuel_burn_{phase}{i}_kg" for phase in _PHASES for i in (1, 2, 3, 4)] + [f"act_{phase}_fuel" for phase in _PHASES[:4]]
    numbers += ["act_taxi_in_fuel", "act_zero_fuel_weight_kg", "planned_taxi_time", "taxi_in_minutes", "taxi_out_minutes", "plnd_flight_time_hs", "actual_flight_time_hs"]
    fleet = {"vehicle": {"B787": ["G-0", "G-1"], "A350": ["G-2"]}}
    out = apply_formulas(src, [*numbers, "act_taxi_in_fuel_engines", "vehicle", "event_id"], "aviation", fleet)
    out = out.select("l_orderkey", "l_partkey", "l_linenumber", "vehicle", "event_id", *numbers)
    return with_columns(out, {c: shown(F.col(c)) for c in numbers}).select("l_orderkey", "l_partkey", "l_linenumber", "vehicle", "event_id", *numbers)


# orders as ship reports: id, identifier, hours, arrival, engine sums, constants by ship
@query(
    "formula_ship_reports",
    f"""WITH o AS (SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS d, concat('Ship ', o_custkey % 3) AS ship, CAST(o_custkey AS VARCHAR) AS imo FROM orders)
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, sha256(concat(length(imo), ':', imo, length(d), ':', d)) AS event_id, concat(imo, '-', d) AS identifier,
  {shown_sql('CASE WHEN o_orderkey % 4 = 0 THEN 24 ELSE o_orderkey % 40 END')} AS voyage_time_hs, concat(d, ' 0', o_orderkey % 10, ':30:00') AS arrival_datetime,
  {shown_sql('CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 7 ELSE o_orderkey % 7 + 2 END')} AS me_hours,
  CASE ship WHEN 'Ship 0' THEN 1.5 WHEN 'Ship 1' THEN 2.5 END AS constant_emo_delta_fuel FROM o""",
)
def _(spark, sf_dir):
    n, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    src = load(spark, sf_dir, "orders").select(
        long(n).alias("o_orderkey"), F.col("o_custkey").cast("string").alias("imo"), day.alias("report_date_utc"), F.concat(F.lit("0"), (n % 10).cast("string"), F.lit(":30")).alias("report_time_utc"),
        F.when(n % 4 == 0, F.lit("n/a")).otherwise((n % 40).cast("string")).alias("log_duration"), (n % 7).cast("string").alias("me1_running_hours"),
        F.when(n % 3 == 0, F.lit("?")).otherwise("2").alias("me2_running_hours"), F.concat(F.lit("SHIP "), (F.col("o_custkey") % 3).cast("string")).alias("vehicle"),
    )
    out = apply_formulas(src, ["event_id", "identifier", "voyage_time_hs", "arrival_datetime", "me_hours", "constant_emo_delta_fuel"], "sea", {"constant_emo_delta_fuel": {"Ship 0": 1.5, "ship 1": 2.5}})
    return out.select(
        "o_orderkey", "event_id", "identifier", shown(F.col("voyage_time_hs")).alias("voyage_time_hs"), stamp(F.col("arrival_datetime")).alias("arrival_datetime"),
        shown(F.col("me_hours")).alias("me_hours"), F.col("constant_emo_delta_fuel").cast("double").alias("constant_emo_delta_fuel"),
    )


# -- ledger (orders as files: key = path, status = state, priority = format, date = modification time)


def ledger(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "F", F.lit("ingested")).when(F.col("o_orderstatus") == "P", F.lit("pending")).otherwise(F.lit("glacier_file"))
    return load(spark, sf_dir, "orders").select(
        F.concat(F.lit("f"), F.col("o_custkey").cast("string")).alias("filename"), F.col("o_orderkey").cast("string").alias("filepath"),
        F.substring("o_orderpriority", 1, 1).alias("format"), status.alias("status"), F.lit(None).cast("string").alias("etag"),
        F.col("o_orderdate").alias("last_modified"), long(F.col("o_totalprice")).alias("size"),
    )


_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'ingested' WHEN 'P' THEN 'pending' ELSE 'glacier_file' END"


@query("ledger_pending", f"SELECT CAST(o_orderkey AS VARCHAR) AS filepath, {_STATUS} AS status FROM orders WHERE substr(o_orderpriority, 1, 1) = '2' AND {_STATUS} NOT IN ('ingested', 'glacier_file') AND o_orderdate > TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1999-01-01' AND regexp_matches(concat('f', o_custkey), '^f[1-7]')")
def _(spark, sf_dir):
    return L.pending_files(ledger(spark, sf_dir), "2", "1996-01-01", "1999-01-01", "^f[1-7]").select("filepath", "status")


@query("ledger_watermark", f"SELECT {stamp_sql('max(o_orderdate)')} AS newest, {stamp_sql('min(o_orderdate)')} AS oldest, CAST(count(*) AS BIGINT) AS files, {stamp_sql("date_trunc('minute', max(o_orderdate))")} AS start_from FROM orders WHERE substr(o_orderpriority, 1, 1) = '3'")
def _(spark, sf_dir):
    out = G.watermark(ledger(spark, sf_dir), "3")
    return out.select(stamp(F.col("newest")).alias("newest"), stamp(F.col("oldest")).alias("oldest"), "files", stamp(F.col("start_from")).alias("start_from"))


@query("ledger_status_update", f"SELECT CAST(o_orderkey AS VARCHAR) AS filepath, CASE WHEN o_orderkey % 7 = 0 THEN 'ingested' WHEN o_orderkey % 7 = 1 THEN 'could not read' ELSE {_STATUS} END AS status FROM orders")
def _(spark, sf_dir):
    led = ledger(spark, sf_dir)
    n = F.col("filepath").cast("bigint") % 7
    changes = led.filter(n < 2).select("filepath", F.when(n == 0, F.lit("ingested")).otherwise(F.lit("could not read")).alias("status"))
    return L.update_status(led, changes).select("filepath", "status")


@query("status_counts", f"SELECT {_STATUS} AS status, CAST(count(*) AS BIGINT) AS files FROM orders GROUP BY 1")
def _(spark, sf_dir):
    return L.status_counts(ledger(spark, sf_dir))


@query("file_listing_filter", "SELECT CAST(page_id AS BIGINT) AS page_id, CAST(length(html) AS BIGINT) AS size FROM pages WHERE regexp_matches(url, '/(en|fr)/\\d+') AND length(html) >= 500")
def _(spark, sf_dir):
    pages = load(spark, sf_dir, "pages")
    listing = pages.select("page_id", F.col("url").alias("filename"), long(F.length("html")).alias("size"), F.lit("2024-01-02").cast("timestamp").alias("last_modified"))
    out = L.select_files(listing, r"/(en|fr)/\d+", 500, "2024-01-01", "2024-01-03")
    return out.select(long(F.col("page_id")).alias("page_id"), "size")


_UPSERT_SQL = f"""SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'U' ELSE o_orderstatus END AS o_orderstatus, {shown_sql('CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice + 1 ELSE o_totalprice END')} AS price, CASE WHEN o_orderkey % 10 = 0 THEN 'new' END AS note FROM orders
UNION ALL SELECT CAST(o_orderkey + 100000000 AS BIGINT), 'U', {shown_sql('o_totalprice + 1')}, 'new' FROM orders WHERE o_orderkey % 10 = 5 UNION ALL SELECT NULL, 'N', 2.5, 'new'"""


@query("upsert_orders", _UPSERT_SQL)
def _(spark, sf_dir):
    target, updates = _orders_and_updates(spark, sf_dir)
    return merged(target, updates, ["o_orderkey"]).withColumn("price", shown(F.col("price")))


@query("upsert_touched", _UPSERT_SQL)
def _(spark, sf_dir):
    """The same through a keyed table: a first write with every row twice, then the updates, which rewrite what they touch."""
    target, updates = _orders_and_updates(spark, sf_dir)
    path = f"{scratch_dir(spark)}/orders-{uuid.uuid4().hex}"
    keyed.upsert(target.unionByName(target.withColumn("price", F.col("price") + 7)), path, ["o_orderkey"])
    keyed.upsert(updates, path, ["o_orderkey"])
    return keyed.read(spark, path).withColumn("price", shown(F.col("price")))


def _orders_and_updates(spark, sf_dir):
    base = load(spark, sf_dir, "orders").select(long(F.col("o_orderkey")).alias("o_orderkey"), "o_orderstatus", F.col("o_totalprice").alias("price"))
    n = F.col("o_orderkey")
    moved = F.when(n % 10 == 5, n + 100_000_000).otherwise(n).alias("o_orderkey")
    updates = base.filter(n % 5 == 0).select(moved, F.lit("U").alias("o_orderstatus"), (F.col("price") + 1).alias("price"), F.lit("new").alias("note"))
    # every update comes twice, the second time dearer; one row of either side has no key
    nobody = base.limit(1).select(F.lit(None).cast("bigint").alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), F.lit(1.5).alias("price"))
    updates = updates.unionByName(updates.withColumn("price", F.col("price") + 7)).unionByName(nobody.withColumn("price", F.lit(2.5)).withColumn("note", F.lit("new")))
    return base.unionByName(nobody), updates


@query("snapshot_limit", "SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderstatus FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 10")
def _(spark, sf_dir):
    out = snapshot(spark, f"{sf_dir}/orders.parquet", 10, [F.desc("o_orderdate"), "o_orderkey"])
    return out.select(long(F.col("o_orderkey")).alias("o_orderkey"), "o_orderstatus")


# -- unions, pivots, splits


@query("union_missing_columns", f"SELECT c_name AS name, {shown_sql('c_acctbal')} AS balance, c_mktsegment AS segment, CAST(NULL AS BIGINT) AS supplier FROM customer UNION ALL SELECT s_name, {shown_sql('s_acctbal')}, NULL, CAST(s_suppkey AS BIGINT) FROM supplier")
def _(spark, sf_dir):
    a = load(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), shown(F.col("c_acctbal")).alias("balance"), F.col("c_mktsegment").alias("segment"))
    b = load(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), shown(F.col("s_acctbal")).alias("balance"), long(F.col("s_suppkey")).alias("supplier"))
    return P.union_by_name([a, b], ordered=True)


@query("union_passthrough", f"SELECT CAST(c_custkey AS BIGINT) AS id, {shown_sql('c_acctbal')} AS saved, CAST(1 AS BIGINT) AS hours FROM customer UNION ALL SELECT CAST(s_suppkey AS BIGINT), 0.0, CAST(0 AS BIGINT) FROM supplier")
def _(spark, sf_dir):
    a = load(spark, sf_dir, "customer").select(long(F.col("c_custkey")).alias("id"), shown(F.col("c_acctbal")).alias("saved"), long(F.lit(1)).alias("hours"))
    b = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    return P.union_with_defaults(a, b, {"saved": 0.0, "hours": 0})


_TYPES = ["click", "error", "purchase", "signup", "view"]


def _pivot_cells(agg: str, name: str) -> str:
    return ", ".join(f"{agg.format(t=t)} AS {name.format(t=t)}" for t in _TYPES)


@query(
    "pivot_fuel",
    f"""SELECT CAST(user_id AS BIGINT) AS ship, {day_sql('CAST(ts AS DATE)')} AS report_date, {shown_sql('sum(value / 3)')} AS total_generator, {shown_sql('sum(value)')} AS total_propulsion,
  {', '.join(f"{shown_sql(f"sum(value) FILTER (WHERE event_type = '{t}')")} AS {t}_propulsion, {shown_sql(f"sum(value / 3) FILTER (WHERE event_type = '{t}')")} AS {t}_generator" for t in _TYPES)}
FROM events WHERE user_id <> 7 GROUP BY user_id, CAST(ts AS DATE)""",
)
def _(spark, sf_dir):
    src = load(spark, sf_dir, "events").select(F.col("user_id").alias("ship"), "ts", F.col("event_type").alias("fuel_type"), F.col("value").alias("propulsion"), (F.col("value") / 3).alias("generator"))
    out = fuel_by_type(src, _TYPES, left_out=[7])
    return out.select(
        long(F.col("ship")).alias("ship"), day_text(F.col("report_date")).alias("report_date"), shown(F.col("TotalGeneratorConsumptionNEW")).alias("total_generator"),
        shown(F.col("TotalPropulsionConsumptionNEW")).alias("total_propulsion"),
        *[shown(F.col(f"{t}_{k}Consumption")).alias(f"{t}_{k.lower()}") for t in _TYPES for k in ("Propulsion", "Generator")],
    )


_HOURS = list(range(0, 24, 6))


def _picked(spark, sf_dir):
    src = load(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("d"), (F.floor(F.hour("ts") / 6) * 6).alias("h"), "value", "event_type", "ts", "event_id")
    return G.pivot_pick(src, ["user_id", "d"], "h", _HOURS, {"value": "value", "kind": "event_type"}, ["ts", "event_id"])


@query(
    "pivot_multi_agg",
    f"""SELECT CAST(user_id AS BIGINT) AS ship, {day_sql('CAST(ts AS DATE)')} AS day, {', '.join(
        f"{shown_sql(f'arg_min(value, (ts, event_id)) FILTER (WHERE hour(ts) // 6 * 6 = {h})')} AS value_{h}, arg_min(event_type, (ts, event_id)) FILTER (WHERE hour(ts) // 6 * 6 = {h}) AS kind_{h}" for h in _HOURS)}
FROM events GROUP BY user_id, CAST(ts AS DATE)""",
)
def _(spark, sf_dir):
    return _picked(spark, sf_dir).select(
        long(F.col("user_id")).alias("ship"), day_text(F.col("d")).alias("day"),
        *[c for h in _HOURS for c in (shown(F.col(f"value_{h}")).alias(f"value_{h}"), F.col(f"kind_{h}"))],
    )


@query("pivot_drop_suffix", f"SELECT CAST(user_id AS BIGINT) AS ship, {day_sql('CAST(ts AS DATE)')} AS day, CAST(count(DISTINCT hour(ts) // 6) AS BIGINT) AS total_hours FROM events GROUP BY user_id, CAST(ts AS DATE)")
def _(spark, sf_dir):
    wide = _picked(spark, sf_dir).withColumn("total_hours", sum((F.col(f"kind_{h}").isNotNull().cast("bigint") for h in _HOURS), F.lit(0)))
    out = P.without_suffix(wide, r"_\d+")
    return out.select(long(F.col("user_id")).alias("ship"), day_text(F.col("d")).alias("day"), long(F.col("total_hours")).alias("total_hours"))


@query("regex_selected_max", f"SELECT l_returnflag AS \"SOURCE_FILE_NAME\", {shown_sql('max(l_quantity)')} AS \"UTC_HOUR_1\", {shown_sql('max(l_tax)')} AS \"GMT_MIN\", {shown_sql('max(l_discount)')} AS \"DAY\" FROM lineitem GROUP BY 1")
def _(spark, sf_dir):
    src = load(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("source_file_name"), shown(F.col("l_quantity")).alias("utc_hour_1"), shown(F.col("l_tax")).alias("gmt_min"), shown(F.col("l_discount")).alias("Day"), F.col("l_extendedprice").alias("altitude")
    )
    return G.recorder_start(src, "source_file_name")


@query(
    "quarantine_split",
    """WITH b AS (SELECT DISTINCT source FROM documents WHERE doc_id % 97 = 0) SELECT CAST(doc_id AS BIGINT) AS doc_id, source, CAST(source IN (SELECT source FROM b) AS INTEGER) AS quarantined FROM documents""",
)
def _(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select(long(F.col("doc_id")).alias("doc_id"), "source")
    clean, corrupt = Fi.quarantine_split(docs, F.col("doc_id") % 97 == 0, "source")
    return clean.withColumn("quarantined", F.lit(0)).unionByName(corrupt.withColumn("quarantined", F.lit(1)))
