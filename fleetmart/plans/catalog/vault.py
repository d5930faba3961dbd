"""Hub, link and satellite projections and the one-big-table (event = order)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetmart.operators import vault as V
from fleetmart.operators.joins import hashed
from fleetmart.plans import layouts
from fleetmart.plans.catalog.base import load, long, query, shown, shown_sql, stamp, stamp_sql

LAYOUT = {
    "HUB_Flight": ["event_id", "ocurrence_datetime", "absent_column"],
    "HUB_Crew_Member": ["operator_id", "ocurrence_datetime"],
    "LINK_Flight_Crew": ["event_id", "operator_id", "customer_code"],
    "SAT_Flight_Planned": ["event_id", "ORIGIN", "plnd_block_fuel"],
    "SAT_Flight_Actual": ["event_id", "line", "act_trip_fuel"],
}

_MERGED_SQL = """m AS (SELECT CAST(o_orderkey AS BIGINT) AS event_id, CAST(o_custkey AS BIGINT) AS operator_id, o_orderstatus AS customer_code, o_orderdate AS ocurrence_datetime,
  o_orderpriority AS origin, l_extendedprice / 7 AS plnd_block_fuel, CAST(l_linenumber AS BIGINT) AS line, l_quantity / 3 AS act_trip_fuel FROM orders JOIN lineitem ON l_orderkey = o_orderkey)"""


def merged(spark, sf_dir):
    o, li = load(spark, sf_dir, "orders"), load(spark, sf_dir, "lineitem")
    j = li.join(hashed(o), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(
        long(F.col("o_orderkey")).alias("event_id"), long(F.col("o_custkey")).alias("operator_id"), F.col("o_orderstatus").alias("customer_code"),
        F.col("o_orderdate").alias("ocurrence_datetime"), F.col("o_orderpriority").alias("origin"), (F.col("l_extendedprice") / 7).alias("plnd_block_fuel"),
        long(F.col("l_linenumber")).alias("line"), (F.col("l_quantity") / 3).alias("act_trip_fuel"),
    )


def vault(spark, sf_dir):
    return V.tables(merged(spark, sf_dir), LAYOUT, {"LINK_Flight_Crew": ["event_id", "operator_id"]})


@query("vault_hub", f"WITH {_MERGED_SQL} SELECT operator_id, {stamp_sql('min(ocurrence_datetime)')} AS ocurrence_datetime FROM m GROUP BY operator_id")
def _(spark, sf_dir):
    return vault(spark, sf_dir)["HUB_Crew_Member"].select("operator_id", stamp(F.col("ocurrence_datetime")).alias("ocurrence_datetime"))


# the shipped layout with its declared keys; every order is an event with several crew members
@query(
    "vault_link",
    """SELECT CAST(l_orderkey AS BIGINT) AS hk_ship_day_id, CAST(l_suppkey AS BIGINT) AS hk_operator_id, strftime(min(l_shipdate), '%Y-%m-%d') AS load_date, 'lines' AS record_source
FROM lineitem GROUP BY l_orderkey, l_suppkey""",
)
def _(spark, sf_dir):
    events = load(spark, sf_dir, "lineitem").select(
        long(F.col("l_orderkey")).alias("hk_ship_day_id"), long(F.col("l_suppkey")).alias("HK_operator_id"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("load_date"), F.lit("lines").alias("record_source")
    )
    return V.tables(events, layouts.TANKER)["LINK_Ship_Daily_Crew"]


@query("vault_sat", f'WITH {_MERGED_SQL} SELECT event_id, origin AS "ORIGIN", {shown_sql("plnd_block_fuel")} AS plnd_block_fuel FROM m')
def _(spark, sf_dir):
    return vault(spark, sf_dir)["SAT_Flight_Planned"].withColumn("plnd_block_fuel", shown(F.col("plnd_block_fuel")))


# hubs of urgent orders only, satellites of all
_HUB_SQL = f"{_MERGED_SQL}, h AS (SELECT DISTINCT event_id, operator_id FROM m WHERE origin = '1-URGENT')"


def urgent(spark, sf_dir):
    o = load(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return o.select(long(F.col("o_orderkey")).alias("event_id"), long(F.col("o_custkey")).alias("operator_id"))


@query("vault_semi_join", f"WITH {_MERGED_SQL} SELECT event_id, line, {shown_sql('act_trip_fuel')} AS act_trip_fuel FROM m WHERE event_id IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def _(spark, sf_dir):
    out = V.of_keys(vault(spark, sf_dir)["SAT_Flight_Actual"], urgent(spark, sf_dir), "event_id")
    return out.withColumn("act_trip_fuel", shown(F.col("act_trip_fuel")))


@query(
    "vault_union",
    f"""WITH {_HUB_SQL} SELECT event_id, origin AS "ORIGIN", {shown_sql('plnd_block_fuel')} AS plnd_block_fuel, CAST(NULL AS BIGINT) AS line, CAST(NULL AS DOUBLE) AS act_trip_fuel, 'planned' AS satellite FROM m WHERE event_id IN (SELECT event_id FROM h)
UNION ALL SELECT event_id, NULL, NULL, line, {shown_sql('act_trip_fuel')}, 'actual' FROM m WHERE event_id IN (SELECT event_id FROM h)""",
)
def _(spark, sf_dir):
    v = vault(spark, sf_dir)
    out = V.stacked({"planned": v["SAT_Flight_Planned"], "actual": v["SAT_Flight_Actual"]}, urgent(spark, sf_dir), "event_id")
    return out.withColumns({c: F.when(F.col(c).isNotNull(), shown(F.col(c))) for c in ("plnd_block_fuel", "act_trip_fuel")})


# the first satellite has several rows for a key: the last by line number counts
_SATS_SQL = """p AS (SELECT CAST(l_orderkey AS BIGINT) AS event_id, arg_max(l_quantity, (l_linenumber, l_quantity)) AS quantity FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1),
a AS (SELECT CAST(l_orderkey AS BIGINT) AS event_id, max(l_extendedprice) AS top_price, count(*) AS lines FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)"""


def satellites(spark, sf_dir):
    li, key = load(spark, sf_dir, "lineitem"), long(F.col("l_orderkey")).alias("event_id")
    return {
        "planned": li.filter("l_linestatus = 'O'").select(key, F.col("l_quantity").alias("quantity"), "l_linenumber"),
        "actual": li.filter("l_returnflag = 'R'").groupBy(key).agg(F.max("l_extendedprice").alias("top_price"), F.count(F.lit(1)).alias("lines")),
    }


def _out(df, *extra):
    return df.select("event_id", *extra, shown(F.col("quantity")).alias("quantity"), shown(F.col("top_price")).alias("top_price"), "lines")


_OBT_COLS = f"{shown_sql('quantity')} AS quantity, {shown_sql('top_price')} AS top_price, CAST(lines AS BIGINT) AS lines"


@query("obt_hub", f"WITH {_SATS_SQL} SELECT CAST(o_orderkey AS BIGINT) AS event_id, CAST(o_custkey AS BIGINT) AS operator_id, {_OBT_COLS} FROM orders LEFT JOIN p ON p.event_id = o_orderkey LEFT JOIN a ON a.event_id = o_orderkey WHERE o_orderpriority = '1-URGENT'")
def _(spark, sf_dir):
    return _out(V.one_big_table(urgent(spark, sf_dir), satellites(spark, sf_dir), "event_id", {"planned": ["l_linenumber"]}), "operator_id")


@query(
    "obt_link",
    f"WITH {_SATS_SQL} SELECT CAST(o_orderkey AS BIGINT) AS event_id, CAST(o_custkey AS BIGINT) AS operator_id, o_orderstatus AS customer_code, {_OBT_COLS} FROM orders LEFT JOIN p ON p.event_id = o_orderkey LEFT JOIN a ON a.event_id = o_orderkey",
)
def _(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    link = o.select(long(F.col("o_orderkey")).alias("event_id"), long(F.col("o_custkey")).alias("operator_id"))
    hubs = {"HUB_Flight": o.select(long(F.col("o_orderkey")).alias("event_id"), F.col("o_orderstatus").alias("customer_code"))}
    return _out(V.obt_of_link(link, hubs, satellites(spark, sf_dir), "event_id", {"planned": ["l_linenumber"]}), "operator_id", "customer_code")
