"""Driver tables read as flight events and ship reports: pure projections, once for Spark and once as SQL.

Divisors are odd on purpose, so that results are never exact decimal ties.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from fleetmart.plans.catalog.base import load

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
BLACKOUT = ("1997-03-17", "1998-09-05")  # the pandemic window moved to where the test dates are

# One text for both engines: only expressions that mean the same in Spark SQL and DuckDB.
_LINE_COLUMNS = {
    "flights": {
        "vehicle": "CASE l_returnflag WHEN 'A' THEN 'A339' WHEN 'N' THEN 'B787' ELSE 'B744' END",
        "ocurrence_datetime": "l_shipdate",
        "origin": "concat('P', CAST(l_suppkey % 40 AS STRING))",
        "destination": "concat('P', CAST(l_partkey % 40 AS STRING))",
        "planned_taxi_time": "CASE WHEN l_linenumber % 3 = 0 THEN l_quantity * 0.7 ELSE 45.5 END",
        "taxi_in_minutes": "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END",
        "taxi_out_minutes": "51.5 - l_quantity",
        "plnd_taxi_fuel": "l_extendedprice / 710.0",
        "fuel_burn_taxi_in1_kg": "l_extendedprice / 970.0",
        "fuel_burn_taxi_in2_kg": "l_extendedprice / 970.0 * (1 - 5 * l_discount)",
        "fuel_burn_taxi_in3_kg": "CASE WHEN l_linenumber >= 5 THEN l_extendedprice / 970.0 * (1 - 5 * l_tax) ELSE 0.0 END",
        "fuel_burn_taxi_in4_kg": "0.0",
        "fuel_burn_taxi_out1_kg": "l_extendedprice / 1130.0 * (1 - 4 * l_tax)",
        "fuel_burn_taxi_out2_kg": "CASE WHEN l_linenumber = 2 THEN NULL ELSE l_extendedprice / 1130.0 END",
        "fuel_burn_taxi_out3_kg": "0.0",
        "fuel_burn_taxi_out4_kg": "CASE WHEN l_linenumber >= 6 THEN l_extendedprice / 1370.0 ELSE 0.0 END",
        "act_taxi_in_fuel": "l_extendedprice / 970.0 * (1 + l_discount * 4 - l_tax)",
        "act_taxi_out_fuel": "l_extendedprice / 1130.0 * (1 + l_tax * 4 - l_discount)",
        "planned_fuel_burn_adjustment": "70.3 + l_suppkey % 60",
        "plnd_trip_fuel": "l_extendedprice / 7.0",
        "act_trip_fuel": "l_extendedprice / 7.0 * (0.85 + 5 * l_tax)",
        "plnd_takeoff_weight": "60000.0 + (l_partkey % 1000) * 7",
        "loadsheet_tow": "CASE WHEN l_linenumber = 6 THEN 0.0 ELSE 60000.0 + (l_partkey % 1000) * 7 + (l_quantity - 25) * 91 END",
        "plnd_flight_time_hs": "CASE WHEN l_linenumber = 5 THEN NULL ELSE l_quantity / 5.0 END",
        "actual_flight_time_hs": "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity / 5.0 * (0.9 + 2 * l_discount) END",
        "plnd_airborne_time": "l_quantity / 4.7",
        "airborne_time": "l_quantity / 4.9",
        "plnd_zero_fuel_weight": "CASE WHEN l_linenumber = 1 AND l_quantity < 5 THEN 0.0 ELSE 50000.0 + l_partkey % 5000 END",
        "loadsheet_zfw": "50000.0 + l_partkey % 5000 + (l_quantity - 25) * 41",
        "plnd_block_fuel": "l_extendedprice / 9.1",
        "act_bloff_fuel": "l_extendedprice / 9.1 * (0.75 + 5 * l_discount)",
        "plnd_target_fuel": "l_extendedprice / 47.3",
        "act_landing_fuel": "l_extendedprice / 47.3 * (0.8 + 5 * l_tax)",
        "planned_arrival_delay_fuel": "l_quantity * 3.1",
        "plnd_contingency_fuel": "l_quantity * 2.3",
        "plnd_tanker_fuel": "CASE WHEN l_linenumber = 4 THEN l_suppkey % 3 ELSE 0 END",
    },
    "ships": {
        "imo": "CAST(9100000 + l_suppkey AS STRING)",
        "location": "CASE WHEN l_linenumber % 4 = 0 THEN 'In Port' ELSE 'At SEA' END",
        "operational_mode": "CASE WHEN l_linenumber % 5 = 0 THEN 'InPortMoored' ELSE 'AtSeaUnderwayUsingEngine' END",
        "manoeuvring_hours": "l_tax * 60.5",
        "voyage_time_hs": "l_quantity",
        "log_duration": "l_quantity / 1.3",
        "me_foc": "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice / 1300.0 END",
        "dfoc": "CASE WHEN l_quantity > 49 THEN 200.0 ELSE (l_discount * 100 - 4.1) * (l_quantity / 7) END",
        "me_sfoc": "CASE WHEN l_linenumber = 6 AND l_quantity < 9 THEN NULL ELSE l_extendedprice / 331.0 END",
        "me_hours": "CASE WHEN l_quantity > 45 THEN 33.0 ELSE 20 + l_quantity / 4.5 END",
        "me_power": "3000.0 + l_partkey % 7300",
        "me_cons": "l_quantity - 3",
        "delta_sfoc": "CASE WHEN l_linenumber = 3 AND l_quantity > 40 THEN 120.0 ELSE (l_discount * 100 - 3.3) * 1.7 END",
        "speed_bosp": "l_quantity / 2.9",
        "wind_speed_bf": "l_tax * 100",
        "trim": "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_discount * 13 - 0.61 END",
        "load": "CASE WHEN l_linestatus = 'O' THEN 'B' ELSE 'L' END",
        "emo_threshold": "150.5 + l_suppkey % 50",
        "aeu": "CASE WHEN l_linenumber = 5 THEN 0.0 ELSE 55.0 + l_quantity END",
        "sfocisoae": "l_extendedprice / 257.0",
        "constant_aeu_lower": "60.0 + l_suppkey % 30",
        "constant_aeu_upper": "95.0",
        "ae1_running_hours": "l_quantity / 2.1",
        "ae2_running_hours": "CASE WHEN l_linenumber >= 3 THEN l_quantity / 2.7 ELSE 0.0 END",
        "ae3_running_hours": "CASE WHEN l_linenumber >= 5 THEN l_quantity / 3.3 ELSE 0.0 END",
        "ae4_running_hours": "CASE WHEN l_linenumber >= 7 THEN l_quantity / 4.1 ELSE 0.0 END",
        "ae1_electric_power_kw": "l_extendedprice / 61.0",
        "ae2_electric_power_kw": "l_extendedprice / 73.0",
        "ae3_electric_power_kw": "l_extendedprice / 87.0",
        "ae4_electric_power_kw": "l_extendedprice / 97.0",
        "aux_engine1_max_load": "1000.0 + l_suppkey % 500",
        "aux_engine2_max_load": "1100.0 + l_partkey % 300",
        "aux_engine3_max_load": "900.0 + l_partkey % 700",
        "aux_engine4_max_load": "1055.0",
        "aux_engine1_const": "0.8",
        "aux_engine2_const": "0.81",
        "aux_engine3_const": "0.79",
        "aux_engine4_const": "0.8",
        "emo_sfoc": "l_extendedprice / 331.0",
        "total_propulsion_consumption_new": "l_quantity * 2.1",
        "total_generator_consumption_new": "l_discount * 900",
        "meandraft": "l_linenumber + l_tax * 7",
        "beaufort": "CASE WHEN l_linenumber = 2 THEN 7 ELSE 3 END",
        "tank_cleaning_consumption_mgo": "CASE WHEN l_quantity = 44 THEN 1.5 ELSE 0.0 END",
    },
}


def _doubles(text: str) -> str:
    """Decimal literals written as doubles, so that both engines calculate in doubles throughout."""
    return re.sub(r"\b(\d+\.\d+)\b", r"\1E0", text)


for _columns in _LINE_COLUMNS.values():
    _columns.update({n: _doubles(e) for n, e in _columns.items()})


def _sql(kind: str) -> str:
    cols = ",\n  ".join(f"{e} AS {n}" for n, e in _LINE_COLUMNS[kind].items())
    return f"SELECT {', '.join(LINE_KEY)},\n  {cols}\nFROM lineitem"


FLIGHTS_SQL = _sql("flights")
SHIPS_SQL = _sql("ships")


# events as ship reports
_REPORT_COLUMNS = {
    "event_id": "event_id",
    "imo": "user_id",
    "date": "ts",
    "value": "value",
    "eventTypesString": "CASE event_type WHEN 'signup' THEN 'Noon At Sea' WHEN 'purchase' THEN 'Departure In Port' "
    "WHEN 'click' THEN 'AtSeaDrifting' WHEN 'view' THEN 'EOSP' ELSE 'On Hire (In Port)' END",
    "operationalMode": "CASE WHEN event_id % 4 = 0 THEN 'Manoeuvring' WHEN event_id % 4 = 1 THEN 'InPortMoored' ELSE 'AtSeaUnderwayUsingEngine' END",
    "time": "value / 13.0",
    "meHours": "value / 17.0",
    "meHours1": "value / 19.0",
    "speedBosp": "value / 23.0",
    "windSpeedBf": "value / 29.0",
    "aeCons": "value / 31.0",
    "aeEnergyProd": "CASE WHEN event_id % 6 = 0 THEN 0.0 ELSE value * 3 END",
    "meCons": "value / 37.0",
    "meEnergyProd": "value * 5",
    "position": "CASE WHEN event_id % 3 = 0 THEN concat('Dep. PORT', CAST(user_id AS STRING), 'X PORT') "
    "WHEN event_id % 3 = 1 THEN 'EOSP somewhere' ELSE NULL END",
    "prevPortUnLocode": "concat('A', CAST(event_id % 9 AS STRING))",
    "nextPortUnLocode": "concat('B', CAST(event_id % 7 AS STRING))",
}
_REPORT_COLUMNS = {n: _doubles(e) for n, e in _REPORT_COLUMNS.items()}
REPORTS_SQL = "SELECT " + ",\n  ".join(f"{e} AS {n}" for n, e in _REPORT_COLUMNS.items()) + "\nFROM events"


def flights(spark, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, "flights")


def ships(spark, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, "ships")


def _lines(spark, sf_dir: str, kind: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").selectExpr(*LINE_KEY, *[f"{e} AS {n}" for n, e in _LINE_COLUMNS[kind].items()])


def reports(spark, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").selectExpr(*[f"{e} AS {n}" for n, e in _REPORT_COLUMNS.items()])
