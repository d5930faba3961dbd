"""Behaviour calculators on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.operators import behaviours as B
from fleetmart.operators.joins import config_frame, lookup
from fleetmart.plans.catalog import adapters as A
from fleetmart.plans.catalog.base import long, query, shown, shown_sql

KEY = ", ".join(A.LINE_KEY)
# Thresholds per vehicle, attached by one size-checked lookup.
VEHICLE_CONSTANTS = {
    "a339": {"constant_reti_cooldown_time": 3.0, "constant_reti_threshold": 0.2, "constant_reto_warmup_time": 2.0, "constant_reto_threshold": 0.15},
    "b787": {"constant_reti_cooldown_time": 2.5, "constant_reti_threshold": 0.25, "constant_reto_warmup_time": 3.5, "constant_reto_threshold": 0.1},
    "b744": {"constant_reti_cooldown_time": 4.0, "constant_reti_threshold": 0.3, "constant_reto_warmup_time": 4.0, "constant_reto_threshold": 0.2},
}


def with_constants(df: DataFrame) -> DataFrame:
    names = list(next(iter(VEHICLE_CONSTANTS.values())))
    dim = config_frame(df.sparkSession, VEHICLE_CONSTANTS, "ship", "ship string, " + ", ".join(f"{n} double" for n in names))
    return lookup(df, dim, F.col("vehicle"), "ship", config=True)


def result(df: DataFrame, prefix: str, side: dict[str, str] | None = None) -> DataFrame:
    """Row identity, the behaviour's figures, and the side columns of ``side`` (its values are for the SQL form)."""
    p = prefix
    return df.select(
        *[long(F.col(k)).alias(k) for k in A.LINE_KEY],
        shown(F.col(f"{p}__net_savings")).alias("net_savings"),
        F.col(f"{p}__success").cast("int").alias("success"),
        shown(F.col(f"{p}__savings")).alias("savings"),
        shown(F.col(f"{p}__best_case_savings")).alias("best_case_savings"),
        F.col(f"{p}__reason").alias("reason"),
        *[F.when(F.col(c).isNotNull(), shown(F.col(c))).alias(c) for c in side or {}],
    )


def result_sql(ctes: str, reasons: list[tuple[str, str]], net: str, ok: str, savings: str = "net", best: str = "savings", net_if_eligible: bool = False, side: dict[str, str] | None = None) -> str:
    """SQL frame: ``ctes`` ends with a CTE named x that holds the inputs of all expressions."""
    cases = " ".join(f"WHEN {c} THEN '{r}'" for r, c in reasons)
    reason = f"CASE {cases} ELSE '' END" if cases else "''"
    n = f"CASE WHEN reason = '' THEN ({net}) ELSE 0 END" if net_if_eligible else f"({net})"
    return f"""WITH {ctes},
r0 AS (SELECT x.*, {reason} AS reason FROM x),
r1 AS (SELECT r0.*, {n} AS net, coalesce(reason = '' AND ({ok}), FALSE) AS ok FROM r0),
r2 AS (SELECT r1.*, CASE WHEN ok THEN coalesce({savings}, 0) ELSE 0 END AS savings FROM r1)
SELECT {', '.join(f'CAST({k} AS BIGINT) AS {k}' for k in A.LINE_KEY)}, {shown_sql('net')} AS net_savings, CAST(ok AS INTEGER) AS success,
  {shown_sql('savings')} AS savings, {shown_sql(f'coalesce({best}, 0)')} AS best_case_savings, reason{''.join(f", CASE WHEN ({x}) IS NOT NULL THEN {shown_sql(x)} END AS {c}" for c, x in (side or {}).items())}
FROM r2"""


FLIGHT_REASONS = [
    ("NOT_POSSIBLE__COVID_PERIOD", f"ocurrence_datetime >= TIMESTAMP '{A.BLACKOUT[0]}' AND ocurrence_datetime <= TIMESTAMP '{A.BLACKOUT[1]}'"),
    ("NOT_POSSIBLE__4_ENGINE_VEHICLE", "regexp_matches(vehicle, 'B74|A34')"),
]


def _constant_sql(name: str) -> str:
    return "CASE vehicle " + " ".join(f"WHEN '{v.upper()}' THEN {c[name]}" for v, c in VEHICLE_CONSTANTS.items()) + " END"


def _taxi_ctes(way: str, wait: str, margin: str) -> str:
    fill = (lambda c: c) if way == "in" else (lambda c: f"coalesce({c}, 0)")
    return f"""f AS ({A.FLIGHTS_SQL}),
a AS (SELECT f.*, {fill(f'taxi_{way}_minutes')} AS mins, {fill(f'act_taxi_{way}_fuel')} AS fuel, {fill('plnd_taxi_fuel')} AS plan,
  {_constant_sql(wait)} AS wait, {_constant_sql(margin)} AS margin,
  {', '.join(f'coalesce(fuel_burn_taxi_{way}{i}_kg, 0.0) AS b{i}' for i in (1, 2, 3, 4))} FROM f),
b AS (SELECT a.*, CASE WHEN b3 + b4 > 0 THEN 2 ELSE 1 END AS pairs,
  CASE WHEN mins > 0 THEN greatest(b1, b2, b3, b4) / mins ELSE 0 END * wait AS idle FROM a),
e AS (SELECT b.*, {', '.join(f'CASE WHEN b{i} > idle THEN b{i} - idle ELSE 0.0 END AS e{i}' for i in (1, 2, 3, 4))} FROM b),
m AS (SELECT e.*, greatest(e1, e2, e3, e4) AS mx FROM e),
x AS (SELECT m.*, mx * (1 - margin) AS lim FROM m)"""


def _taxi_reasons(wait_reason: str) -> list[tuple[str, str]]:
    return FLIGHT_REASONS + [
        ("FAULTY_DATA__INVALID_TAXI_FUEL", "fuel <= 0"),
        (f"NOT_POSSIBLE__{wait_reason}", "mins < wait"),
        ("NOT_POSSIBLE__TAXI_OVER_LIMIT", "mins > 180 OR (planned_taxi_time > 0 AND mins > planned_taxi_time * 1.2)"),
        ("FAULTY_DATA__OUTLIER_VALUES", "plan > 0 AND (fuel < plan * 0.1 OR fuel > plan * 1.2)"),
    ]


IN_MISSING = [("FAULTY_DATA__MISSING_REQUIRED_VALUES", "mins IS NULL OR fuel IS NULL")]
_SAVED = " + ".join(
    f"CASE WHEN {'' if i < 3 else f'e{i} > 0 AND '}e{i} <= lim THEN mx - e{i} ELSE 0 END" for i in (1, 2, 3, 4)
)
RETI_SIDE = {f"fuel_burn_reti_{i}_without_cooldown": f"e{i}" for i in (1, 2, 3, 4)} | {"fuel_burn_reti_main_engine": "mx"}
RETO_SIDE = {f"fuel_burn_reto_{i}_without_warmup": f"e{i}" for i in (1, 2, 3, 4)} | {"fuel_burn_reto_main_engine": "mx"}
RETI_SQL = result_sql(
    _taxi_ctes("in", "constant_reti_cooldown_time", "constant_reti_threshold"), IN_MISSING + _taxi_reasons("UNDER_MIN_COOLDOWN"), _SAVED,
    f"lim > 0 AND ({_SAVED}) > 0", "round(net, 2)", "round(mx * pairs, 2)", side=RETI_SIDE,
)


def reti_events(spark, sf_dir: str) -> DataFrame:
    df = with_constants(A.flights(spark, sf_dir)).withColumn("fuel_burn_reti_main_engine", F.col("fuel_burn_taxi_in1_kg"))
    return B.calculate(df, "Reduced_Engine_Taxi_In", blackout=A.BLACKOUT)


@query("behaviour_reti", RETI_SQL)
def _(spark, sf_dir):
    return result(reti_events(spark, sf_dir), "reti", RETI_SIDE)


@query(
    "reti_savings_by_reason",
    f"""SELECT reason, CAST(count(*) AS BIGINT) AS events, CAST(sum(success) AS BIGINT) AS successes, {shown_sql('sum(savings)', 2)} AS savings,
    {shown_sql('sum(best_case_savings)', 2)} AS best_case_savings FROM ({RETI_SQL}) GROUP BY reason""",
)
def savings_by_reason(spark, sf_dir):
    """Flagship: lookup join, reason chain, savings arithmetic and aggregation."""
    per_event = result(reti_events(spark, sf_dir), "reti")
    return per_event.groupBy("reason").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("success").alias("successes"),
        shown(F.sum("savings"), 2).alias("savings"),
        shown(F.sum("best_case_savings"), 2).alias("best_case_savings"),
    )


@query(
    "behaviour_reto",
    result_sql(
        _taxi_ctes("out", "constant_reto_warmup_time", "constant_reto_threshold"), _taxi_reasons("UNDER_MIN_WARMUP"),
        "mx * 2 - e1 - e2", "lim > 0 AND (mx * 2 - e1 - e2) > 0", best="mx * pairs", side=RETO_SIDE,
    ),
)
def _(spark, sf_dir):
    df = with_constants(A.flights(spark, sf_dir)).withColumn("fuel_burn_reto_main_engine", F.col("fuel_burn_taxi_out1_kg"))
    return result(B.calculate(df, "Reduced_Engine_Taxi_Out", blackout=A.BLACKOUT), "reto", RETO_SIDE)


@query(
    "behaviour_ef",
    result_sql(
        f"""f AS ({A.FLIGHTS_SQL}),
a AS (SELECT f.*, coalesce(act_taxi_out_fuel, 0) + coalesce(act_taxi_in_fuel, 0) AS taxi_fuel,
  coalesce(taxi_in_minutes, 0) + coalesce(taxi_out_minutes, 0) AS taxi_min,
  (loadsheet_tow - plnd_takeoff_weight) / 1000 * planned_fuel_burn_adjustment AS per_ton FROM f),
x AS (SELECT a.*, floor(CASE WHEN plnd_taxi_fuel > 0 AND (taxi_fuel < plnd_taxi_fuel * 0.2 OR taxi_min < planned_taxi_time * 0.2)
    THEN act_trip_fuel - plnd_taxi_fuel ELSE act_trip_fuel END / 100) * 100 AS actual,
  ceil((plnd_trip_fuel + per_ton + per_ton / 1000 * planned_fuel_burn_adjustment) / 100) * 100 + 50 AS expected,
  coalesce(plnd_flight_time_hs, plnd_airborne_time) * 60 AS planned_min, coalesce(actual_flight_time_hs, airborne_time) * 60 AS flown_min FROM a)""",
        FLIGHT_REASONS + [
            ("FAULTY_DATA__INVALID_TOW", "loadsheet_tow <= 0"),
            ("NOT_POSSIBLE__INVALID_LEG", "origin = destination"),
            ("FAULTY_DATA__OUTLIER_VALUES", "actual < expected * 0.8 OR actual > expected * 1.1"),
            ("NOT_POSSIBLE__DELAYED_FLIGHT", "flown_min > 0 AND planned_min > 0 AND flown_min > planned_min + 20"),
        ],
        "expected - actual", "expected > 0 AND actual < expected", best="greatest(savings, expected * 0.05)",
    ),
)
def _(spark, sf_dir):
    return result(B.calculate(A.flights(spark, sf_dir), "Efficient_Flight", blackout=A.BLACKOUT), "ef")


@query(
    "behaviour_odfl",
    result_sql(
        f"""f AS ({A.FLIGHTS_SQL}),
a AS (SELECT f.*, planned_fuel_burn_adjustment AS k, 300.0 AS buffer,
  CASE WHEN loadsheet_zfw = 0 OR plnd_zero_fuel_weight = 0 THEN 0 ELSE loadsheet_zfw - plnd_zero_fuel_weight END AS zd FROM f),
b AS (SELECT a.*, plnd_block_fuel + CASE WHEN zd > 0 THEN zd * k / 1000 + zd * k / 1000 * k / 1000 ELSE zd * k / 1000 END AS ramp FROM a),
c AS (SELECT b.*, act_bloff_fuel - ramp AS loaded FROM b),
d AS (SELECT c.*, -(act_landing_fuel - (plnd_target_fuel + loaded - loaded * k / 1000) + planned_arrival_delay_fuel + plnd_contingency_fuel) AS needed FROM c),
x AS (SELECT d.*, greatest(needed, 0) AS pos, buffer * (k / 1000) AS most FROM d)""",
        FLIGHT_REASONS + [
            ("FAULTY_DATA__INVALID_FUEL_TANK", "act_bloff_fuel <= 0"),
            ("NOT_POSSIBLE__TANKERED_FLIGHT", "plnd_tanker_fuel > 0"),
            ("FAULTY_DATA__OUTLIER_VALUES", "act_bloff_fuel < ramp * 0.8 OR act_bloff_fuel > ramp * 1.2"),
            ("NOT_POSSIBLE__DISCRETIONARY_FUEL_REQUIRED", "needed > loaded"),
        ],
        "least((pos - loaded + buffer) * (k / 10), most)", "loaded <= pos + buffer", best="most",
    ),
)
def _(spark, sf_dir):
    df = A.flights(spark, sf_dir).withColumn("constant_df_buffer", F.lit(300.0))
    return result(B.calculate(df, "Optimal_Discretionary_Fuel_Load", blackout=A.BLACKOUT), "odfl")


def _missing(*cols: str) -> tuple[str, str]:
    return "FAULTY_DATA__MISSING_REQUIRED_VALUES", " OR ".join(f"{c} IS NULL" for c in cols)


NOT_SEA = ("NOT_POSSIBLE__NOT_AT_SEA", "NOT regexp_matches(location, '(?i)sea')")


@query(
    "behaviour_sailing",
    result_sql(
        f"""s AS ({A.SHIPS_SQL}),
a AS (SELECT s.*, 5.0 + l_suppkey % 10 AS allowed, me_foc * 1000 AS used FROM s),
b AS (SELECT a.*, used / nullif(1 + dfoc / 100, 0) AS ideal FROM a),
x AS (SELECT b.*, ideal * (1 + allowed / 100) AS expected FROM b)""",
        [
            NOT_SEA, _missing("location", "me_foc", "dfoc", "voyage_time_hs"),
            ("NOT_POSSIBLE__VOYAGE_TOO_SHORT", "voyage_time_hs < 20"),
            ("FAULTY_DATA__OUTLIER_VALUES", "expected > 100000 OR me_foc <= 5"),
            ("FAULTY_DATA__INVALID_DFOC", "dfoc >= 150 OR dfoc < -75"),
        ],
        "expected - used", "expected - used > 0 AND dfoc < allowed",
        best="CASE WHEN expected - least(used, ideal) > 0 THEN expected - least(used, ideal) ELSE 0 END",
    ),
)
def _(spark, sf_dir):
    df = A.ships(spark, sf_dir).withColumn("constant_delta_fuel_consumption", 5.0 + F.col("l_suppkey") % 10)
    return result(B.calculate(df, "Optimal_Sailing"), "optimal_sailing")


@query(
    "behaviour_emo_delta",
    result_sql(
        f"""s AS ({A.SHIPS_SQL}),
x AS (SELECT s.*, me_power * me_hours AS kwh, me_sfoc / nullif(1 + delta_sfoc / 100, 0) * (1 + 4.0 / 100) AS lim FROM s)""",
        [
            NOT_SEA, _missing("location", "me_sfoc", "me_hours", "me_power", "delta_sfoc", "voyage_time_hs"),
            ("NOT_POSSIBLE__VOYAGE_TOO_SHORT", "voyage_time_hs < 6"),
            ("FAULTY_DATA__INVALID_RUNNING_HOURS", "me_hours < 20 OR me_hours > 30"),
            ("FAULTY_DATA__INVALID_KWHRS", "me_power > 10000"),
            ("FAULTY_DATA__INVALID_SFOC", "me_sfoc < 100 OR me_sfoc > 400"),
            ("FAULTY_DATA__INVALID_DELTA_SFOC", "delta_sfoc > 99 OR delta_sfoc < -99"),
            ("FAULTY_DATA__OUTLIER_VALUES", "me_power > 300000"),
        ],
        "lim * kwh / 1000 - me_sfoc * kwh / 1000", "me_sfoc <= lim", "CASE WHEN net > 0 THEN net ELSE 0 END", net_if_eligible=True,
    ),
)
def _(spark, sf_dir):
    df = A.ships(spark, sf_dir).withColumn("constant_emo_delta_fuel", F.lit(4.0))
    return result(B.calculate(df, "Engine_Maintenance_Optimisation"), "emo")


def _charter_reasons(needs: tuple[str, ...], tail: list[tuple[str, str]]) -> list[tuple[str, str]]:
    return [
        ("NOT_POSSIBLE__NOT_AT_SEA", "operational_mode = 'InPortMoored'"),
        ("NOT_POSSIBLE__MANOEUVRE_TIME_OVER_LIMIT", "manoeuvring_hours > 4"),
        _missing(*needs), *tail,
    ]


@query(
    "behaviour_emo_threshold",
    result_sql(
        f"""s AS ({A.SHIPS_SQL}),
a AS (SELECT s.*, round(coalesce(me_sfoc, 0), 0) AS sf, me_power * me_hours AS kwh FROM s),
x AS (SELECT a.*, kwh * sf AS used, kwh * emo_threshold AS allowed FROM a)""",
        _charter_reasons(
            ("me_cons", "operational_mode", "me_hours", "speed_bosp", "wind_speed_bf", "me_sfoc", "me_power"),
            [
                ("FAULTY_DATA__INVALID_FUEL_REPORT", "NOT (sf > 100 AND sf < 300)"),
                ("FAULTY_DATA__INVALID_RUNNING_HOURS", "me_hours < 20 OR me_hours > 30"),
                ("NOT_POSSIBLE__SPEED_UNDER_MIN", "speed_bosp < 7"),
                ("NOT_POSSIBLE__BAD_WEATHER", "wind_speed_bf >= 5"),
            ],
        ),
        "(allowed - used) / 1000", "used <= allowed",
    ),
)
def _(spark, sf_dir):
    return result(B.calculate(A.ships(spark, sf_dir), "Engine_Maintenance_Optimisation_Threshold"), "emo")


@query(
    "behaviour_trim_even_keel",
    result_sql(
        f"s AS ({A.SHIPS_SQL}), x AS (SELECT s.*, coalesce(trim, -2) AS tr FROM s)",
        _charter_reasons(
            ("me_cons", "me_hours", "speed_bosp", "wind_speed_bf", "trim", "load"),
            [
                ("NOT_POSSIBLE__TRIM_NOT_ACHIEVABLE_WHEN_BALLAST", "load = 'B'"),
                ("FAULTY_DATA__INVALID_FUEL_REPORT", "me_cons <= 0"),
                ("FAULTY_DATA__INVALID_RUNNING_HOURS", "me_hours < 20 OR me_hours > 30"),
                ("NOT_POSSIBLE__SPEED_UNDER_MIN", "speed_bosp < 7"),
                ("NOT_POSSIBLE__BAD_WEATHER", "wind_speed_bf >= 5"),
            ],
        ),
        "(6.3 - abs(tr) * 12.6) * me_hours", "tr BETWEEN -0.25 AND 0.5",
    ),
)
def _(spark, sf_dir):
    return result(B.calculate(A.ships(spark, sf_dir), "Efficient_Trim"), "et")


def _use_sql(n: int, hours: list[str], powers: list[str], loads: list[str], consts: list[str], duration: str, demand: str, extra: str = "") -> str:
    """CTE texts for demand, share and the full-use flag of n engines."""
    denom = " + ".join(f"{c} * ({c} * {m}) * {h}" for c, m, h in zip(consts, loads, hours))
    count = " + ".join(f"CASE WHEN {h} > 0 THEN 1 ELSE 0 END" for h in hours)
    caps = ", ".join(f"({' + '.join(f'big[{j}]' for j in range(1, k + 1))}) * {consts[0]} * ({duration} + 1) AS cap{k}" for k in range(1, n + 1))
    fits = " OR ".join(
        f"(cnt = {k} AND demand <= cap{k}" + (f" AND demand > cap{k - 1}" if k > 1 else "") + ")" for k in range(1, n + 1)
    )
    return f"""a AS (SELECT s.*, {demand} AS demand, ({' + '.join(hours)}) AS ran, ({count}) AS cnt, list_reverse_sort([{', '.join(loads)}]) AS big FROM s),
b AS (SELECT a.*, demand / nullif({denom}, 0) AS share, {caps} FROM a),
c AS (SELECT b.*, ({fits}) OR share >= 1{extra} AS fully FROM b)"""


def _names(pattern: str, n: int) -> list[str]:
    return [pattern.replace("#", str(i)) for i in range(1, n + 1)]


_H4, _P4, _L4, _C4 = (_names(p, 4) for p in ("ae#_running_hours", "ae#_electric_power_kw", "aux_engine#_max_load", "aux_engine#_const"))


@query(
    "behaviour_eaeu4",
    result_sql(
        f"s AS ({A.SHIPS_SQL}),\n"
        + _use_sql(4, _H4, _P4, _L4, _C4, "log_duration", " + ".join(f"{p} * {h} / 0.96" for p, h in zip(_P4, _H4)), " OR ran <= log_duration")
        + ",\nx AS (SELECT c.*, CASE WHEN fully THEN 100 ELSE share * 100 END AS use_pct FROM c)",
        [
            _missing("location", "aeu", "sfocisoae", "log_duration"),
            ("NOT_POSSIBLE__VOYAGE_TOO_SHORT", "log_duration < 20"),
            ("NOT_POSSIBLE__EAEU_OVER_THRESHOLD", "aeu > 100"),
            ("FAULTY_DATA__EAEU_NOT_USED", "aeu = 0 OR ran <= 0"),
            ("FAULTY_DATA__INVALID_SFOC", "sfocisoae < 100 OR sfocisoae > 400"),
        ],
        "(use_pct - constant_aeu_lower) / 100 * sfocisoae * demand / 1000", "use_pct >= constant_aeu_lower", "round(net, 2)", side={"aeu_calc": "use_pct"},
    ),
)
def _(spark, sf_dir):
    return result(B.calculate(A.ships(spark, sf_dir), "Efficient_Auxiliary_Engine_Use"), "eaeu", {"aeu_calc": ""})


@query(
    "behaviour_eaeu3",
    result_sql(
        f"s AS ({A.SHIPS_SQL}),\n"
        + _use_sql(3, _H4[:3], _P4[:3], _L4[:3], _C4[:3], "voyage_time_hs", " + ".join(f"{p} * {h} / 0.96" for p, h in zip(_P4[:3], _H4[:3])))
        + ",\nx AS (SELECT c.*, coalesce(CASE WHEN fully THEN 100 ELSE share * 100 END, 100) AS use_pct FROM c)",
        [
            ("NOT_POSSIBLE__MANOEUVRE_TIME_OVER_LIMIT", "manoeuvring_hours > 4"),
            _missing("operational_mode", "me_hours", "me_cons"),
            ("FAULTY_DATA__INVALID_SFOC", "NOT (sfocisoae > 100 AND sfocisoae < 400)"),
            ("FAULTY_DATA__INVALID_RUNNING_HOURS", "ran < 0"),
            ("FAULTY_DATA__INVALID_AUX_ENGINES_CONSUMPTION", "me_cons < 0"),
        ],
        "(use_pct - constant_aeu_lower) / 100 * sfocisoae * demand / 1000", "use_pct >= constant_aeu_lower", side={"aeu_calc": "use_pct"},
    ),
)
def _(spark, sf_dir):
    named = {f"ae_hours{i}": F.col(_H4[i - 1]) for i in (1, 2, 3)} | {f"ae_power{i}": F.col(_P4[i - 1]) for i in (1, 2, 3)}
    named |= {f"aux_engine{i}_mcr_const": F.col(_C4[i - 1]) for i in (1, 2, 3)}
    named |= {"ae_sfoc": F.col("sfocisoae"), "ae_cons": F.col("me_cons"), "aeu_lower_threshold": F.col("constant_aeu_lower")}
    return result(B.calculate(A.ships(spark, sf_dir).withColumns(named), "Efficient_Auxiliary_Engine_Use_Charter"), "eaeu", {"aeu_calc": ""})


@query(
    "behaviour_eaeu_ratio",
    result_sql(
        f"s AS ({A.SHIPS_SQL}),\n"
        + _use_sql(
            4, _H4, _P4, _L4, ["0.8"] * 4, "24.0",
            "(" + " + ".join(f"({m} * 0.8) * ({p} / {m}) * {h}" for m, p, h in zip(_L4, _P4, _H4)) + ") / 0.96",
        )
        + f",\nx AS (SELECT c.*, CASE WHEN fully THEN 1 ELSE share END AS use_part, constant_aeu_lower / 100 AS lower_part,"
        + f" ({' + '.join(f'sfocisoae * {p} * {h}' for p, h in zip(_P4, _H4))}) / 1000 AS fuel_kg FROM c)",
        [], "(use_part - lower_part) * fuel_kg", "use_part >= lower_part", best="CASE WHEN ok THEN (1 - lower_part) * fuel_kg ELSE 0 END", side={"aeu_calc": "use_part"},
    ),
)
def _(spark, sf_dir):
    named = {f"generator_energy_hourly_avg_{i}": F.col(_P4[i - 1]) for i in (1, 2, 3, 4)}
    named |= {f"generator_{i}_running_hours": F.col(_H4[i - 1]) for i in (1, 2, 3, 4)}
    named |= {f"aux_engine{i}_min_load": F.lit(100.0) for i in (1, 2, 3, 4)}
    named |= {
        "speedthroughwatermehrs": F.col("speed_bosp"), "observeddistance": F.lit(10.0), "constant_eaeu_eta": F.lit(0.96),
        "constant_eaeu_const": F.lit(0.8), "aeu_lower_threshold": F.col("constant_aeu_lower") / 100, "aux_engines_sfoc": F.col("sfocisoae"),
    }
    return result(B.calculate(A.ships(spark, sf_dir).withColumns(named), "Efficient_Auxiliary_Engine_Use_Tanker"), "eaeu", {"aeu_calc": ""})


# Reason chain, exclusions and qualification

EXCLUSIONS = [{"field_name": "vehicle", "values": ["A339"]}, {"field_name": "destination", "values": ["P3", "P17"]}]
EXCLUDED = [
    ("NOT_POSSIBLE__FILTERED_SETTINGS__VEHICLE", "vehicle IN ('A339')"),
    ("NOT_POSSIBLE__FILTERED_SETTINGS__DESTINATION", "destination IN ('P3', 'P17')"),
]


@query(
    "reason_chain",
    f"SELECT reason, CAST(count(*) AS BIGINT) AS events FROM ({RETI_SQL}) GROUP BY reason",
)
def _(spark, sf_dir):
    return reti_events(spark, sf_dir).groupBy(F.col("reti__reason").alias("reason")).agg(F.count(F.lit(1)).alias("events"))


_FILTERED_SQL = result_sql(
    _taxi_ctes("in", "constant_reti_cooldown_time", "constant_reti_threshold"), EXCLUDED + IN_MISSING + _taxi_reasons("UNDER_MIN_COOLDOWN"),
    _SAVED, f"lim > 0 AND ({_SAVED}) > 0", "round(net, 2)",
    "CASE WHEN reason LIKE 'NOT_POSSIBLE__FILTERED_SETTINGS%' THEN 0 ELSE round(mx * pairs, 2) END",
)


@query(
    "filter_exclusions",
    f"""SELECT reason, CAST(count(*) AS BIGINT) AS events, CAST(sum(success) AS BIGINT) AS successes,
    {shown_sql('sum(best_case_savings)', 2)} AS best_case_savings FROM ({_FILTERED_SQL}) GROUP BY reason""",
)
def _(spark, sf_dir):
    df = with_constants(A.flights(spark, sf_dir)).withColumn("fuel_burn_reti_main_engine", F.col("fuel_burn_taxi_in1_kg"))
    out = B.calculate(df, "Reduced_Engine_Taxi_In", exclusions=EXCLUSIONS, blackout=A.BLACKOUT)
    return out.groupBy(F.col("reti__reason").alias("reason")).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.col("reti__success").cast("int")).alias("successes"),
        shown(F.sum("reti__best_case_savings"), 2).alias("best_case_savings"),
    )


@query(
    "qualified_flag",
    f"""WITH a AS ({RETI_SQL}) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(reason = '' AS INTEGER) AS qualified FROM a""",
)
def _(spark, sf_dir):
    out = reti_events(spark, sf_dir).withColumn("qualified", B.qualified(["reti"]))
    return out.select(*[long(F.col(k)).alias(k) for k in A.LINE_KEY], F.col("qualified").cast("int").alias("qualified"))


@query(
    "qualified_counts",
    f"""WITH a AS ({RETI_SQL}) SELECT l_linenumber, CAST(count(*) AS BIGINT) AS events,
    CAST(count(*) FILTER (WHERE reason <> '') AS BIGINT) AS non_qualified FROM a GROUP BY l_linenumber""",
)
def _(spark, sf_dir):
    out = reti_events(spark, sf_dir).withColumn("qualified", B.qualified(["reti"]))
    return out.groupBy(long(F.col("l_linenumber")).alias("l_linenumber")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(~F.col("qualified")).alias("non_qualified")
    )
