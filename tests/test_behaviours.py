"""Each calculator on hand-made rows: every reason in its place, a success, NULL inputs, absent columns."""

import itertools

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from fleetmart.operators import behaviours as B
from fleetmart.operators.behaviours.core import BEHAVIOURS, Outcome
from fleetmart.operators.behaviours.maritime import full_use

RETI = dict(
    plnd_taxi_fuel=100.0, taxi_in_minutes=10.0, fuel_burn_taxi_in1_kg=60.0, fuel_burn_taxi_in2_kg=30.0, fuel_burn_reti_main_engine=60.0,
    act_taxi_in_fuel=90.0, constant_reti_cooldown_time=3.0, constant_reti_threshold=0.2, ocurrence_datetime="2023-01-01 00:00:00", vehicle="A339", planned_taxi_time=20.0,
)
SAILING = dict(location="At Sea", me_foc=10.0, dfoc=2.0, voyage_time_hs=24.0, constant_delta_fuel_consumption=5.0)
EMO = dict(location="sea passage", me_sfoc=180.0, me_hours=24.0, me_power=5000.0, delta_sfoc=2.0, voyage_time_hs=24.0, constant_emo_delta_fuel=5.0)
EMO_T = dict(me_cons=10.0, operational_mode="x", me_hours=24.0, speed_bosp=12.0, wind_speed_bf=3.0, me_sfoc=150.0, me_power=1000.0, emo_threshold=160.0, manoeuvring_hours=0.0)
EMO_C = dict(
    imo="1", steaming_hours=24.0, mainenginerunninghrs=24.0, main_engine_kwhrs=5000.0, emo_delta_fuel=10.0, speedthroughwatermehrs=12.0, observeddistance=300.0,
    emo_sfoc=180.0, sfoc_min=170.0, total_propulsion_consumption_new=20.0, total_generator_consumption_new=3.0,
)
ET = dict(me_cons=5.0, me_hours=24.0, speed_bosp=12.0, wind_speed_bf=2.0, trim=0.1, load="L", operational_mode="x", manoeuvring_hours=1.0)
TRIM = dict(
    imo="1", speedthroughwatermehrs=14.0, observeddistance=300.0, trim=0.5, meandraft=9.0, trim_perc_actual=2.0, trim_perc_limit=5.0, total_propulsion_consumption_new=20.0,
    beaufort=3.0, tank_cleaning_consumption_ifo=0.0,
)
EPM = dict(epm_success=1, epm_fuel_saved=5.0, epm_best_fuel_saved=9.0, total_hours=20, overproduced_hours=2)

CASES = [
    ("Reduced_Engine_Taxi_In", "reti", RETI, {}, ""),
    ("Reduced_Engine_Taxi_In", "reti", RETI, {"ocurrence_datetime": "2020-06-01 00:00:00", "vehicle": "B744"}, "NOT_POSSIBLE__COVID_PERIOD"),
    ("Reduced_Engine_Taxi_In", "reti", RETI, {"vehicle": "A346"}, "NOT_POSSIBLE__4_ENGINE_VEHICLE"),
    ("Reduced_Engine_Taxi_In", "reti", RETI, {"act_taxi_in_fuel": 0.0}, "FAULTY_DATA__INVALID_TAXI_FUEL"),
    ("Reduced_Engine_Taxi_In", "reti", RETI, {"taxi_in_minutes": 2.0}, "NOT_POSSIBLE__UNDER_MIN_COOLDOWN"),
    ("Reduced_Engine_Taxi_In", "reti", RETI, {"taxi_in_minutes": 25.0}, "NOT_POSSIBLE__TAXI_OVER_LIMIT"),
    ("Reduced_Engine_Taxi_In", "reti", RETI, {"act_taxi_in_fuel": 130.0}, "FAULTY_DATA__OUTLIER_VALUES"),
    ("Reduced_Engine_Taxi_In", "reti", RETI, {"taxi_in_minutes": float("nan")}, "FAULTY_DATA__MISSING_REQUIRED_VALUES"),
    ("Optimal_Sailing", "optimal_sailing", SAILING, {}, ""),
    ("Optimal_Sailing", "optimal_sailing", SAILING, {"location": "Port", "me_foc": None}, "NOT_POSSIBLE__NOT_AT_SEA"),
    ("Optimal_Sailing", "optimal_sailing", SAILING, {"me_foc": None}, "FAULTY_DATA__MISSING_REQUIRED_VALUES"),
    ("Optimal_Sailing", "optimal_sailing", SAILING, {"voyage_time_hs": 19.0}, "NOT_POSSIBLE__VOYAGE_TOO_SHORT"),
    ("Optimal_Sailing", "optimal_sailing", SAILING, {"me_foc": 5.0}, "FAULTY_DATA__OUTLIER_VALUES"),
    ("Optimal_Sailing", "optimal_sailing", SAILING, {"dfoc": 150.0}, "FAULTY_DATA__INVALID_DFOC"),
    ("Engine_Maintenance_Optimisation", "emo", EMO, {}, ""),
    ("Engine_Maintenance_Optimisation", "emo", EMO, {"voyage_time_hs": 5.0}, "NOT_POSSIBLE__VOYAGE_TOO_SHORT"),
    ("Engine_Maintenance_Optimisation", "emo", EMO, {"me_hours": 31.0}, "FAULTY_DATA__INVALID_RUNNING_HOURS"),
    ("Engine_Maintenance_Optimisation", "emo", EMO, {"me_power": 10001.0}, "FAULTY_DATA__INVALID_KWHRS"),
    ("Engine_Maintenance_Optimisation", "emo", EMO, {"me_sfoc": 99.0}, "FAULTY_DATA__INVALID_SFOC"),
    ("Engine_Maintenance_Optimisation", "emo", EMO, {"delta_sfoc": -100.0}, "FAULTY_DATA__INVALID_DELTA_SFOC"),
    ("Engine_Maintenance_Optimisation_Threshold", "emo", EMO_T, {}, ""),
    ("Engine_Maintenance_Optimisation_Threshold", "emo", EMO_T, {"operational_mode": "InPortMoored"}, "NOT_POSSIBLE__NOT_AT_SEA"),
    ("Engine_Maintenance_Optimisation_Threshold", "emo", EMO_T, {"manoeuvring_hours": 5.0}, "NOT_POSSIBLE__MANOEUVRE_TIME_OVER_LIMIT"),
    ("Engine_Maintenance_Optimisation_Threshold", "emo", EMO_T, {"me_sfoc": 300.0}, "FAULTY_DATA__INVALID_FUEL_REPORT"),
    ("Engine_Maintenance_Optimisation_Threshold", "emo", EMO_T, {"speed_bosp": 6.0}, "NOT_POSSIBLE__SPEED_UNDER_MIN"),
    ("Engine_Maintenance_Optimisation_Threshold", "emo", EMO_T, {"wind_speed_bf": 5.0}, "NOT_POSSIBLE__BAD_WEATHER"),
    ("Engine_Maintenance_Optimisation_Curve", "emo", EMO_C, {}, ""),
    ("Engine_Maintenance_Optimisation_Curve", "emo", EMO_C, {"observeddistance": 0.0}, "NOT_POSSIBLE__NOT_AT_SEA"),
    ("Engine_Maintenance_Optimisation_Curve", "emo", EMO_C, {"emo_sfoc": 49.0}, "FAULTY_DATA__INVALID_SFOC"),
    ("Engine_Maintenance_Optimisation_Curve", "emo", EMO_C, {"total_propulsion_consumption_new": 101.0}, "FAULTY_DATA__INVALID_PROPULSION_CONSUMPTION"),
    ("Engine_Maintenance_Optimisation_Curve", "emo", EMO_C, {"total_generator_consumption_new": 0.0}, "FAULTY_DATA__INVALID_GENERATOR_CONSUMPTION"),
    ("Engine_Maintenance_Optimisation_Curve", "emo", EMO_C, {"sfoc_min": None}, "FAULTY_DATA__SFOC_NOT_AVAILABLE"),
    ("Engine_Maintenance_Optimisation_Curve", "emo", EMO_C, {"sfoc_min": 80.0}, "FAULTY_DATA__INVALID_DELTA_SFOC"),
    ("Efficient_Trim", "et", ET, {}, ""),
    ("Efficient_Trim", "et", ET, {"trim": None}, "FAULTY_DATA__MISSING_REQUIRED_VALUES"),
    ("Efficient_Trim", "et", ET, {"load": "B"}, "NOT_POSSIBLE__TRIM_NOT_ACHIEVABLE_WHEN_BALLAST"),
    ("Efficient_Trim", "et", ET, {"me_cons": 0.0}, "FAULTY_DATA__INVALID_FUEL_REPORT"),
    ("Optimal_Trim", "optimal_trim", TRIM, {}, ""),
    ("Optimal_Trim", "optimal_trim", TRIM, {"trim_perc_limit": None}, "NOT_POSSIBLE__TRIM_NOT_AVAILABLE"),
    ("Optimal_Trim", "optimal_trim", TRIM, {"speedthroughwatermehrs": 10.0}, "NOT_POSSIBLE__SPEED_UNDER_MIN"),
    ("Optimal_Trim", "optimal_trim", TRIM, {"speedthroughwatermehrs": 21.0}, "FAULTY_DATA__INVALID_SPEED"),
    ("Optimal_Trim", "optimal_trim", TRIM, {"meandraft": 21.0}, "FAULTY_DATA__INVALID_MEAN_DRAFT"),
    ("Optimal_Trim", "optimal_trim", TRIM, {"tank_cleaning_consumption_ifo": 1.0}, "NOT_POSSIBLE__TANK_CLEANING"),
    ("Optimal_Trim", "optimal_trim", TRIM, {"beaufort": 6.0}, "NOT_POSSIBLE__BAD_WEATHER"),
    ("Optimal_Trim", "optimal_trim", TRIM, {"trim_perc_actual": None}, "NOT_POSSIBLE__TRIM_OUT_OF_LIMITS"),
    ("Efficient_Power_Management", "epm", EPM, {}, ""),
    ("Efficient_Power_Management", "epm", EPM, {"total_hours": 3}, "NOT_POSSIBLE__VOYAGE_TOO_SHORT"),
    ("Efficient_Power_Management", "epm", EPM, {"total_hours": 31}, "FAULTY_DATA__INVALID_RUNNING_HOURS"),
]


def frame(spark, records):
    kinds = {k: next((type(r[k]) for r in records if r[k] is not None), float) for k in records[0]}
    ddl = ", ".join(f"{k} {'string' if t is str else 'bigint' if t is int else 'double'}" for k, t in kinds.items())
    df = spark.createDataFrame([tuple(r[k] for k in kinds) for r in records], ddl)
    return df.withColumn("ocurrence_datetime", F.col("ocurrence_datetime").cast("timestamp")) if "ocurrence_datetime" in kinds else df


@pytest.mark.parametrize("name", sorted({c[0] for c in CASES}))
def test_reasons_and_success(spark, name):
    cases = [c for c in CASES if c[0] == name]
    prefix = cases[0][1]
    df = frame(spark, [{**c[2], **c[3], "case_no": i} for i, c in enumerate(cases)])
    got = {r["case_no"]: r for r in B.calculate(df, name).collect()}
    for i, c in enumerate(cases):
        r = got[i]
        assert r[f"{prefix}__reason"] == c[4]
        assert r[f"{prefix}__success"] == (c[4] == "")
        assert (r[f"{prefix}__savings"] > 0) == (c[4] == "")
    assert set(r.asDict()) >= {f"{prefix}__{k}" for k in ("net_savings", "best_case_savings")}


def test_taxi_in_arithmetic(spark):
    r = B.calculate(frame(spark, [RETI]), "Reduced_Engine_Taxi_In").first()
    # busiest engine burns 6 kg a minute, 18 kg while cooling: shares 42 and 12; 42 - 12 saved, best case 42
    assert (r["reti__net_savings"], r["reti__savings"], r["reti__best_case_savings"]) == (30.0, 30.0, 42.0)


def test_absent_column_makes_behaviour_constant(spark):
    df = frame(spark, [{k: v for k, v in RETI.items() if k != "taxi_in_minutes"}])
    r = B.calculate(df, "Reduced_Engine_Taxi_In").first()
    assert (r["reti__reason"], r["reti__success"], r["reti__savings"], r["reti__best_case_savings"]) == ("FAULTY_DATA__MISSING_REQUIRED_VALUES", False, 0.0, 0.0)


def test_null_inputs_never_succeed(spark):
    names = set(RETI) - {"ocurrence_datetime", "vehicle"}
    records = [{**RETI, n: None} for n in ("taxi_in_minutes", "act_taxi_in_fuel", "constant_reti_cooldown_time", "constant_reti_threshold")]
    out = B.calculate(frame(spark, records), "Reduced_Engine_Taxi_In").collect()
    assert all(r["reti__success"] in (True, False) and r["reti__savings"] is not None for r in out)
    assert not any(r["reti__success"] for r in out if r["taxi_in_minutes"] is None or r["constant_reti_threshold"] is None)
    assert names


def test_text_inputs_are_read_as_numbers(spark):
    df = frame(spark, [SAILING]).select(*[F.col(c).cast("string").alias(c) for c in SAILING])
    assert B.calculate(df, "Optimal_Sailing").first()["optimal_sailing__success"]


def test_exclusions_come_first_and_zero_everything(spark):
    rules = [{"field_name": "vehicle", "values": ["A339"]}, {"field_name": "no_such_field", "values": ["x"]}]
    r = B.calculate(frame(spark, [{**RETI, "act_taxi_in_fuel": 0.0}]), "Reduced_Engine_Taxi_In", exclusions=rules).first()
    assert r["reti__reason"] == "NOT_POSSIBLE__FILTERED_SETTINGS__VEHICLE"
    assert (r["reti__net_savings"], r["reti__savings"], r["reti__best_case_savings"]) == (0.0, 0.0, 0.0)


def test_run_qualifies_and_counts(spark):
    both = {**SAILING, **{k: v for k, v in EMO.items() if k not in SAILING}}
    df = frame(spark, [both, {**both, "dfoc": 200.0}, {**both, "voyage_time_hs": 0.0}])
    watch = Observation("qualified")
    out = B.run(df, ["Optimal_Sailing", "Engine_Maintenance_Optimisation"], watch=watch)
    assert sorted(r["qualified"] for r in out.collect()) == [False, True]
    assert watch.get == {"non_qualified": 1, "events": 2}


def test_user_behaviour(spark):
    @B.behaviour("Half_Speed", "hs", ["speed"])
    def half_speed(s):
        return Outcome([("FAULTY_DATA__INVALID_SPEED", s.num("speed") > 30)], 10 - s.num("speed"), s.num("speed") < 10)

    out = B.calculate(spark.createDataFrame([(4.0,), (12.0,), (40.0,)], ["speed"]), "Half_Speed")
    assert [(r["hs__savings"], r["hs__reason"]) for r in out.orderBy("speed").collect()] == [(6.0, ""), (0.0, ""), (0.0, "FAULTY_DATA__INVALID_SPEED")]
    del BEHAVIOURS["Half_Speed"]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.floats(0, 200), st.floats(-5, 60), st.floats(0, 300), st.floats(0, 90)), min_size=1, max_size=8))
def test_savings_exactly_on_success(spark, values):
    df = frame(spark, [{**SAILING, "me_foc": f, "dfoc": d, "voyage_time_hs": v, "constant_delta_fuel_consumption": c} for f, d, v, c in values])
    for r in B.calculate(df, "Optimal_Sailing").collect():
        assert r["optimal_sailing__success"] <= (r["optimal_sailing__reason"] == "")
        assert (r["optimal_sailing__savings"] != 0) == r["optimal_sailing__success"]


def test_full_use_equals_plain_reading(spark):
    loads = [1400.0, 900.0, 1100.0, 700.0]
    combos = [(n, float(d)) for n, d in itertools.product(range(0, 5), range(0, 90_000, 7_000))]
    df = spark.createDataFrame(combos, ["n", "d"])
    got = {(r["n"], r["d"]): r["f"] for r in df.withColumn("f", full_use(F.col("n"), F.col("d"), [F.lit(x) for x in loads], F.lit(0.8), F.lit(24.0))).collect()}
    cap = [sum(sorted(loads)[-k:]) * 0.8 * 25 for k in range(1, 5)]
    for n, d in combos:
        want = n >= 1 and d <= cap[n - 1] and (n == 1 or d > cap[n - 2])
        assert got[(n, d)] == want
