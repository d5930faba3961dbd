import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows
from fleetmart import schema as S
from fleetmart.functions import columns as X
from fleetmart.functions import dates as D
from fleetmart.functions import strings as St
from fleetmart.functions.registry import apply_formulas, formula, in_dependency_order
from fleetmart.operators import project as P
import fleetmart.functions.formulas  # noqa: F401


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(expr.alias("x")).first()["x"]


def test_reason_codes():
    assert len(S.FAULTY_DATA) + len(S.NOT_POSSIBLE) == 46
    assert S.filtered_by("vehicle") == "NOT_POSSIBLE__FILTERED_SETTINGS__VEHICLE"
    with pytest.raises(KeyError):
        S.faulty("COVID_PERIOD")


def test_numbers_never_raise(spark):
    assert one(spark, X.number("t"), t="12x") is None
    assert one(spark, X.number("t"), t="12.5") == 12.5
    assert one(spark, X.ratio(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, X.first_match([("a", F.lit(None).cast("boolean")), ("b", F.lit(True)), ("c", F.lit(True))])) == "b"


def test_words(spark):
    assert one(spark, St.spoken_name(F.col("n")), n="  Anna  Maria Anna Q.  Smith") == "anna maria q smith"
    assert one(spark, St.person_key(F.lit("Anna Maria"), F.lit("Smith"))) == "anna smith"
    assert one(spark, St.title_words(F.col("n")), n="anna  mcSMITH") == "Anna Mcsmith"
    assert one(spark, St.port_code(F.col("p")), p="Dep. NEW YORK PORT") == "NEWY"
    assert one(spark, St.port_code(F.col("p")), p="drifting") == ""
    assert one(spark, St.decode_path(F.col("p")), p="/a%20b+c") == "/a b+c"
    assert [one(spark, St.strip_scheme(F.lit(p))) for p in ("dbfs:/mnt/x", "file:///tmp/x", "s3://b/x")] == ["/mnt/x", "/tmp/x", "s3://b/x"]
    assert one(spark, St.null_marker(F.lit("\\N"))) is None
    assert one(spark, St.report_kind(F.lit("Departure x"))) == "Noon In Port"
    assert one(spark, St.report_kind(F.lit("AtSeaDrifting"))) == "Noon At Sea"
    assert one(spark, St.report_kind(F.lit("Bunkering"))) == "Bunkering"


def test_dates(spark):
    for text in ("2024-05-01 10:00:00", "2024-05-01 10:00:00.0000000", "2024-05-01T10:00:00.000Z", "01/05/2024 10:00:00"):
        assert one(spark, D.normalised(F.col("t")), t=text) == "2024-05-01 10:00:00"
    assert one(spark, D.normalised(F.col("t")), t="soon") is None
    for clock, want in (("10:30", 30), ("10:30:00", 30)):
        assert one(spark, D.date_and_time(F.lit("2024-05-01"), F.lit(clock))).minute == want
    ts = F.lit("2024-05-01 12:00:00").cast("timestamp")
    assert one(spark, D.minus_hours(ts, F.lit(1.5))) == dt.datetime(2024, 5, 1, 10, 30)
    assert one(spark, D.weekday_from_sunday(ts)) == 3
    made = D.assemble_datetime(F.lit(5), F.lit(6), F.lit(None).cast("int"), F.lit(7), F.lit(48), 2024)
    assert one(spark, D.floor_minutes(made, 10)) == dt.datetime(2024, 6, 5, 7, 40)
    assert one(spark, D.assemble_datetime(F.lit(31), F.lit(2), F.lit(24), F.lit(1), F.lit(1), 2024)) is None
    assert one(spark, D.from_units_and_tens(F.lit(3), F.lit(2))) == 23


def test_lookups(spark):
    fleets = {"B787": ["G-1", "G-2"], "A339": ["G-2", "G-3"]}
    assert one(spark, X.reverse_look_up(fleets, F.lit("G-2"))) == "B787"
    assert one(spark, X.reverse_look_up(fleets, F.lit("G-9"))) is None


def test_formula_order_and_absent_inputs(spark):
    df = spark.createDataFrame([("B787", 100.0, 50.0, 10.0, 5.0)], ["vehicle", "act_bloff_fuel", "act_blon_fuel", "act_taxi_out_fuel", "fuel_burn_taxi_in1"])
    out = apply_formulas(df, ["act_trip_fuel", "act_landing_fuel", "act_takeoff_fuel", "fuel_burn_taxi_in1_kg", "fuel_burn_reti_main_engine", "planned_taxi_time"], "aviation").first()
    assert out["act_takeoff_fuel"] == 90.0
    assert out["act_landing_fuel"] is None and out["act_trip_fuel"] is None  # no taxi-in fuel, no earlier value
    assert out["fuel_burn_reti_main_engine"] == pytest.approx(2.27)
    assert out["planned_taxi_time"] == 0


def test_all_phase_formulas_exist():
    from fleetmart.functions.registry import FORMULAS

    air = [f for d, f in FORMULAS if d == "aviation"]
    assert sum(f.endswith("_kg") and f.startswith("fuel_burn_") for f in air) == 32
    assert {"act_climb_fuel", "act_cruise_fuel", "act_descent_fuel", "act_approach_fuel"} <= set(air)


def test_maritime_formulas(spark):
    df = spark.createDataFrame([("Star", "9", "2024-05-02", "06:00", None, 3.0, None)], "vehicle string, imo string, report_date_utc string, report_time_utc string, log_duration double, me1_running_hours double, me2_running_hours double")
    fields = ["ocurrence_datetime", "arrival_datetime", "voyage_time_hs", "identifier", "me_hours", "constant_emo_delta_fuel", "origin"]
    out = apply_formulas(df, fields, "sea", {"constant_emo_delta_fuel": {"STAR": 4.5}}).first()
    assert out["ocurrence_datetime"] == dt.datetime(2024, 5, 1, 6)
    assert (out["identifier"], out["me_hours"], out["constant_emo_delta_fuel"], out["origin"]) == ("9-2024-05-02", 3.0, 4.5, "UNKNOWN")
    charter = apply_formulas(df, ["vehicle", "aux_engine1_max_load"], "charter", {"vehicle": {"Moon": 9}, "aux_engine1_max_load": {"9": 1200}}).first()
    assert (charter["vehicle"], charter["aux_engine1_max_load"]) == ("Moon", 1200)


def test_constants_by_number_and_required(spark):
    from fleetmart.plans.mapping import Field, Mapping, derive

    df = spark.createDataFrame([("Star", "9a"), ("Moon", "8")], "vehicle string, imo string")
    out = apply_formulas(df, ["constant_aeu_lower", "event_id"], "sea_by_number", {"constant_aeu_lower": {"9A": 70}})
    got = {r["vehicle"]: r for r in out.collect()}
    assert got["Star"]["constant_aeu_lower"] == 70 and got["Moon"]["constant_aeu_lower"] is None and len(got["Star"]["event_id"]) == 64
    m = Mapping("st", [Field("vessel_type", formula="vessel_type", state={"star": "chemical"})], domain="tanker")
    assert [r["vessel_type"] for r in derive(df, m).collect()] == ["chemical"]


def test_user_formula_and_cycle(spark):
    @formula("double_it", ["n"], "test")
    def _(c, state):
        return c("n") * 2

    assert rows(apply_formulas(spark.createDataFrame([(2,)], ["n"]), ["double_it"], "test")) == [(2, 4)]
    f = formula("a1", ["b1"], "test"), formula("b1", ["a1"], "test")
    f[0](lambda c, s: c("b1"))
    f[1](lambda c, s: c("a1"))
    from fleetmart.functions.registry import find

    with pytest.raises(ValueError):
        in_dependency_order({"a1": find("a1", "test"), "b1": find("b1", "test")})


def test_names():
    assert P.unique_names(["x", "y", "x", "z", "y"]) == ["x", "y", "x_1", "z", "y_1"]
    assert P.unique_names(["x", "x_1", "x"]) == ["x", "x_1", "x_2"]
    assert P.canonical_name("  Fuel   Burn (kg) ") == "fuel_burn_kg"


def test_wide_steps_are_compiled_and_read_the_old_values(spark):
    from fleetmart.functions.registry import with_columns
    from fleetmart.plans.catalog import all_queries

    df = spark.createDataFrame([(1.0, "x"), (None, "y"), (1.0, "x")], "a double, `b.c` string")
    new = {f"n{i}": F.col("a") + i for i in range(60)} | {"A": F.col("a") * 2, "last": F.col("a") * 3}
    got, want = with_columns(df, new), df.withColumns(new)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = all_queries()["formula_flight_events"].run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
    debug = spark._jvm.org.apache.spark.sql.execution.debug
    pieces = getattr(getattr(debug, "package$"), "MODULE$").codegenStringSeq(plan)
    assert max(pieces.apply(i)._3().maxMethodCodeSize() for i in range(pieces.size())) < 8000
