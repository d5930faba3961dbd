"""Fuel behaviours of flights."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetmart.functions.columns import any_of, ratio, zero_if_null
from fleetmart.operators.behaviours.core import Outcome, Sheet, behaviour
from fleetmart.schema import faulty, impossible

# Pandemic window, four-engine types, taxi limits (minutes, share of plan), outlier shares.
BLACKOUT = ("2020-03-17", "2021-09-05")
FOUR_ENGINES = "B74|A34"
TAXI_MINUTES_LIMIT, TAXI_OVER_PLAN = 180, 1.2
TAXI_FUEL_LOW, TAXI_FUEL_HIGH = 0.1, 1.2


def flight_reasons(s: Sheet, blackout: tuple[str, str]) -> list[tuple[str, Column]]:
    when = s.text("ocurrence_datetime")
    lo, hi = (F.lit(d).cast("timestamp") for d in blackout)
    return [
        (impossible("COVID_PERIOD"), (when >= lo) & (when <= hi)),
        (impossible("4_ENGINE_VEHICLE"), s.text("vehicle").rlike(FOUR_ENGINES)),
    ]


def outside(actual: Column, plan: Column, low: float, high: float) -> Column:
    return (actual < plan * low) | (actual > plan * high)


def taxi(s: Sheet, way: str, tag: str, wait_field: str, wait_reason: str, blackout):
    """Inputs, reasons and engine figures common to both directions.

    A running engine burns at the highest per-minute rate for the whole thermal wait; what an engine burned
    beyond that is its own taxi share.
    """
    minutes = s.num(f"taxi_{way}_minutes", None if way == "in" else 0)
    fuel = s.num(f"act_taxi_{way}_fuel", None if way == "in" else 0)
    plan = s.num("plnd_taxi_fuel", None if way == "in" else 0)
    wait, margin = s.num(wait_field), s.num(f"constant_{tag}_threshold")
    planned_minutes = s.num("planned_taxi_time")
    burns = s.let(**{f"b{i}": c for i, c in enumerate(s.nums(f"fuel_burn_taxi_{way}#_kg", 4, 0.0), 1)})

    rate = ratio(F.greatest(*burns), minutes)
    pairs, idle = s.let(
        pairs=F.when(burns[2] + burns[3] > 0, 2).otherwise(1),
        idle=F.when(minutes > 0, rate).otherwise(0.0) * wait,
    )
    own = s.let(**{f"e{i}": F.when(b > idle, b - idle).otherwise(0.0) for i, b in enumerate(burns, 1)})
    (main,) = s.let(main=F.greatest(*own))
    (limit,) = s.let(limit=main * (1 - margin))

    absent = any_of([x for c in (minutes, fuel) for x in (c.isNull(), F.isnan(c))])
    reasons = [(faulty("MISSING_REQUIRED_VALUES"), absent)] if way == "in" else []
    reasons += flight_reasons(s, blackout)
    reasons += [
        (faulty("INVALID_TAXI_FUEL"), fuel <= 0),
        (impossible(wait_reason), minutes < wait),
        (
            impossible("TAXI_OVER_LIMIT"),
            (minutes > TAXI_MINUTES_LIMIT) | ((planned_minutes > 0) & (minutes > planned_minutes * TAXI_OVER_PLAN)),
        ),
        (faulty("OUTLIER_VALUES"), (plan > 0) & outside(fuel, plan, TAXI_FUEL_LOW, TAXI_FUEL_HIGH)),
    ]
    return reasons, own, main, limit, pairs


def _engines(tag: str, wait: str, own: list[Column], main: Column) -> dict[str, Column]:
    """Net fuel of each engine and of the busiest one."""
    return {f"fuel_burn_{tag}_{i}_without_{wait}": e for i, e in enumerate(own, 1)} | {f"fuel_burn_{tag}_main_engine": main}


@behaviour(
    "Reduced_Engine_Taxi_In", "reti",
    ["plnd_taxi_fuel", "taxi_in_minutes", "fuel_burn_taxi_in1_kg", "fuel_burn_taxi_in2_kg", "fuel_burn_reti_main_engine",
     "act_taxi_in_fuel", "constant_reti_cooldown_time", "constant_reti_threshold"],
    side=[
        "fuel_burn_reti_1_without_cooldown", "fuel_burn_reti_2_without_cooldown", "fuel_burn_reti_3_without_cooldown",
        "fuel_burn_reti_4_without_cooldown", "fuel_burn_reti_main_engine",
    ],
    blackout=BLACKOUT,
)
def reduced_engine_taxi_in(s: Sheet, blackout) -> Outcome:
    """Engines that stayed clearly below the busiest one after landing were shut down: the difference is saved.

    Side columns: what each engine burned beyond its cool-down, and the most of it (in place of the gross figure)."""
    reasons, own, main, limit, pairs = taxi(s, "in", "reti", "constant_reti_cooldown_time", "UNDER_MIN_COOLDOWN", blackout)

    def saved(i: int) -> Column:
        ran = own[i] > 0 if i >= 2 else F.lit(True)  # outer engines may simply not exist
        return F.when(ran & (own[i] <= limit), main - own[i]).otherwise(0.0)

    (net,) = s.let(net0=saved(0) + saved(1) + saved(2) + saved(3))
    return Outcome(reasons, net, (limit > 0) & (net > 0), F.round(net, 2), F.round(main * pairs, 2), side=_engines("reti", "cooldown", own, main))


@behaviour(
    "Reduced_Engine_Taxi_Out", "reto",
    ["plnd_taxi_fuel", "taxi_out_minutes", "fuel_burn_taxi_out1_kg", "fuel_burn_taxi_out2_kg", "act_taxi_out_fuel",
     "fuel_burn_reto_main_engine", "constant_reto_warmup_time", "constant_reto_threshold"],
    side=[
        "fuel_burn_reto_1_without_warmup", "fuel_burn_reto_2_without_warmup", "fuel_burn_reto_3_without_warmup",
        "fuel_burn_reto_4_without_warmup", "fuel_burn_reto_main_engine",
    ],
    blackout=BLACKOUT,
)
def reduced_engine_taxi_out(s: Sheet, blackout) -> Outcome:
    """Side columns: what each engine burned beyond its warm-up, and the most of it (in place of the gross figure)."""
    reasons, own, main, limit, pairs = taxi(s, "out", "reto", "constant_reto_warmup_time", "UNDER_MIN_WARMUP", blackout)
    net = main * 2 - own[0] - own[1]
    return Outcome(reasons, net, (limit > 0) & (net > 0), best=main * pairs, side=_engines("reto", "warmup", own, main))


@behaviour(
    "Efficient_Flight", "ef",
    ["origin", "destination", "planned_fuel_burn_adjustment", "plnd_trip_fuel", "plnd_takeoff_weight", "loadsheet_tow",
     "act_trip_fuel"],
    blackout=BLACKOUT,
)
def efficient_flight(s: Sheet, blackout) -> Outcome:
    """Trip fuel against the plan corrected for the real take-off weight.

    Fixed values: a flight whose taxi fuel or time is under a fifth of the plan has its planned taxi fuel taken
    off; actual fuel is rounded down and the projection up to hundreds (plus 50); 20 minutes of delay; 5 % best case.
    """
    trip, plan = s.num("act_trip_fuel", 0), s.num("plnd_trip_fuel", 0)
    tow, plan_tow, k = s.num("loadsheet_tow", 0), s.num("plnd_takeoff_weight", 0), s.num("planned_fuel_burn_adjustment")
    plan_taxi, plan_taxi_min = s.num("plnd_taxi_fuel", 0), s.num("planned_taxi_time", 0)
    taxi_fuel = s.num("act_taxi_out_fuel", 0) + s.num("act_taxi_in_fuel", 0)
    taxi_min = s.num("taxi_in_minutes", 0) + s.num("taxi_out_minutes", 0)

    untaxied = (plan_taxi > 0) & ((taxi_fuel < plan_taxi * 0.2) | (taxi_min < plan_taxi_min * 0.2))
    actual, per_ton = s.let(
        actual=F.floor(F.when(untaxied, trip - plan_taxi).otherwise(trip) / 100) * 100.0, per_ton=(tow - plan_tow) / 1000 * k
    )
    (expected,) = s.let(expected=F.ceil((plan + per_ton + per_ton / 1000 * k) / 100) * 100.0 + 50)
    net = expected - actual

    reasons = flight_reasons(s, blackout) + [
        (faulty("INVALID_TOW"), tow <= 0),
        (impossible("INVALID_LEG"), s.text("origin") == s.text("destination")),
        (faulty("OUTLIER_VALUES"), outside(actual, expected, 0.8, 1.1)),
    ]
    if s.has("plnd_flight_time_hs") or s.has("plnd_airborne_time"):
        planned = F.coalesce(s.num("plnd_flight_time_hs"), s.num("plnd_airborne_time", 0)) * 60
        flown = F.coalesce(s.num("actual_flight_time_hs"), s.num("airborne_time", 0)) * 60
        late = (flown > 0) & (planned > 0) & (flown > planned + 20)
        reasons.append((impossible("DELAYED_FLIGHT"), late))
    return Outcome(
        reasons, net, (expected > 0) & (actual < expected), best=lambda ok, savings: F.greatest(savings, expected * 0.05)
    )


@behaviour(
    "Optimal_Discretionary_Fuel_Load", "odfl",
    ["plnd_zero_fuel_weight", "loadsheet_zfw", "plnd_block_fuel", "act_bloff_fuel", "planned_fuel_burn_adjustment",
     "constant_df_buffer", "plnd_target_fuel", "act_landing_fuel", "planned_arrival_delay_fuel", "plnd_contingency_fuel"],
    blackout=BLACKOUT,
)
def discretionary_fuel(s: Sheet, blackout) -> Outcome:
    """Extra fuel loaded against the extra fuel that turned out to be needed.

    The saving uses a tenth and the best case a thousandth of the adjustment factor, as documented for this
    behaviour; the saving is capped by the best case.
    """
    zfw, plan_zfw, k = s.num("loadsheet_zfw"), s.num("plnd_zero_fuel_weight"), s.num("planned_fuel_burn_adjustment")
    tanks, buffer = s.num("act_bloff_fuel", 0), s.num("constant_df_buffer")
    (heavier,) = s.let(heavier=F.when((zfw == 0) | (plan_zfw == 0), 0.0).otherwise(zfw - plan_zfw))
    (first,) = s.let(first=heavier * k / 1000)
    (ramp,) = s.let(ramp=s.num("plnd_block_fuel", 0) + F.when(heavier > 0, first + first * k / 1000).otherwise(first))
    (loaded,) = s.let(loaded=tanks - ramp)
    touchdown = s.num("plnd_target_fuel", 0) + loaded - loaded * k / 1000
    spent = s.num("act_landing_fuel", 0) - touchdown + s.num("planned_arrival_delay_fuel", 0) + s.num("plnd_contingency_fuel", 0)
    (needed,) = s.let(needed=-spent)
    (positive,) = s.let(positive=F.greatest(zero_if_null(needed), F.lit(0.0)))
    (most,) = s.let(most=buffer * (k / 1000))
    raw = (positive - loaded + buffer) * (k / 10)
    net = zero_if_null(F.when(raw > most, most).otherwise(raw))

    reasons = flight_reasons(s, blackout) + [
        (faulty("INVALID_FUEL_TANK"), tanks <= 0),
        (impossible("TANKERED_FLIGHT"), s.num("plnd_tanker_fuel", 0) > 0),
        (faulty("OUTLIER_VALUES"), outside(tanks, ramp, 0.8, 1.2)),
        (impossible("DISCRETIONARY_FUEL_REQUIRED"), needed > loaded),
    ]
    return Outcome(reasons, net, loaded <= positive + buffer, best=zero_if_null(most))
