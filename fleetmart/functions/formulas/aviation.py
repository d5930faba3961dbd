"""Derived columns of flight events."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetmart.functions import columns as X
from fleetmart.functions import dates as D
from fleetmart.functions.registry import formula

AIR = "aviation"
ENGINES = (1, 2, 3, 4)
# Flight phases with per-engine fuel, and the share added to planned fuel.
PHASES = ("climb", "cruise", "descent", "approach", "landing", "taxi_out", "take_off", "taxi_in")
PLAN_MARGIN = 1.005
# Team naming.
TEAM_PREFIX, TEAM_WIDE, TEAM_OTHER = "B78", "VS B787 Team", "VSDefaultTeam"


def engines(stem: str) -> list[str]:
    return [f"fuel_burn_{stem}{i}_kg" for i in ENGINES]


def minutes(c, start: str, end: str):
    return D.seconds_between(c(start), c(end)) / F.lit(60.0)


def _register_engine_columns() -> None:
    for phase in PHASES:
        for i in ENGINES:
            raw = f"fuel_burn_{phase}{i}"
            formula(f"{raw}_kg", ["vehicle", raw], AIR)(
                lambda c, state, raw=raw: X.pounds_to_kg(c(raw), c("vehicle") == "B787")
            )
    for phase in ("climb", "cruise", "descent", "approach"):
        formula(f"act_{phase}_fuel", engines(phase), AIR)(
            lambda c, state, phase=phase: X.total(c(e) for e in engines(phase))
        )
    for way, short in (("in", "reti"), ("out", "reto")):
        stem = f"taxi_{way}"
        formula(f"fuel_burn_{short}_main_engine", engines(stem), AIR)(
            lambda c, state, stem=stem: F.greatest(*[c(e).cast("double") for e in engines(stem)])
        )
        formula(f"act_{stem}_fuel_engines", engines(stem), AIR)(
            lambda c, state, stem=stem: X.total(c(e) for e in engines(stem))
        )
        formula(f"act_{stem}_fuel", [f"act_{stem}_fuel_engines", f"act_{stem}_fuel_burn"], AIR)(
            lambda c, state, stem=stem: F.coalesce(
                F.when(c(f"act_{stem}_fuel_engines") > 0, c(f"act_{stem}_fuel_engines")), c(f"act_{stem}_fuel_burn")
            )
        )


_register_engine_columns()


@formula("total_expected_fuel", ["plnd_block_fuel"], AIR)
def _(c, state):
    return c("plnd_block_fuel") * PLAN_MARGIN


@formula("projected_trip_fuel", ["plnd_trip_fuel"], AIR)
def _(c, state):
    return c("plnd_trip_fuel") * PLAN_MARGIN


@formula("act_takeoff_fuel", ["act_bloff_fuel", "act_taxi_out_fuel"], AIR)
def _(c, state):
    burned = F.when(c("act_taxi_out_fuel") >= 0, c("act_taxi_out_fuel"))
    return F.coalesce(c("act_bloff_fuel") - burned, c("act_takeoff_fuel"))


@formula("act_landing_fuel", ["act_blon_fuel", "act_taxi_in_fuel"], AIR)
def _(c, state):
    burned = F.when(c("act_taxi_in_fuel") >= 0, c("act_taxi_in_fuel"))
    return F.coalesce(c("act_blon_fuel") + burned, c("act_landing_fuel"))


@formula("act_trip_fuel", ["act_takeoff_fuel", "act_landing_fuel"], AIR)
def _(c, state):
    return c("act_takeoff_fuel") - c("act_landing_fuel")


@formula("plnd_flight_time_hs", ["plnd_flight_time", "plnd_flight_time_secs"], AIR)
def _(c, state):
    return F.coalesce(c("plnd_flight_time") / 60, c("plnd_flight_time_secs") / 3600)


@formula("actual_flight_time_hs", ["actual_flight_time"], AIR)
def _(c, state):
    legs = X.total(c(f"{p}_duration") for p in ("cruise", "approach", "landing", "toc", "tod"))
    return F.coalesce(c("actual_flight_time") / 60, legs / 60)


@formula("plnd_airborne_time", ["plnd_flight_time", "planned_taxi_time"], AIR)
def _(c, state):
    gate_to_gate = minutes(c, "plnd_departure_time", "plnd_arrival_time")
    return F.coalesce(c("plnd_flight_time"), (gate_to_gate - c("planned_taxi_time")) / 60)


@formula("airborne_time", ["actual_flight_time_hs", "taxi_in_minutes", "taxi_out_minutes"], AIR)
def _(c, state):
    gate_to_gate = minutes(c, "ocurrence_datetime", "arrival_datetime")
    return F.coalesce(c("actual_flight_time_hs"), (gate_to_gate - c("taxi_in_minutes") - c("taxi_out_minutes")) / 60)


@formula("duration", ["airborne_time"], AIR)
def _(c, state):
    return X.duration_band(c("airborne_time"))


@formula("weekday", [], AIR)
def _(c, state):
    return D.weekday_from_sunday(c("ocurrence_datetime"))


@formula("team_name", ["vehicle"], AIR)
def _(c, state):
    return F.when(c("vehicle").startswith(TEAM_PREFIX), F.lit(TEAM_WIDE)).otherwise(F.lit(TEAM_OTHER))


@formula("vehicle", [], AIR)
def _(c, state):
    """``state`` = {vehicle type: [registrations]}."""
    return X.reverse_look_up(state, c("aircraft_reg_code"))


@formula("act_zero_fuel_weight_kg", ["vehicle"], AIR)
def _(c, state):
    return X.pounds_to_kg(c("act_zero_fuel_weight"), c("vehicle") == "B787")


@formula("planned_taxi_time", [], AIR)
def _(c, state):
    planned = c("taxi_in_time_sched") + c("taxi_out_time_sched")
    return F.coalesce(c("planned_taxi_time"), F.when(planned > 0, planned), F.lit(0))


@formula("taxi_in_minutes", [], AIR)
def _(c, state):
    return F.coalesce(minutes(c, "act_landing_time", "act_blon_time"), c("taxi_in_minutes_measurement"))


@formula("taxi_out_minutes", [], AIR)
def _(c, state):
    rolled = minutes(c, "act_bloff_time", "act_takeoff_time")
    return F.coalesce(F.when(rolled > 0, rolled), c("taxi_out_minutes_measurement"))


@formula("event_id", [], AIR)
def _(c, state):
    """Stable over reruns; ``state["keys"]`` names the identifying columns."""
    keys = state.get("keys", ("aircraft_reg_code", "ocurrence_datetime"))
    return X.identity(*[c(k) for k in keys])
