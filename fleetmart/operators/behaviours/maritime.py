"""Fuel behaviours of ship-day reports.

Three report families feed these: common noon reports (``location``), charter ships (``operational_mode``) and
tankers (speed through water and observed distance).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetmart.functions.columns import any_of, ratio, total
from fleetmart.operators.behaviours.core import Outcome, Sheet, behaviour
from fleetmart.schema import faulty, impossible

# Generator efficiency, hours added for change-over, and limits of plausible reports.
ETA = 0.96
CHANGEOVER_HOURS = 1
HOURS_LOW, HOURS_HIGH = 20, 30
MANOEUVRE_LIMIT = 4
MOORED = ("InPortMoored",)
SAILING = "(?i)sea"


def beyond(c: Column, low: float, high: float) -> Column:
    return (c < low) | (c > high)


def not_strictly_between(c: Column, low: float, high: float) -> Column:
    return ~((c > low) & (c < high))


def not_sailing(s: Sheet) -> tuple[str, Column]:
    return impossible("NOT_AT_SEA"), ~s.text("location").rlike(SAILING)


def lying_still(s: Sheet) -> tuple[str, Column]:
    return impossible("NOT_AT_SEA"), (s.num("speedthroughwatermehrs", 0) <= 0) | (s.num("observeddistance", 0) <= 0)


def running(hours: Sequence[Column]) -> Column:
    """Number of engines that ran."""
    return reduce(add, [F.coalesce((h > 0).cast("int"), F.lit(0)) for h in hours])


def largest(loads: Sequence[Column], n: int) -> Column:
    """Sum of the n largest loads: the best of all ways to pick n. Plain arithmetic, so it stays in generated code."""
    sums = [total(pick) for pick in combinations(loads, n)]
    return F.greatest(*sums) if len(sums) > 1 else sums[0]


def full_use(count: Column, demand: Column, loads: Sequence[Column], const: Column, hours: Column) -> Column:
    """Whether the demand needed exactly the number of engines that ran.

    The capacity of n engines is that of the n largest; with n running, the demand must exceed the capacity of
    n-1 and fit that of n. One running engine has no lower bound.
    """
    unit = const * (hours + CHANGEOVER_HOURS)
    capacity = [largest(loads, n) * unit for n in range(1, len(loads) + 1)]
    cases = [
        (count == n) & (demand <= capacity[n - 1]) & ((demand > capacity[n - 2]) if n > 1 else F.lit(True))
        for n in range(1, len(loads) + 1)
    ]
    return F.coalesce(any_of(cases), F.lit(False))


@behaviour(
    "Optimal_Sailing", "optimal_sailing", ["location", "me_foc", "dfoc", "voyage_time_hs", "constant_delta_fuel_consumption"],
    predicted=True,
)
def optimal_sailing(s: Sheet) -> Outcome:
    """Main-engine consumption (tonnes, taken to kg) against its ideal plus an allowed percentage."""
    foc, delta, allowed = s.num("me_foc"), s.num("dfoc"), s.num("constant_delta_fuel_consumption")
    used = foc * 1000
    (ideal,) = s.let(ideal=ratio(used, 1 + delta / 100))
    (expected,) = s.let(expected=ideal * (1 + allowed / 100))
    net = expected - used
    room = expected - F.when(used < ideal, used).otherwise(ideal)
    reasons = [
        not_sailing(s),
        s.missing(["location", "me_foc", "dfoc", "voyage_time_hs", "constant_delta_fuel_consumption"]),
        (impossible("VOYAGE_TOO_SHORT"), s.num("voyage_time_hs") < 20),
        (faulty("OUTLIER_VALUES"), (expected > 100_000) | (foc <= 5)),
        (faulty("INVALID_DFOC"), (delta >= 150) | (delta < -75)),
    ]
    return Outcome(reasons, net, (net > 0) & (delta < allowed), best=F.when(room > 0, room).otherwise(0.0))


@behaviour(
    "Engine_Maintenance_Optimisation", "emo",
    ["location", "me_sfoc", "me_hours", "me_power", "delta_sfoc", "voyage_time_hs", "constant_emo_delta_fuel"],
    predicted=True,
)
def engine_maintenance_by_delta(s: Sheet) -> Outcome:
    """Specific consumption against the value its own delta implies, plus an allowed percentage."""
    sfoc, delta, hours, power = s.num("me_sfoc"), s.num("delta_sfoc"), s.num("me_hours"), s.num("me_power")
    kwh, limit = s.let(kwh=power * hours, limit=ratio(sfoc, 1 + delta / 100) * (1 + s.num("constant_emo_delta_fuel") / 100))
    (net,) = s.let(net0=limit * kwh / 1000 - sfoc * kwh / 1000)
    reasons = [
        not_sailing(s),
        s.missing(["location", "me_sfoc", "me_hours", "me_power", "delta_sfoc", "voyage_time_hs", "constant_emo_delta_fuel"]),
        (impossible("VOYAGE_TOO_SHORT"), s.num("voyage_time_hs") < 6),
        (faulty("INVALID_RUNNING_HOURS"), beyond(hours, HOURS_LOW, HOURS_HIGH)),
        (faulty("INVALID_KWHRS"), power > 10_000),
        (faulty("INVALID_SFOC"), sfoc.isNull() | beyond(sfoc, 100, 400)),
        (faulty("INVALID_DELTA_SFOC"), delta.isNull() | beyond(delta, -99, 99)),
        (faulty("OUTLIER_VALUES"), power > 300_000),
    ]
    return Outcome(reasons, net, sfoc <= limit, F.when(net > 0, net).otherwise(0.0), net_if_eligible=True)


@behaviour(
    "Engine_Maintenance_Optimisation_Threshold", "emo",
    ["me_cons", "operational_mode", "me_hours", "speed_bosp", "wind_speed_bf", "me_sfoc", "me_power"],
    predicted=True, exempt=MOORED,
)
def engine_maintenance_by_threshold(s: Sheet, exempt) -> Outcome:
    """Charter form: whole-number specific consumption against the ship's own threshold."""
    needs = ["me_cons", "operational_mode", "me_hours", "speed_bosp", "wind_speed_bf", "me_sfoc", "me_power"]
    hours = s.num("me_hours", 0)
    sfoc, kwh = s.let(sfoc=F.round(s.num("me_sfoc", 0), 0), kwh=s.num("me_power", 0) * hours)
    used, allowed = s.let(used=kwh * sfoc, allowed=kwh * s.num("emo_threshold"))
    reasons = [
        (impossible("NOT_AT_SEA"), s.text("operational_mode").isin(list(exempt))),
        (impossible("MANOEUVRE_TIME_OVER_LIMIT"), s.num("manoeuvring_hours") > MANOEUVRE_LIMIT),
        s.missing(needs),
        (faulty("INVALID_FUEL_REPORT"), not_strictly_between(sfoc, 100, 300)),
        (faulty("INVALID_RUNNING_HOURS"), beyond(hours, HOURS_LOW, HOURS_HIGH)),
        (impossible("SPEED_UNDER_MIN"), s.num("speed_bosp", 0) < 7),
        (impossible("BAD_WEATHER"), s.num("wind_speed_bf", 0) >= 5),
    ]
    return Outcome(reasons, (allowed - used) / 1000, used <= allowed)


@behaviour(
    "Engine_Maintenance_Optimisation_Curve", "emo",
    ["imo", "steaming_hours", "mainenginerunninghrs", "main_engine_kwhrs", "emo_delta_fuel", "speedthroughwatermehrs",
     "observeddistance"],
    predicted=True,
)
def engine_maintenance_by_curve(s: Sheet) -> Outcome:
    """Tanker form: specific consumption against the ship's consumption curve (column ``sfoc_min``)."""
    hours, sfoc = s.num("mainenginerunninghrs", 0), s.num("emo_sfoc", 0)
    kwhrs, allowed, floor = s.num("main_engine_kwhrs", 0), s.num("emo_delta_fuel"), s.num("sfoc_min")
    propulsion, generators = s.num("total_propulsion_consumption_new"), s.num("total_generator_consumption_new")
    used, delta = s.let(used=sfoc * (hours * kwhrs) / 1000, delta=ratio(sfoc - floor, floor) * 100)
    (ideal,) = s.let(ideal=ratio(used, 1 + delta / 100))
    most, least = s.let(most=ideal * (1 + allowed / 100), least=ideal * (1 - allowed / 100))
    net = most - used
    averages = s.nums("generator_energy_hourly_avg_#", 4, 0)
    reasons = [
        lying_still(s),
        (impossible("VOYAGE_TOO_SHORT"), s.num("steaming_hours", 0) < 6),
        (faulty("INVALID_RUNNING_HOURS"), beyond(hours, HOURS_LOW, HOURS_HIGH)),
        (faulty("INVALID_SFOC"), beyond(sfoc, 50, 400)),
        (faulty("INVALID_KWHRS"), (kwhrs > 10_000) | (F.greatest(*averages) > 7_500)),
        (faulty("INVALID_PROPULSION_CONSUMPTION"), (propulsion <= 0) | (propulsion > 100)),
        (faulty("INVALID_GENERATOR_CONSUMPTION"), (generators <= 0) | (generators > 100)),
        (faulty("SFOC_NOT_AVAILABLE"), floor.isNull()),
        (faulty("INVALID_DELTA_SFOC"), delta > 100),
    ]
    best = most - F.when(used < least, used).otherwise(least)
    return Outcome(reasons, net, (net > 0) & (delta < allowed), best=lambda ok, savings: F.when(ok, best).otherwise(0.0))


USED = "aeu_calc"  # side column: the use as computed, in percent (tankers: a ratio to 1)

FOUR_ENGINE_NEEDS = (
    ["location", "aeu", "sfocisoae", "constant_aeu_lower", "constant_aeu_upper", "log_duration"]
    + [f"ae{i}_{k}" for k in ("running_hours", "electric_power_kw") for i in (1, 2, 3, 4)]
    + [f"aux_engine{i}_{k}" for k in ("max_load", "const") for i in (1, 2, 3, 4)]
)


@behaviour("Efficient_Auxiliary_Engine_Use", "eaeu", FOUR_ENGINE_NEEDS, predicted=True, side=[USED])
def auxiliary_engines_four(s: Sheet) -> Outcome:
    """Energy demand against what the running generators could have delivered, in percent.

    The reported ``aeu`` decides eligibility; the recomputed one decides the result.
    """
    hours, power = s.nums("ae#_running_hours", 4), s.nums("ae#_electric_power_kw", 4)
    loads, consts = s.nums("aux_engine#_max_load", 4), s.nums("aux_engine#_const", 4)
    duration, sfoc, lower, reported = s.num("log_duration"), s.num("sfocisoae"), s.num("constant_aeu_lower"), s.num("aeu")
    demand, ran = s.let(demand=total(p * h / ETA for p, h in zip(power, hours)), ran=total(hours))
    (share,) = s.let(share=ratio(demand, total(c * (c * m) * h for c, m, h in zip(consts, loads, hours))))
    full = full_use(running(hours), demand, loads, consts[0], duration) | (share >= 1) | (ran <= duration)
    (use,) = s.let(use=F.when(full, 100.0).otherwise(share * 100))
    net = (use - lower) / 100 * sfoc * demand / 1000
    reasons = [
        s.missing(FOUR_ENGINE_NEEDS),
        (impossible("VOYAGE_TOO_SHORT"), duration < 20),
        (impossible("EAEU_OVER_THRESHOLD"), reported > 100),
        (faulty("EAEU_NOT_USED"), (reported == 0) | (ran <= 0)),
        (faulty("INVALID_SFOC"), beyond(sfoc, 100, 400)),
    ]
    return Outcome(reasons, net, use >= lower, F.round(net, 2), side={USED: use})


@behaviour(
    "Efficient_Auxiliary_Engine_Use_Charter", "eaeu", ["operational_mode", "me_hours", "ae_sfoc", "ae_cons"],
    predicted=True, side=[USED], exempt=(),
)
def auxiliary_engines_three(s: Sheet, exempt) -> Outcome:
    hours, power = s.nums("ae_hours#", 3, 0), s.nums("ae_power#", 3, 0)
    loads, consts = s.nums("aux_engine#_max_load", 3, 0), s.nums("aux_engine#_mcr_const", 3, 0)
    sfoc, lower, duration = s.num("ae_sfoc", 0), s.num("aeu_lower_threshold", 0), s.num("voyage_time_hs", 0)
    (demand,) = s.let(demand=total(p * h / ETA for p, h in zip(power, hours)))
    (share,) = s.let(share=ratio(demand, total(c * (c * m) * h for c, m, h in zip(consts, loads, hours))))
    full = full_use(running(hours), demand, loads, consts[0], duration) | (share >= 1)
    (use,) = s.let(use=F.coalesce(F.when(full, 100.0).otherwise(share * 100), F.lit(100.0)))
    net = (use - lower) / 100 * sfoc * demand / 1000
    reasons = [
        (impossible("NOT_AT_SEA"), s.text("operational_mode").isin(list(exempt)) if exempt else F.lit(False)),
        (impossible("MANOEUVRE_TIME_OVER_LIMIT"), s.num("manoeuvring_hours") > MANOEUVRE_LIMIT),
        s.missing(["operational_mode", "me_hours", "ae_cons"]),  # a missing sfoc counts as zero, hence as invalid
        (faulty("INVALID_SFOC"), not_strictly_between(sfoc, 100, 400)),
        (faulty("INVALID_RUNNING_HOURS"), total(hours) < 0),
        (faulty("INVALID_AUX_ENGINES_CONSUMPTION"), s.num("ae_cons") < 0),
    ]
    return Outcome(reasons, net, use >= lower, side={USED: use})


TANKER_GENERATOR_NEEDS = (
    [f"generator_energy_hourly_avg_{i}" for i in (1, 2, 3, 4)]
    + [f"generator_{i}_running_hours" for i in (1, 2, 3, 4)]
    + ["speedthroughwatermehrs", "observeddistance", "constant_eaeu_eta", "constant_eaeu_const", "aeu_lower_threshold"]
    + [f"aux_engine{i}_{k}_load" for i in (1, 2, 3, 4) for k in ("max", "min")]
)


@behaviour("Efficient_Auxiliary_Engine_Use_Tanker", "eaeu", TANKER_GENERATOR_NEEDS, predicted=True, side=[USED])
def auxiliary_engines_ratio(s: Sheet) -> Outcome:
    """As above, as a ratio to 1, from hourly averages over a day."""
    energy, hours = s.nums("generator_energy_hourly_avg_#", 4, 0), s.nums("generator_#_running_hours", 4, 0)
    loads, const = s.nums("aux_engine#_max_load", 4), s.num("constant_eaeu_const")
    sfoc, lower = s.num("aux_engines_sfoc", 0), s.num("aeu_lower_threshold")
    produced = total((m * const) * ratio(e, m) * h for m, e, h in zip(loads, energy, hours))
    demand, fuel = s.let(
        demand=ratio(produced, s.num("constant_eaeu_eta")), fuel=total(sfoc * e * h for e, h in zip(energy, hours)) / 1000
    )
    (share,) = s.let(share=ratio(demand, total(const * (m * const) * h for m, h in zip(loads, hours))))
    full = full_use(running(hours), demand, loads, const, F.lit(24.0)) | (share >= 1)
    (use,) = s.let(use=F.when(full, 1.0).otherwise(share))
    best = (1 - lower) * fuel
    return Outcome([], (use - lower) * fuel, use >= lower, best=lambda ok, savings: F.when(ok, best).otherwise(0.0), side={USED: use})


@behaviour(
    "Optimal_Trim", "optimal_trim", ["imo", "speedthroughwatermehrs", "observeddistance", "trim", "meandraft"], predicted=True
)
def optimal_trim(s: Sheet) -> Outcome:
    """Needs ``trim_perc_actual`` and ``trim_perc_limit`` (NULL for ships without a trim table), see
    :func:`fleetmart.plans.trim.with_trim_percentages`."""
    percent, limit = s.num("trim_perc_actual"), s.num("trim_perc_limit")
    speed, fuel = s.num("speedthroughwatermehrs", 0), s.num("total_propulsion_consumption_new") * 1000
    cleaning = [s.num(f"tank_cleaning_consumption_{k}", 0) for k in ("ifo", "mgo", "lsf", "mdo")]
    alpha, beta = s.let(alpha=1 + percent / 100, beta=1 + limit / 100)
    net = F.when(alpha > 0, fuel * ratio(beta, alpha) - fuel).otherwise(0.0)
    best = fuel * beta - fuel
    reasons = [
        (impossible("TRIM_NOT_AVAILABLE"), limit.isNull()),
        lying_still(s),
        (impossible("SPEED_UNDER_MIN"), speed < 11),
        (faulty("INVALID_SPEED"), speed > 20),
        (faulty("INVALID_MEAN_DRAFT"), s.num("meandraft", 0) > 20),
        (impossible("TANK_CLEANING"), F.greatest(*cleaning) > 0),
        (impossible("BAD_WEATHER"), s.num("beaufort", 0) >= 6),
        (impossible("TRIM_OUT_OF_LIMITS"), percent.isNull()),
    ]
    return Outcome(reasons, net, percent <= limit, best=lambda ok, savings: F.when(ok, best).otherwise(0.0))


@behaviour(
    "Efficient_Trim", "et", ["me_cons", "me_hours", "speed_bosp", "wind_speed_bf", "trim", "load"], predicted=True, exempt=MOORED
)
def efficient_trim(s: Sheet, exempt) -> Outcome:
    """6.3 kg per hour saved on even keel, 12.6 less per metre of trim; -0.25 to 0.5 m succeeds."""
    trim, hours = s.num("trim", -2), s.num("me_hours")
    reasons = [
        (impossible("NOT_AT_SEA"), s.text("operational_mode").isin(list(exempt))),
        (impossible("MANOEUVRE_TIME_OVER_LIMIT"), s.num("manoeuvring_hours") > MANOEUVRE_LIMIT),
        s.missing(["me_cons", "me_hours", "speed_bosp", "wind_speed_bf", "trim", "load"]),
        (impossible("TRIM_NOT_ACHIEVABLE_WHEN_BALLAST"), s.text("load") == "B"),
        (faulty("INVALID_FUEL_REPORT"), s.num("me_cons") <= 0),
        (faulty("INVALID_RUNNING_HOURS"), beyond(hours, HOURS_LOW, HOURS_HIGH)),
        (impossible("SPEED_UNDER_MIN"), s.num("speed_bosp") < 7),
        (impossible("BAD_WEATHER"), s.num("wind_speed_bf") >= 5),
    ]
    return Outcome(reasons, (F.lit(6.3) - F.abs(trim) * 12.6) * hours, trim.between(-0.25, 0.5))


@behaviour(
    "Efficient_Power_Management", "epm",
    ["epm_success", "epm_fuel_saved", "epm_best_fuel_saved", "total_hours", "overproduced_hours"], predicted=True,
)
def power_management(s: Sheet) -> Outcome:
    """Passes on what the hourly generator pipeline found for the day."""
    hours, best = s.num("total_hours"), s.num("epm_best_fuel_saved")
    ok = s.text("epm_success")
    reasons = [
        (impossible("VOYAGE_TOO_SHORT"), hours <= 3),
        (faulty("INVALID_RUNNING_HOURS"), hours > HOURS_HIGH),
    ]
    return Outcome(
        reasons, s.num("epm_fuel_saved"), ok.cast("string").isin("true", "1", "1.0"),
        best=lambda ok, savings: F.when(ok, best).otherwise(0.0),
    )
