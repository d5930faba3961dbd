"""Derived columns of ship-day reports.

``sea`` is the common form; ``sea_by_number`` keys its constants by ship number instead of name; ``tanker`` and
``charter`` differ further.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetmart.functions import columns as X
from fleetmart.functions import dates as D
from fleetmart.functions import strings as S
from fleetmart.functions.registry import PARENTS, formula

SEA, SEA_BY_NUMBER, TANKER, CHARTER = "sea", "sea_by_number", "tanker", "charter"
PARENTS[SEA_BY_NUMBER] = SEA

for _domain in (SEA, CHARTER):
    for _place in ("origin", "destination"):
        formula(_place, [], _domain)(lambda c, state, p=_place: S.unknown_if_null(c(p)))
for _place in ("origin", "destination"):
    formula(_place, [], TANKER)(lambda c, state, p=_place: S.long_enough(c(p)))

for _out, _part in (("me_hours", "running_hours"), ("me_load", "load"), ("me_power", "electric_power_kw")):
    formula(_out, [], SEA)(lambda c, state, p=_part: X.known_total([X.number(c(f"me1_{p}")), X.number(c(f"me2_{p}"))]))

# Per-ship constants: ``state`` is {ship: value}. Ships are keyed by name (any case) or, for charter, by number.
NAMED_CONSTANTS = (
    ["constant_emo_delta_fuel", "constant_delta_fuel_consumption", "vehicle_email_operator1", "vehicle_email_operator2"],
    ["imo", "vessel_type", "team_name", "aeu_lower_threshold", "emo_delta_fuel", "constant_aeu_lower"]
    + [f"aux_engine{i}_{bound}_load" for i in (1, 2, 3, 4) for bound in ("max", "min")],
    ["aeu_lower_threshold", "emo_threshold", "team_name", "vehicle_email_operator1", "vehicle_email_operator2"]
    + [f"aux_engine{i}_{k}" for i in (1, 2, 3) for k in ("max_load", "mcr_const")],
)


def _by_name(c, state):
    return X.look_up({str(k).upper(): v for k, v in state.items()}, F.upper(c("vehicle")))


def _by_number(c, state):
    return X.look_up({str(k).upper(): v for k, v in state.items()}, F.upper(c("imo").cast("string")))


for _f in NAMED_CONSTANTS[0]:
    formula(_f, ["vehicle"], SEA)(_by_name)
    formula(_f, ["vehicle"], TANKER)(_by_name)
for _f in NAMED_CONSTANTS[1]:
    formula(_f, ["vehicle"], TANKER)(_by_name)
    formula(_f, ["vehicle"], SEA)(_by_name)
for _f in {*NAMED_CONSTANTS[0], *NAMED_CONSTANTS[1]} - {"imo"}:
    formula(_f, ["imo"], SEA_BY_NUMBER)(_by_number)
for _f in NAMED_CONSTANTS[2]:
    formula(_f, ["imo"], CHARTER)(_by_number)


@formula("vehicle", ["imo"], CHARTER)
def _(c, state):
    """``state`` = {ship name: number}, read backwards; the first name listed for a number wins."""
    return X.reverse_look_up({name: [str(no)] for name, no in state.items()}, c("imo").cast("string"))


@formula("event_id", [], SEA)
def _(c, state):
    """Stable over reruns; ``state["keys"]`` names the identifying columns."""
    keys = state.get("keys", ("imo", "report_date_utc"))
    return X.identity(*[c(k) for k in keys])


@formula("identifier", [], SEA)
def _(c, state):
    return F.concat(c("imo").cast("string"), F.lit("-"), c("report_date_utc").cast("string"))


@formula("voyage_time_hs", [], SEA)
def _(c, state):
    return F.coalesce(X.number(c("log_duration")), F.lit(24.0))


@formula("arrival_datetime", [], SEA)
def _(c, state):
    return D.date_and_time(c("report_date_utc"), c("report_time_utc"))


@formula("ocurrence_datetime", ["arrival_datetime", "voyage_time_hs"], SEA)
def _(c, state):
    return D.minus_hours(c("arrival_datetime"), c("voyage_time_hs"))


@formula("arrival_datetime", [], TANKER)
def _(c, state):
    return F.to_date(D.parse_any(c("report_date").cast("string")))


@formula("ocurrence_datetime", ["arrival_datetime"], TANKER)
def _(c, state):
    return F.date_sub(c("arrival_datetime"), 1)


@formula("arrival_datetime", [], CHARTER)
def _(c, state):
    return D.parse_any(c("report_date").cast("string"))


@formula("ocurrence_datetime", ["arrival_datetime", "voyage_time_hs", "manoeuvring_hours"], CHARTER)
def _(c, state):
    return D.minus_hours(c("arrival_datetime"), c("voyage_time_hs"), c("manoeuvring_hours"))
