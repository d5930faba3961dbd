"""Departure and arrival of recorder files, from their loose clock and calendar columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.functions import dates as D
from fleetmart.operators.aggregates import CALENDAR_NAMES, CLOCK_NAMES, recorder_start

TENS = "X10"  # fixed values: how split counters are told apart, planning grid and recording length
PLAN_STEP_MINUTES, RECORDING_SECONDS = 10, 30


def named(columns: Sequence[str], pattern: str, *parts: str) -> str | None:
    """First column of a family that has one of the parts in its name."""
    return next((c for c in columns if re.match(pattern, c) and any(p in c for p in parts)), None)


def clock(columns: Sequence[str], *parts: str) -> Column | None:
    """A clock reading: one column, or the units and tens columns added up."""
    family = [c for c in columns if re.match(CLOCK_NAMES, c) and any(p in c for p in parts)]
    if not family:
        return None
    tens = next((c for c in family if TENS in c), None)
    units = next((c for c in family if c != tens), None)
    if tens is None:
        return F.col(units).cast("double")
    return D.from_units_and_tens(F.col(units).cast("double") if units else F.lit(0.0), F.col(tens).cast("double"))


def flight_times(records: DataFrame, file_column: str, as_of_year: int) -> DataFrame:
    """Per file: planned departure (whole ten minutes), actual departure and arrival.

    The readings are the per-file maxima; a missing year is ``as_of_year``. Files without a usable date or time
    get NULLs. Raises when the table has no such columns at all.
    """
    tops = recorder_start(records, file_column)
    day, month, year = (named(tops.columns, CALENDAR_NAMES, p) for p in ("DAY", "MONTH", "YEAR"))
    hours, minutes, seconds = clock(tops.columns, "HR", "HOUR"), clock(tops.columns, "MIN"), clock(tops.columns, "SEC")
    if day is None or month is None or hours is None or minutes is None:
        raise ValueError("no usable date and time columns")
    y = F.col(year).cast("double") if year else F.lit(None).cast("double")
    start = D.assemble_datetime(F.col(day).cast("double"), F.col(month).cast("double"), y, hours, minutes, as_of_year, seconds)
    out = tops.select(F.col(file_column.upper()).alias("source_file_name"), start.alias("actual_departure"))
    return out.withColumns(
        {
            "plan_departure": D.floor_minutes(F.col("actual_departure"), PLAN_STEP_MINUTES),
            "actual_arrival": F.timestamp_seconds(F.unix_seconds("actual_departure") + RECORDING_SECONDS),
        }
    )
