"""Date and time Columns. Parsing never raises; what does not parse is NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted source formats, tried in this order.
SOURCE_FORMATS = (
    "yyyy-MM-dd HH:mm:ss.SSSSSSS",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
    "dd/MM/yyyy HH:mm:ss",
)
REPORT_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
STANDARD = "yyyy-MM-dd HH:mm:ss"


def parse_any(text: Column, formats: Sequence[str] = SOURCE_FORMATS) -> Column:
    """Timestamp by the plain cast, else by the first format that fits."""
    return F.coalesce(text.try_cast("timestamp"), *[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def parse_report(text: Column) -> Column:
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in REPORT_FORMATS])


def normalised(text: Column, formats: Sequence[str] = SOURCE_FORMATS) -> Column:
    return F.date_format(parse_any(text, formats), STANDARD)


def date_and_time(day: Column, clock: Column) -> Column:
    """Day text plus ``HH:mm`` or ``HH:mm:ss`` text."""
    full = F.when(F.length(clock) == 5, F.concat(clock, F.lit(":00"))).otherwise(clock)
    return F.try_to_timestamp(F.concat_ws(" ", day, full), F.lit(STANDARD))


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_seconds(end) - F.unix_seconds(start)


def minus_hours(ts: Column, *hours: Column) -> Column:
    """ts minus a (fractional) number of hours, to the microsecond."""
    micros = sum((h.cast("double") for h in hours), F.lit(0.0)) * F.lit(3.6e9)
    return F.timestamp_micros(F.unix_micros(ts) - F.round(micros).cast("long"))


def weekday_from_sunday(ts: Column) -> Column:
    return F.dayofweek(ts) - 1


def floor_minutes(ts: Column, step: int) -> Column:
    size = F.lit(step * 60)
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts) / size) * size)


def assemble_datetime(day: Column, month: Column, year: Column, hour: Column, minute: Column, as_of_year: int, second: Column | None = None) -> Column:
    """Timestamp from loose numeric parts; a missing year is ``as_of_year``, two-digit years are 20xx."""
    y = F.coalesce(F.nullif(year, F.lit(0)), F.lit(as_of_year))
    y = F.when(y < 100, y + 2000).otherwise(y)
    sec = F.lit(0) if second is None else F.coalesce(second, F.lit(0))
    return F.try_make_timestamp(y.cast("int"), month.cast("int"), day.cast("int"), hour.cast("int"), minute.cast("int"), sec.cast("decimal(8,6)"))


def from_units_and_tens(units: Column, tens: Column) -> Column:
    """A clock reading split over a units and a tens counter."""
    return F.coalesce(units, F.lit(0)) + F.when(tens < 10, tens * 10).otherwise(F.coalesce(tens, F.lit(0)))
