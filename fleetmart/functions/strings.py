"""Text cleaning Columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Operational modes that count as sailing or resting time, and the port-name pattern.
RESTING_MODES = ("AtSeaUnderwayUsingEngine", "InPortMoored", "AtSeaAnchoring", "AtSeaDrifting")
PORT_PATTERN = r"(?:Dep\.|In\sPort)\s+(.*?)(?:\s+PORT|$)"


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def squeeze_blanks(c: Column) -> Column:
    return F.regexp_replace(c, r"\s+", "")


def strip_leading_zeros(c: Column) -> Column:
    return F.regexp_replace(c, "^0+", "")


def strip_scheme(path: Column) -> Column:
    """File path without a leading ``dbfs:`` or ``file:`` scheme."""
    return F.regexp_replace(path, r"^(dbfs|file):(/+(?=/))?", "")


def decode_path(path: Column) -> Column:
    """Percent-decoding that leaves a literal plus sign alone."""
    return F.try_url_decode(F.regexp_replace(path, r"\+", "%2B"))


def unknown_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit("UNKNOWN"))


def long_enough(c: Column, n: int = 3) -> Column:
    return F.when(F.length(c) >= n, c)


def null_marker(c: Column, marker: str = "\\N") -> Column:
    return F.nullif(c, F.lit(marker))


def distinct_words(c: Column) -> Column:
    """Words in order of first appearance, repeats removed, single blanks between."""
    return F.array_join(F.array_distinct(F.filter(F.split(c, r"\s+"), lambda w: w != "")), " ")


def person_key(first: Column, last: Column) -> Column:
    """First given name plus last name, repeats and dots removed, lower case."""
    return spoken_name(F.concat(F.split(first, " ")[0], F.lit(" "), last))


def spoken_name(full: Column) -> Column:
    return F.lower(F.regexp_replace(distinct_words(full), r"\.", ""))


def title_words(c: Column) -> Column:
    return F.initcap(F.array_join(F.filter(F.split(c, r"\s+"), lambda w: w != ""), " "))


def port_code(position: Column, size: int = 4) -> Column:
    """Leading letters of the port named in a position text; empty when none is named."""
    name = F.regexp_extract(position, PORT_PATTERN, 1)
    return F.substring(F.regexp_replace(name, r"PORT| |\.", ""), 1, size)


def report_kind(event_type: Column, modes: Sequence[str] = RESTING_MODES) -> Column:
    """Noon label of the report that stands in for a missing noon report."""
    in_mode = F.lit(False)
    for m in modes:
        in_mode = in_mode | event_type.contains(m)
    return (
        F.when(event_type.contains("Departure") | event_type.contains("Port"), F.lit("Noon In Port"))
        .when(in_mode, F.lit("Noon At Sea"))
        .otherwise(event_type)
    )
