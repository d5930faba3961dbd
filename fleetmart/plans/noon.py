"""Tanker noon reports and fuel consumption, ready to merge by ship and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.functions.strings import null_marker
from fleetmart.operators.aggregates import pivot_sums
from fleetmart.operators.joins import same_day_join
from fleetmart.operators.timeline import DAY, top_row, with_context

NOON_TYPES = ("N", "A")  # fixed values: noon and arrival reports


def with_voyage_ports(reports: DataFrame, ship: str = "ship", order: Sequence[str] = ("ts", "report_type"), origin: str = "from_port", target: str = "to_port", width: int = DAY) -> DataFrame:
    """Fill a missing voyage leg from the last known target port; the text marker for NULL is read as NULL."""
    clean = reports.withColumns({origin: null_marker(F.col(origin)), target: null_marker(F.col(target))})
    filled = with_context(clean, [ship], list(order), fill={"_last": target}, width=width)
    gone = F.col(target).isNull()
    return filled.withColumns(
        {origin: F.when(gone, F.col("_last")).otherwise(F.col(origin)), target: F.coalesce(F.col(target), F.col("_last"))}
    ).drop("_last")


def noon_reports(reports: DataFrame, ship: str = "ship", day: str = "day", order: Sequence[str] = ("ts", "report_type")) -> DataFrame:
    """Latest noon or arrival report per ship and day, with voyage ports filled."""
    filled = with_voyage_ports(reports, ship, order)
    return top_row(filled.filter(F.col("report_type").isin(*NOON_TYPES)), [ship, day], order)


def fuel_by_type(consumption: DataFrame, fuel_types: Sequence[str], left_out: Sequence[str] = (), ship: str = "ship", ts: str = "ts") -> DataFrame:
    """Propulsion and generator consumption per ship and day: totals first, then one pair per fuel type."""
    rows = consumption.filter(~F.col(ship).isin(*left_out)) if left_out else consumption
    return pivot_sums(
        rows.withColumn("report_date", F.to_date(F.col(ts))),
        [ship, "report_date"],
        "fuel_type",
        fuel_types,
        {"PropulsionConsumption": "propulsion", "GeneratorConsumption": "generator"},
        {"TotalGeneratorConsumptionNEW": "generator", "TotalPropulsionConsumptionNEW": "propulsion"},
    )


def merge_ship_days(fuel: DataFrame, noon: DataFrame, engine: DataFrame, ship: str = "ship", day: str = "report_date") -> DataFrame:
    """Fuel, noon and engine figures of the same ship and day."""
    return same_day_join([fuel, noon, engine], [day, ship])
