"""From harmonised sources to published tables: mapping, merge, formulas, behaviours, vault."""

from __future__ import annotations

from collections.abc import Mapping as MappingABC
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fleetmart.operators import behaviours as B
from fleetmart.operators.project import canonical_header, composite_key, doubles_to_decimal
from fleetmart.plans import merges as M
from fleetmart.plans.mapping import Mapping, apply_mapping, derive, ensure_fields
from fleetmart.sources.sinks import publish


def harmonise(df: DataFrame, mapping: Mapping, upload_date: str) -> DataFrame:
    return apply_mapping(canonical_header(df), mapping, upload_date)


def completed(df: DataFrame, mapping: Mapping) -> DataFrame:
    """Event key, defaults for optional and missing fields, then the derived columns."""
    keyed = df
    if mapping.join_keys:
        keyed = df.withColumn("event_openid", composite_key(mapping.code, mapping.join_keys)).withColumn("event_key", F.col("event_openid"))
    return derive(ensure_fields(keyed, mapping), mapping)


def flight_events(sources: MappingABC[str, DataFrame], mapping: Mapping, upload_date: str, how: str = "inner") -> DataFrame:
    """Flights and their recordings as one wide event table."""
    flights, burned = (harmonise(sources[n], mapping, upload_date) for n in ("flight_data", "fuelburn_data"))
    return completed(M.flights_with_recordings(flights, burned, how), mapping)


def ship_events(sources: MappingABC[str, DataFrame], mapping: Mapping, upload_date: str, as_of: str, merged: DataFrame | None = None) -> DataFrame:
    """Ship reports with their crew (or a supplier's own merge) as one wide event table."""
    if merged is None:
        reports, crew = (canonical_header(sources[n]) for n in ("reports", "crew_data"))
        merged = M.reports_with_operators(reports, crew, as_of)
    return completed(harmonise(merged, mapping, upload_date), mapping)


def behaviour_table(events: DataFrame, mapping: Mapping, filters: MappingABC[str, Sequence[MappingABC]] | None = None, watch: Observation | None = None, **run_options) -> DataFrame:
    """Events with the results of the mapping's behaviours; doubles become decimals for storage."""
    return doubles_to_decimal(B.run(events, list(mapping.behaviours), filters, watch=watch, **run_options))


def filters_from_config(behaviours: Sequence[MappingABC]) -> dict[str, list[MappingABC]]:
    """{behaviour: exclusions} from a list of {name, acronym, filters: [{field_name, values}]}."""
    return {b["name"]: list(b.get("filters") or ()) for b in behaviours}


def publish_vault(events: DataFrame, layout: MappingABC[str, Sequence[str]], base: str, keys: MappingABC[str, Sequence[str]] | None = None) -> dict[str, str]:
    return publish(events, layout, base, keys)
