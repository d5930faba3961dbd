"""Supplier merges: which sources become one event table, and how."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.functions.strings import digits_only, person_key, spoken_name, title_words
from fleetmart.operators.joins import interval_join, role_columns, two_role_join
from fleetmart.operators.settle import settle
from fleetmart.operators.timeline import asof_nearest, nearest_only, top_row

# How far apart a flight and its recording may start, and the columns renamed on the way.
FLIGHT_TOLERANCE = 3_600
TAKEN_WITH_PREFIX = [
    "sourcefilename", "filepath", "upload_date", "ingestiondatetime", "taxi_out_minutes_measurement",
    "taxi_in_minutes_measurement", "origin", "destination", "identifier", "ingestionjobrunid",
]
NOT_TAKEN = ("status", "event_id", "customer_code", "aircraft_reg_code", "ocurrence_datetime")
SOURCE_PREFIXED = ("sourcefilename", "filepath", "upload_date", "ingestiondatetime")
ROLES = {
    "master": {"crew__captain": "full_name", "crew__captainDBN": "discharge_book_number"},
    "chief engineer": {"crew__chiefEngineer": "full_name", "crew__chiefEngineerDBN": "discharge_book_number"},
}
TECHNICAL = ("event_id", "file_path", "ingestion_datetime", "ingestion_job_run_id", "status", "upload_date")


def flights_with_recordings(flights: DataFrame, recordings: DataFrame, how: str = "inner", suppress_neighbours: bool = False) -> DataFrame:
    """Each flight with the recording of the same aircraft nearest to it in time, one row per flight.

    ``suppress_neighbours`` also drops a match when another flight of the aircraft within half an hour has a
    closer one.
    """
    key, ts = "aircraft_reg_code", "ocurrence_datetime"
    left = flights.withColumnsRenamed({c: f"source_{c}" for c in SOURCE_PREFIXED if c in flights.columns})
    left = top_row(left.withColumn(ts, F.col(ts).cast("timestamp")), [ts, key], [c for c in left.columns if c not in (ts, key)] or [ts], latest=False)
    right = recordings.withColumn(ts, F.col(ts).cast("timestamp"))
    take = {
        (f"target_{c}" if c in TAKEN_WITH_PREFIX or c in left.columns else c): c for c in right.columns if c not in NOT_TAKEN
    } | {"target_ocurrence_datetime": ts}
    tie = sorted(c for c in right.columns if c not in (key, ts))
    out = asof_nearest(left, right, [key], ts, ts, FLIGHT_TOLERANCE, take, tie or [ts], how)
    if suppress_neighbours:
        out = nearest_only(out, [key], ts)
    if "customer_code" in out.columns:
        out = out.withColumn("customer_code_upper", F.upper("customer_code"))
    stamp = digits_only(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    kept = out.withColumn("ocurrence_datetime_numeric", stamp)
    return kept.select(*[c for c in kept.columns if not c.endswith("_y")])


def reports_with_crew(reports: DataFrame, rotation: DataFrame, open_end: str, latest_only: bool = True) -> DataFrame:
    """Ship reports with the captain and chief engineer on board that day.

    ``reports``: imo, date (date), captain, chiefEngineer, ...; ``rotation``: imo, firstname, lastname, rank,
    start_date, end_date, discharge_book_number. Reports lacking date or either name are not events.
    """
    named = reports.dropna(subset=["date", "captain", "chiefEngineer"]).withColumns(
        {"captain": spoken_name(F.col("captain")), "chiefEngineer": spoken_name(F.col("chiefEngineer")), "date": F.to_date("date")}
    )
    rest = [c for c in named.columns if c not in ("imo", "date")]
    daily = top_row(named, ["imo", "date"], rest, latest=False)
    if latest_only:
        daily = top_row(daily, ["imo"], ["date"])
    daily = settle(daily)
    crew = rotation.select(
        "imo", F.lower("rank").alias("rank"), F.to_date("start_date").alias("start_date"), F.to_date("end_date").alias("end_date"),
        person_key(F.col("firstname"), F.col("lastname")).alias("full_name"), "discharge_book_number",
    )
    bounds = daily.agg(F.min("date").cast("string"), F.max("date").cast("string")).first()
    on_board = interval_join(daily.select("imo", "date"), crew, "imo", "date", "start_date", "end_date", open_end, clip=tuple(bounds) if bounds[0] else None)
    roles = role_columns(on_board, ["imo", "date"], "rank", ["start_date", "full_name", "discharge_book_number"], ROLES)
    out = daily.join(roles, ["imo", "date"], "left")
    return out.withColumns(
        {
            "reported__captain": title_words(F.col("captain")),
            "reported__chiefEngineer": title_words(F.col("chiefEngineer")),
            "captain__status": F.lit(None).cast("string"),
            "chiefEngineer__status": F.lit(None).cast("string"),
        }
    )


def reports_with_operators(reports: DataFrame, crew: DataFrame, as_of: str, both_required: bool = False) -> DataFrame:
    """Default ship merge: both operators of a report from the crew list."""
    return two_role_join(
        reports.drop(*TECHNICAL),
        crew.drop(*TECHNICAL).withColumnRenamed("source_file_name", "crew_source_file_name"),
        ("operator_id", "operator_id2"), "operator_id", "report_date_utc", as_of, ("Captain", "Chief Engineer"),
        "discharge_book_number", both_required,
    )


