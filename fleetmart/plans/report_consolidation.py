"""Charter-ship reports consolidated to noon-to-noon rows.

Every report between a ship's first and last noon belongs to the next noon report within 26 hours; reports
with no noon up to midnight two days on form a row of their own, dated one day later. Days without a noon
report use the report closest to 12:00 in its place.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetmart.functions.columns import ratio, weighted_mean
from fleetmart.functions.strings import RESTING_MODES, port_code, report_kind
from fleetmart.operators.aggregates import latest_known
from fleetmart.operators.timeline import DAY, between_marks, top_row, with_context, with_marks_ahead

# Rejected report types, longest report, reach of a noon report, days looked ahead.
REJECTED = ("On Hire (In Port)", "Noon At Sea | Entering Canal | Leaving Canal")
MAX_REPORT_HOURS = 30
NOON_REACH_HOURS = 26
LOOK_AHEAD_DAYS = 2
# Measures that are summed and attributes taken from the latest report.
SUMMED = [
    "aeHours1", "aeHours2", "aeHours3", "aeEnergyProd", "aeEnergyProd2", "aeEnergyProd3", "aeEnergyProd1",
    "meEnergyProd", "boilerHours1", "boilerHours2", "meHours1", "meHours", "meEnergyCons", "brobUlsMgo", "brobVlsHfo",
    "combCons", "dischargeVlsHfoCons", "freshWaterCons", "freshWaterRob", "time", "distance", "distanceBosp",
    "distanceThroughWater", "ulsDoCons", "aeCons", "meCons",
]
LATEST = [
    "load", "position", "eventTypesString", "ballast", "course", "displacement", "distanceToGo", "draftAft",
    "draftFore", "draftMean", "draftMid", "gm", "prevPortUnLocode", "nextPort", "nextPortEta", "nextPortTimeOffset",
    "nextPortUnLocode", "repNextPortEta", "trim", "windDir", "rpm", "rpm1", "meDailyCons", "meLcvDailyCons",
    "orderedSpeed", "voyNum", "airTemp", "atmosphericPress", "operationalMode", "speedInstr",
]
WEIGHTED = {"speedBosp": "meHours1", "windSpeedBf": "meHours1"}
RATIOS = {
    "aeSfoc": ("aeCons", "aeEnergyProd", 1e6), "meSfoc": ("meCons", "meEnergyProd", 1e6), "aePower1": ("aeEnergyProd1", "aeHours1", 1.0),
    "aePower2": ("aeEnergyProd2", "aeHours2", 1.0), "aePower3": ("aeEnergyProd3", "aeHours3", 1.0), "mePower": ("meEnergyProd", "meHours", 1.0),
}


def is_noon(c: str = "eventTypesString"):
    return F.col(c).contains("Noon")


def usable_reports(reports: DataFrame, order: Sequence[str], rejected: Sequence[str] = REJECTED) -> DataFrame:
    """Reports from first to last noon of their ship, without rejected types and over-long ones."""
    window = between_marks(reports, ["imo"], order, is_noon())
    return window.filter(~F.col("eventTypesString").isin(*rejected) & (F.col("time") <= MAX_REPORT_HOURS))


def stand_in_noons(reports: DataFrame, order: Sequence[str], modes: Sequence[str] = RESTING_MODES) -> DataFrame:
    """Add ``report_type``: on days without a noon report, the report nearest to 12:00 is renamed to one.

    A window over one ship-day, so its size is that of a day's reports of one ship.
    """
    day = Window.partitionBy("imo", F.to_date("date"))
    near = day.orderBy(F.abs(F.hour("date") - 12), *order)
    ranked = reports.withColumns({"_any": F.max(is_noon()).over(day), "_near": F.row_number().over(near)})
    renamed = F.when(~F.col("_any") & (F.col("_near") == 1), report_kind(F.col("eventTypesString"), modes))
    return ranked.withColumn("report_type", F.coalesce(renamed, F.col("eventTypesString"))).drop("_any", "_near")


def with_noon(reports: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``noon_date`` and ``noon_type`` of the noon report each row belongs to.

    Each row takes the next noon on its own stretch of the time line, in one pass over the reports.
    """
    marked = reports.withColumn("_noon", is_noon("report_type"))
    seen = with_marks_ahead(
        marked, ["imo"], "date", F.col("_noon"), (LOOK_AHEAD_DAYS + 1) * DAY, 4 * DAY, ["date", "report_type"], ["report_type"]
    ).withColumnRenamed("_mark", "_next")

    gap = F.unix_seconds(F.col("_next.date")) - F.unix_seconds("date")
    belongs = F.col("_noon") | (gap <= NOON_REACH_HOURS * 3600)
    alone = F.col("_next").isNull() | (F.col("_next.date") > F.date_add(F.to_date("date"), LOOK_AHEAD_DAYS).cast("timestamp"))
    own_day = F.date_add(F.to_date("date"), 1).cast("timestamp")
    return (
        seen.withColumns(
            {
                "noon_date": F.when(F.col("_noon"), F.col("date")).when(belongs, F.col("_next.date")).when(alone, own_day),
                "noon_type": F.when(F.col("_noon"), F.col("report_type")).when(belongs, F.col("_next.report_type")).when(alone, F.col("report_type")),
            }
        )
        .filter(F.col("noon_date").isNotNull())
        .drop("_noon", "_next")
    )


def summarise(reports: DataFrame, order: Sequence[str], summed: Sequence[str] = SUMMED, latest: Sequence[str] = LATEST, weighted: Mapping[str, str] = WEIGHTED, modes: Sequence[str] = RESTING_MODES) -> DataFrame:
    """One row per (ship, noon): sums and weighted means of the sailing reports, manoeuvring hours of the
    others, and the latest known attributes of all - in one map-side-combined aggregation."""
    have = set(reports.columns)
    sailing = F.col("operationalMode").isin(*modes)
    only = lambda c: F.when(sailing, F.col(c))
    sums = [F.sum(only(c)).alias(c) for c in summed if c in have]
    means = [weighted_mean(only(c), only(w)).alias(c) for c, w in weighted.items() if {c, w} <= have]
    manoeuvring = F.sum(F.when(~sailing, F.col("time"))).alias("manoeuvring_hours")
    taken = latest_known([c for c in latest if c in have and c not in summed and c not in weighted], order)
    return reports.groupBy("imo", "noon_date", "noon_type").agg(
        F.count_if(sailing).alias("_sailing"), *sums, *means, manoeuvring, *taken
    ).filter(F.col("_sailing") > 0).drop("_sailing")


def with_ports(days: DataFrame, width: int = 32 * DAY) -> DataFrame:
    """Port codes from the position text of port reports; at the end of passage, the previous next port."""
    if not {"position", "prevPortUnLocode", "nextPortUnLocode"} <= set(days.columns):
        return days
    in_port, code = F.col("noon_type").contains("Port"), port_code(F.col("position"))
    named = days.withColumns({c: F.when(in_port, code).otherwise(F.col(c)) for c in ("prevPortUnLocode", "nextPortUnLocode")})
    lagged = with_context(named, ["imo"], ["noon_date", "noon_type"], lag={"_prev": "nextPortUnLocode"}, width=width, computed=True)
    arriving = (F.col("noon_type") == "Noon At Sea") & F.col("position").startswith("EOSP")
    return lagged.withColumn("nextPortUnLocode", F.when(arriving, F.col("_prev")).otherwise(F.col("nextPortUnLocode"))).drop("_prev")


def with_ratios(days: DataFrame) -> DataFrame:
    """Specific consumption and power; NULL where the divisor is zero."""
    have = set(days.columns)
    return days.withColumns({o: ratio(F.col(a) * f, F.col(b)) for o, (a, b, f) in RATIOS.items() if {a, b} <= have})


def consolidate(reports: DataFrame, tie: Sequence[str], **columns) -> DataFrame:
    """The whole pipeline. ``reports.date`` is a timestamp; ``tie`` orders reports of the same moment."""
    order = ["date", *tie]
    noons = with_noon(stand_in_noons(usable_reports(reports, order), order), order)
    return with_ratios(with_ports(summarise(noons, order, **columns)))


def latest_report(days: DataFrame) -> DataFrame:
    """Only the newest consolidated row of each ship."""
    return top_row(days, ["imo"], ["noon_date", "noon_type"])
