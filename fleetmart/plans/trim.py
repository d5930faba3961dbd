"""Trim percentages of tanker reports, for the optimal-trim behaviour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.operators.interpolate import TRIM_LIMITS, grid_cells, grid_power, ideal_trim, trim_limit_rows
from fleetmart.operators.joins import lookup

SPEED_CAP = 15.0  # fixed value: the tables are read at no more than this speed


def with_trim_percentages(reports: DataFrame, grid: DataFrame, limits: DataFrame | None = None, ideal: bool = True) -> DataFrame:
    """Add ``trim_perc_limit``, ``trim_perc_actual`` and ``trim_ideal`` (NULL where no table applies).

    ``limits`` (imo, ship_class, trim_perc_limit) defaults to the fixed list; ``grid`` holds
    (ship_class, draft, speed, trim, power). The behaviour itself needs no ``trim_ideal``.
    """
    if limits is None:
        rows = trim_limit_rows(TRIM_LIMITS)
        limits = F.broadcast(reports.sparkSession.createDataFrame(rows, "imo string, ship_class string, trim_perc_limit double"))
    known = lookup(reports, limits, F.col("imo").cast("string"), "imo", ignore_case=False)
    number = lambda c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))
    speed = F.least(number("speedthroughwatermehrs"), F.lit(SPEED_CAP))
    cells = grid_cells(grid, "ship_class")
    out = grid_power(known, cells, "ship_class", number("meandraft"), speed, F.col("trim").try_cast("double"), "trim_perc_actual")
    return ideal_trim(out, cells, "ship_class", number("meandraft"), speed) if ideal else out
