"""Hourly generator counters to one power-management row per ship and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.functions.columns import any_of, ratio, total
from fleetmart.operators.behaviours.maritime import ETA, full_use, running
from fleetmart.operators.joins import checked_broadcast, lookup
from fleetmart.operators.project import union_with_defaults
from fleetmart.operators.timeline import DAY, with_context

GENERATORS = (1, 2, 3, 4)
# Engine figures per vessel type (max load, min load, constant) and lower use threshold.
VESSEL_TYPES = {
    "vessel_type_1": ([(1400, 110, 0.8)] * 4, 0.80),
    "vessel_type_2": ([(2430, 350, 0.8)] + [(3645, 350, 0.8)] * 3, 0.90),
    "vessel_type_3": ([(1055, 120, 0.8)] * 4, 0.80),
}
# Share of available power that counts as well matched, hours a day needs, hours allowed above.
MATCHED_SHARE, MIN_HOURS, SPARE_HOURS = 0.20, 10, 3
DAY_FIGURES = ("total_hours", "total_good_hours", "overproduced_hours", "epm_success", "epm_fuel_saved", "epm_best_fuel_saved")


def engine_rows(types: dict = VESSEL_TYPES) -> list[tuple]:
    return [(name, *[float(x) for e in engines for x in e], lower) for name, (engines, lower) in types.items()]


def engine_dimension(spark, types: dict = VESSEL_TYPES) -> DataFrame:
    """(vessel_type, max_load1, min_load1, const1, ..., aeu_lower_threshold), one row per type."""
    cols = ", ".join(f"max_load{i} double, min_load{i} double, const{i} double" for i in GENERATORS)
    dim = spark.createDataFrame(engine_rows(types), f"vessel_type string, {cols}, aeu_lower_threshold double")
    return F.broadcast(dim)  # one row per vessel type, listed above


def hourly_use(counters: DataFrame, engines: DataFrame, ship: str = "ship", ts: str = "ts", tie: Sequence[str] = (), engine_key: str = "vessel_type", width: int = DAY) -> DataFrame:
    """Hours with running time per generator, use of the engines, and the fuel it saved or could have.

    ``counters``: ship, ts, ``rh1..4`` (cumulative running hours), ``kwh1..4``, ``fuel_flow``,
    ``available_power`` and the engine key. Hours that cannot be judged are left out.
    """
    order = [ts, *tie]
    prev = with_context(counters, [ship], order, lag={f"_p{i}": f"rh{i}" for i in GENERATORS}, width=width)
    ran = prev.withColumns({f"gen{i}_rh": F.round(F.col(f"rh{i}") - F.col(f"_p{i}"), 1) for i in GENERATORS}).drop(*[f"_p{i}" for i in GENERATORS])
    used = ran.withColumns({f"kwh{i}": F.when(F.col(f"gen{i}_rh") == 0, 0.0).otherwise(F.col(f"kwh{i}")) for i in GENERATORS})
    known = lookup(used, engines, F.col(engine_key), engine_key, required=True)

    rh, kwh = ([F.col(c.format(i)) for i in GENERATORS] for c in ("gen{}_rh", "kwh{}"))
    top, const = ([F.col(c.format(i)) for i in GENERATORS] for c in ("max_load{}", "const{}"))
    mcr = [c * m for c, m in zip(const, top)]
    staged = known.withColumns(
        {
            "_demand": total(m * ratio(k, t) * h for m, k, t, h in zip(mcr, kwh, top, rh)) / ETA,
            "_room": total(c * m * h for c, m, h in zip(const, mcr, rh)),
            "total_power": total(kwh),
            "_hours": total(rh),
            "_count": running(rh),
        }
    )
    share = ratio(F.col("_demand"), F.col("_room"))
    full = full_use(F.col("_count"), F.col("_demand"), top, const[0], F.lit(24.0))
    judged = staged.withColumns(
        {
            "aeu": F.when(full | (share >= 1), 1.0).otherwise(F.round(share, 3)),
            "ap_share": F.round(ratio(F.col("available_power"), F.col("total_power") + F.col("available_power")), 3),
            "_skip": F.coalesce(
                any_of([k > t for k, t in zip(kwh, top)] + [F.col("_hours") == 0, (F.col("total_power") == 0) & (F.col("_hours") > 0)]),
                F.lit(False),
            ),
        }
    )
    lower = F.col("aeu_lower_threshold")
    return (
        judged.filter(~F.col("_skip"))
        .withColumns(
            {
                "correct": F.coalesce((F.col("ap_share") <= MATCHED_SHARE) | (F.col("aeu") == 1), F.lit(False)).cast("int"),
                "fuel_saving": (F.col("aeu") - lower) * F.col("fuel_flow"),
                "best_fuel_saving": (1 - lower) * F.col("fuel_flow"),
            }
        )
        .drop("_demand", "_room", "_hours", "_count", "_skip")
    )


def power_management_days(hours: DataFrame, ship: str = "ship", ts: str = "ts") -> DataFrame:
    """Daily figures straight from the hours, without a pivot. Several rows of one clock hour count once,
    by the earliest of them."""
    day, hour = F.to_date(F.col(ts)).alias("report_date"), F.hour(F.col(ts)).alias("_hour")
    rank = F.struct(F.col(ts), *[F.col(c) for c in ("correct", "fuel_saving", "best_fuel_saving")])
    figures = F.struct("correct", "fuel_saving", "best_fuel_saving")
    once = hours.groupBy(ship, day, hour, "aeu_lower_threshold").agg(F.min_by(figures, rank).alias("_f"))
    daily = once.groupBy(ship, "report_date", "aeu_lower_threshold").agg(
        F.count(F.lit(1)).alias("total_hours"),
        F.sum("_f.correct").alias("total_good_hours"),
        (F.count(F.lit(1)) - F.sum("_f.correct")).alias("overproduced_hours"),
        F.coalesce(F.sum("_f.fuel_saving"), F.lit(0.0)).alias("epm_fuel_saved"),
        F.coalesce(F.sum("_f.best_fuel_saving"), F.lit(0.0)).alias("epm_best_fuel_saved"),
    )
    kept = daily.filter(F.col("total_hours") >= MIN_HOURS)
    return kept.withColumn("epm_success", (F.col("overproduced_hours") <= SPARE_HOURS).cast("int"))


def generator_days(counters: DataFrame, engines: DataFrame, ship: str = "ship", ts: str = "ts", tie: Sequence[str] = (), engine_key: str = "vessel_type") -> DataFrame:
    """Daily rows of ships with known engines, plus one zero row per (ship, day) of the others."""
    days = power_management_days(hourly_use(counters, engines, ship, ts, tie, engine_key), ship, ts)
    listed = checked_broadcast(engines.select(F.upper(F.col(engine_key)).alias("_k")))
    others = counters.withColumn("_k", F.upper(F.col(engine_key))).join(listed, "_k", "left_anti")
    others = others.select(F.col(ship), F.to_date(F.col(ts)).alias("report_date")).distinct()
    return union_with_defaults(days, others, {"aeu_lower_threshold": 0, **{c: 0 for c in DAY_FIGURES}})

