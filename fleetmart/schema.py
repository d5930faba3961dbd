"""Types, reason codes and fixed table schemas shared by every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# Declared mapping type -> Spark type.
CANONICAL_TYPES = {
    "string": T.StringType(),
    "date": T.TimestampType(),
    "number": T.DecimalType(18, 5),
    "boolean": T.BooleanType(),
}

# Reason codes, in the order they are documented.
FAULTY_DATA = [
    "FAULTY_DATA__MISSING_REQUIRED_VALUES",
    "FAULTY_DATA__MISSING_COMPARISON_VALUES",
    "FAULTY_DATA__OUTLIER_VALUES",
    "FAULTY_DATA__INVALID_ROLLOUT",
    "FAULTY_DATA__INVALID_FUEL_TANK",
    "FAULTY_DATA__INVALID_TAXI_FUEL",
    "FAULTY_DATA__INVALID_TOW",
    "FAULTY_DATA__INVALID_AIRBORNE_TIME",
    "FAULTY_DATA__INVALID_FUEL_FLOW",
    "FAULTY_DATA__INVALID_FUEL_REPORT",
    "FAULTY_DATA__INVALID_SPEED",
    "FAULTY_DATA__INVALID_SFOC",
    "FAULTY_DATA__INVALID_DFOC",
    "FAULTY_DATA__INVALID_DELTA_SFOC",
    "FAULTY_DATA__INVALID_RUNNING_HOURS",
    "FAULTY_DATA__INVALID_KWHRS",
    "FAULTY_DATA__INVALID_AUX_ENGINES_CONSUMPTION",
    "FAULTY_DATA__INVALID_PROPULSION_CONSUMPTION",
    "FAULTY_DATA__INVALID_GENERATOR_CONSUMPTION",
    "FAULTY_DATA__INVALID_MEAN_DRAFT",
    "FAULTY_DATA__EAEU_NOT_USED",
    "FAULTY_DATA__LOAD_OVER_LIMIT",
    "FAULTY_DATA__EAEU_LOAD_NOT_AVAILABLE",
    "FAULTY_DATA__SFOC_NOT_AVAILABLE",
]
NOT_POSSIBLE = [
    "NOT_POSSIBLE__FILTERED_SETTINGS",
    "NOT_POSSIBLE__COVID_PERIOD",
    "NOT_POSSIBLE__4_ENGINE_VEHICLE",
    "NOT_POSSIBLE__INVALID_LEG",
    "NOT_POSSIBLE__DELAYED_FLIGHT",
    "NOT_POSSIBLE__TANKERED_FLIGHT",
    "NOT_POSSIBLE__UNDER_MIN_COOLDOWN",
    "NOT_POSSIBLE__UNDER_MIN_WARMUP",
    "NOT_POSSIBLE__TAXI_OVER_LIMIT",
    "NOT_POSSIBLE__TAXI_TOO_SHORT",
    "NOT_POSSIBLE__DISCRETIONARY_FUEL_REQUIRED",
    "NOT_POSSIBLE__TRIM_OUT_OF_LIMITS",
    "NOT_POSSIBLE__EAEU_OVER_THRESHOLD",
    "NOT_POSSIBLE__NOT_AT_SEA",
    "NOT_POSSIBLE__VOYAGE_TOO_SHORT",
    "NOT_POSSIBLE__DELAYED_VOYAGE",
    "NOT_POSSIBLE__SPEED_UNDER_MIN",
    "NOT_POSSIBLE__TRIM_NOT_AVAILABLE",
    "NOT_POSSIBLE__BAD_WEATHER",
    "NOT_POSSIBLE__TANK_CLEANING",
    "NOT_POSSIBLE__TRIM_NOT_ACHIEVABLE_WHEN_BALLAST",
    "NOT_POSSIBLE__MANOEUVRE_TIME_OVER_LIMIT",
]


def _listed(code: str, codes: list[str]) -> str:
    if code not in codes:
        raise KeyError(code)
    return code


def faulty(code: str) -> str:
    """Reason for rows whose data cannot be trusted."""
    return _listed(f"FAULTY_DATA__{code}", FAULTY_DATA)


def impossible(code: str) -> str:
    """Reason for rows where the behaviour could not have been performed."""
    return _listed(f"NOT_POSSIBLE__{code}", NOT_POSSIBLE)


def filtered_by(field: str) -> str:
    """Reason for rows excluded by configuration on one field."""
    return f"{impossible('FILTERED_SETTINGS')}__{field.upper()}"


# Ledger of landed files, and the statuses it moves through.
LEDGER = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("filename", "filepath", "format", "status", "etag")]
    + [T.StructField("last_modified", T.TimestampType()), T.StructField("size", T.LongType())]
)
PENDING, INGESTED, ARCHIVED, UNZIP_FAILED = "pending", "ingested", "glacier_file", "failed to unzip"
CORRUPTED = "corrupted records found"
NO_ROWS = "no rows found"
STATUS_LENGTH = 255

# Row tag written by the data-quality operators.
DQ_TAG = T.StructType(
    [
        T.StructField("run_name", T.StringType()),
        T.StructField("run_success", T.BooleanType()),
        T.StructField("run_row_success", T.BooleanType()),
        T.StructField(
            "dq_failure_details",
            T.ArrayType(T.StructType([T.StructField("expectation_type", T.StringType())])),
        ),
    ]
)

CORRUPT_COLUMN = "corrupted_data"
