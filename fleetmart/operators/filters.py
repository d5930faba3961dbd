"""Row splits decided at file level, and exclusion predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart import schema as S
from fleetmart.operators.joins import fact_join
from fleetmart.operators.settle import settle


def bad_files(df: DataFrame, corrupt: Column, file_column: str = "file_path") -> DataFrame:
    """Files with at least one corrupt row (distinct on the map side first)."""
    return df.filter(corrupt).select(file_column).distinct()


def quarantine_split(df: DataFrame, corrupt: Column | None = None, file_column: str = "file_path") -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined): one corrupt row sends every row of its file to quarantine."""
    corrupt = F.col(S.CORRUPT_COLUMN).isNotNull() if corrupt is None else corrupt
    bad = settle(bad_files(df, corrupt, file_column))
    return fact_join(df, bad, [file_column], "left_anti"), fact_join(df, bad, [file_column], "left_semi")


def quarantine_flag(df: DataFrame, corrupt: Column, file_column: str, out: str = "quarantined") -> DataFrame:
    """Both halves in one frame, told apart by a flag."""
    bad = bad_files(df, corrupt, file_column).withColumn(out, F.lit(True))
    return fact_join(df, bad, [file_column], "left", computed=True).withColumn(out, F.coalesce(F.col(out), F.lit(False)))


def exclusion_cases(df: DataFrame, exclusions: Sequence[Mapping]) -> list[tuple[str, Column]]:
    """Reason cases for configured exclusions ({field_name, values}) on the fields that exist."""
    return [
        (S.filtered_by(e["field_name"]), F.col(e["field_name"]).isin(list(e["values"])))
        for e in exclusions
        if e["field_name"] in df.columns
    ]


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail early when nothing is left to work on (reads at most one row)."""
    if df.isEmpty():
        raise ValueError(f"no rows left: {what}")
    return df
