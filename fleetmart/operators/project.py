"""Schema operators: renames, casts and constant columns, each one a single ``select``."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.functions.columns import identity
from fleetmart.functions.strings import decode_path, strip_scheme

# Characters replaced by an underscore in column names.
AWKWARD = ".;,(){}"


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def trim_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def sanitise_names(df: DataFrame, replace: Mapping[str, Iterable[str]] | None = None) -> DataFrame:
    """Replace listed characters in column names; keys are the replacements."""
    replace = {"_": AWKWARD} if replace is None else replace
    table = str.maketrans({ch: new for new, chars in replace.items() for ch in chars})
    return df.toDF(*[c.translate(table) for c in df.columns])


def unique_names(names: Sequence[str]) -> list[str]:
    """Number repeated names (x, x_1, x_2), never colliding with a name already present."""
    taken = set(names)
    seen: dict[str, int] = {}
    out = []
    for n in names:
        if n not in seen:
            seen[n] = 0
            out.append(n)
            continue
        while True:
            seen[n] += 1
            candidate = f"{n}_{seen[n]}"
            if candidate not in taken:
                break
        taken.add(candidate)
        out.append(candidate)
    return out


def canonical_name(name: str) -> str:
    """Lower case, blanks to underscores, everything but letters, digits and underscores dropped."""
    return re.sub(r"[^a-z0-9_]", "", re.sub(r"\s+", "_", name.strip().lower()))


def canonical_header(df: DataFrame) -> DataFrame:
    return df.toDF(*unique_names([canonical_name(c) for c in df.columns]))


def blanks_to_underscores(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def prefix_names(df: DataFrame, prefix: str, keep: Iterable[str] = ()) -> DataFrame:
    kept = set(keep)
    return df.toDF(*[c if c in kept else prefix + c for c in df.columns])


def columns_first(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """Given columns in front (min/max statistics are kept for leading columns), the rest in order."""
    lead = [c for c in first if c in df.columns]
    return df.select(*[quoted(c) for c in lead], *[quoted(c) for c in df.columns if c not in set(lead)])


def cast_where(df: DataFrame, kind: type[T.DataType], to: T.DataType | str) -> DataFrame:
    return df.select(
        *[quoted(f.name).try_cast(to).alias(f.name) if isinstance(f.dataType, kind) else quoted(f.name) for f in df.schema]
    )


def all_to_string(df: DataFrame) -> DataFrame:
    return cast_where(df, T.DataType, "string")


def doubles_to_decimal(df: DataFrame, precision: int = 18, scale: int = 5) -> DataFrame:
    return cast_where(df, T.DoubleType, T.DecimalType(precision, scale))


def structs_to_json(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.to_json(quoted(f.name)).alias(f.name) if isinstance(f.dataType, T.StructType) else quoted(f.name) for f in df.schema]
    )


def expand_struct(df: DataFrame, name: str) -> DataFrame:
    """Replace a struct column by its fields."""
    return df.select(*[quoted(c) for c in df.columns if c != name], f"`{name}`.*")


def without_suffix(df: DataFrame, pattern: str) -> DataFrame:
    """Drop the columns whose name ends in ``pattern``."""
    rx = re.compile(f"(?:{pattern})$")
    return df.select(*[quoted(c) for c in df.columns if not rx.search(c)])


def composite_key(prefix: str, keys: Sequence[str]) -> Column:
    return F.concat(F.lit(f"{prefix.upper()}_"), F.concat_ws("_", *[F.col(k) for k in keys]))


def stable_id(keys: Sequence[str]) -> Column:
    """Surrogate id that a rerun reproduces."""
    return identity(*[F.col(k) for k in keys])


def file_metadata(run_id: str, ingested_at: str, name: Column | None = None, path: Column | None = None) -> dict[str, Column]:
    """Columns that trace a row to its file; by default taken from the reader's hidden metadata."""
    name = F.col("_metadata.file_name") if name is None else name
    path = F.col("_metadata.file_path") if path is None else path
    return {
        "source_file_name": name,
        "status": F.lit("incomplete"),
        "ingestion_datetime": F.lit(ingested_at).cast("timestamp"),
        "ingestion_job_run_id": F.lit(run_id),
        "file_path": strip_scheme(decode_path(path)),
    }


def decorate(df: DataFrame, run_id: str, ingested_at: str, **where: Column) -> DataFrame:
    return df.select("*", *[c.alias(n) for n, c in file_metadata(run_id, ingested_at, **where).items()])


def union_by_name(frames: Sequence[DataFrame], ordered: bool = False) -> DataFrame:
    """Union with NULL for columns a frame lacks; optionally with columns in name order."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.select(*[quoted(c) for c in sorted(out.columns)]) if ordered else out


def union_with_defaults(main: DataFrame, others: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Append pass-through rows to calculated rows; calculated columns take their default."""
    types = {f.name: f.dataType for f in main.schema}
    cols = [
        F.lit(defaults[c]).cast(types[c]).alias(c) if c in defaults
        else (quoted(c).cast(types[c]).alias(c) if c in others.columns else F.lit(None).cast(types[c]).alias(c))
        for c in main.columns
    ]
    return main.unionByName(others.select(*cols))
