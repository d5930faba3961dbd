"""Mapping-driven harmonisation: source columns to canonical, typed fields."""

from __future__ import annotations

import json
from collections.abc import Mapping as MappingABC
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.functions import dates as D
from fleetmart.functions import strings as St
from fleetmart.functions.registry import apply_formulas
from fleetmart.operators.project import quoted
from fleetmart.schema import CANONICAL_TYPES

import fleetmart.functions.formulas  # noqa: F401  (registers the built-in formulas)


@dataclass(frozen=True)
class Field:
    """One canonical field: its aliases in the sources, type, guard pattern, default and derivation."""

    name: str
    type: str = "string"
    options: Sequence[str] = ()
    regexp: str | None = None
    default: object = None
    formula: str | None = None
    state: MappingABC = field(default_factory=dict)
    expr: str | None = None
    required: bool = False
    satellite: str | None = None

    @property
    def spark_type(self):
        return CANONICAL_TYPES[self.type]

    def blank(self) -> Column:
        return F.lit(self.default).try_cast(self.spark_type) if self.default is not None else F.lit(None).cast(self.spark_type)


@dataclass(frozen=True)
class Mapping:
    code: str
    fields: Sequence[Field]
    join_keys: Sequence[str] = ()
    behaviours: Sequence[str] = ()
    event: str = "Flight"
    domain: str = "aviation"

    @classmethod
    def from_json(cls, text: str, code: str, domain: str = "aviation", event: str = "Flight") -> Mapping:
        """Read the first document form ({dataMappings: {csvFields: [...]}})."""
        doc = json.loads(text)
        fields = [
            Field(
                f["name"], f["type"], tuple(f.get("options") or ()), f.get("regexp"), f.get("default_value"), f.get("formula"), f.get("state") or {},
                required=bool(f.get("required")),
            )
            for f in doc["dataMappings"]["csvFields"]
        ]
        return cls(code, fields, tuple(doc.get("join_keys", ())), tuple(doc.get("calculableBehaviours", ())), event, domain)

    @classmethod
    def from_table_json(cls, text: str, table: str, code: str, domain: str = "aviation") -> Mapping:
        """Read one table of the second document form ({bronzeTables: {table: {fieldMappings: [...]}}})."""
        rows = json.loads(text)["bronzeTables"][table]["fieldMappings"]
        fields = [
            Field(
                f["name"], f.get("type", "string"), tuple(f.get("rawOptions") or ()), state=f.get("localState") or {},
                expr=f.get("formula"), satellite=f.get("outputSatellite"),
            )
            for f in rows
        ]
        return cls(code, fields, domain=domain)


def source_of(f: Field, columns: Sequence[str]) -> str | None:
    """First alias (then the field's own name) that the source has."""
    return next((o for o in [*f.options, f.name] if o in columns), None)


def harmonised(f: Field, raw: Column) -> Column:
    """Guard, type and clean one field."""
    if f.type == "date":
        # a timestamp stays one; anything else is parsed from text
        typed = D.normalised(raw.cast("string"))
    elif f.type == "string" and "operator_id" in f.name:
        typed = St.strip_leading_zeros(St.squeeze_blanks(F.coalesce(raw.cast("string"), F.lit(""))))
    else:
        typed = raw.try_cast(f.spark_type)
    if f.regexp is None:
        return typed
    blank = f.blank()
    return F.when(raw.cast("string").rlike(f.regexp), typed).otherwise(blank.cast("string") if f.type == "date" else blank)


def apply_mapping(df: DataFrame, mapping: Mapping, upload_date: str) -> DataFrame:
    """Rename, type and clean all mapped fields in one projection; unmapped columns stay as they are."""
    picked = {f.name: (f, src) for f in mapping.fields if (src := source_of(f, df.columns)) is not None}
    used = {src for _, src in picked.values()}
    tags = {"event_id": F.lit(mapping.event), "dds_code": F.lit(mapping.code), "upload_date": F.lit(upload_date)}
    kept = [c for c in df.columns if c not in used and c not in picked and c not in tags]
    return df.select(
        *[quoted(c) for c in kept],
        *[harmonised(f, quoted(src)).alias(n) for n, (f, src) in picked.items() if n not in tags],
        *[c.alias(n) for n, c in tags.items()],
    )


def apply_expressions(df: DataFrame, mapping: Mapping) -> DataFrame:
    """Second form: pick each field from its aliases, then run its SQL expression over the picked columns."""
    picked = df.select(*[
        (quoted(src).try_cast(f.spark_type) if (src := source_of(f, df.columns)) else f.blank()).alias(f.name) for f in mapping.fields
    ])
    return picked.select(*[F.expr(f.expr).try_cast(f.spark_type).alias(f.name) if f.expr else F.col(f.name) for f in mapping.fields])


def by_satellite(mapping: Mapping) -> dict[str, list[str]]:
    """Field names per target satellite."""
    out: dict[str, list[str]] = {}
    for f in mapping.fields:
        if f.satellite:
            out.setdefault(f.satellite, []).append(f.name)
    return out


def ensure_fields(df: DataFrame, mapping: Mapping, only_optional: bool = False) -> DataFrame:
    """Add the canonical fields the frame lacks, as typed default or NULL."""
    absent = [f for f in mapping.fields if f.name not in df.columns and not (only_optional and f.options)]
    return df.withColumns({f.name: f.blank() for f in absent}) if absent else df


def derive(df: DataFrame, mapping: Mapping) -> DataFrame:
    """Run the formulas the mapping asks for; rows whose required field stays NULL are left out (for tankers,
    ships whose vessel type is not listed)."""
    wanted = [f for f in mapping.fields if f.formula]
    out = apply_formulas(
        df, [f.name for f in wanted], mapping.domain, {f.name: f.state for f in wanted}, {f.name: f.spark_type for f in wanted}
    )
    needed = [f.name for f in wanted if f.required or (mapping.domain, f.name) == ("tanker", "vessel_type")]
    return out.dropna(subset=needed) if needed else out
