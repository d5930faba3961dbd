"""Hub / link / satellite projection and the one-big-table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.operators.joins import hashed
from fleetmart.operators.project import union_by_name


def resolve(df: DataFrame, columns: Iterable[str]) -> dict[str, str]:
    """Table column -> frame column, matched without regard to case."""
    by_name = {c.lower(): c for c in df.columns}
    return {c: by_name[c.lower()] for c in columns if c.lower() in by_name}


def project(df: DataFrame, columns: Sequence[str], fill_missing: bool = False) -> DataFrame:
    """The listed columns; absent ones are left out, or NULL with ``fill_missing``."""
    found = resolve(df, columns)
    return df.select(
        *[F.col(f"`{found[c]}`").alias(c) if c in found else F.lit(None).cast("string").alias(c)
          for c in dict.fromkeys(columns) if c in found or fill_missing]
    )


def distinct_by_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by all other columns, so reruns agree. Combines on the map side."""
    rest = [c for c in df.columns if c not in set(key)]
    if not rest:
        return df.dropDuplicates(list(key))
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    return df.groupBy(*key).agg(F.min(row).alias("_row")).select(*[F.col(c) if c in set(key) else F.col("_row")[c].alias(c) for c in df.columns])


def tables(df: DataFrame, layout: Mapping[str, Sequence[str]], keys: Mapping[str, Sequence[str]] | None = None) -> dict[str, DataFrame]:
    """All tables of a layout. Hubs and links are made distinct by their key: from ``keys``, else as the layout
    declares it. A hub's is its first column otherwise; a link has no such default, as it would lose rows."""
    declared = {**getattr(layout, "keys_of", {}), **(keys or {})}
    out = {}
    for name, columns in layout.items():
        t = project(df, columns)
        if not t.columns:
            continue
        kind = name.split("_")[0]
        if kind in ("HUB", "LINK"):
            key = list(resolve(t, declared[name])) if name in declared else t.columns[:1]
            if kind == "LINK" and name not in declared:
                raise ValueError(f"{name}: a link needs a declared key")
            t = distinct_by_key(t, [c for c in t.columns if c.lower() in {k.lower() for k in key}])
        out[name] = t
    return out


def of_keys(satellite: DataFrame, hub: DataFrame, key: str) -> DataFrame:
    """Satellite rows whose key is in the hub or link. The hub's size is checked: give a written one, not a long computation."""
    return satellite.join(hashed(hub.select(key)), key, "left_semi")


def stacked(satellites: Mapping[str, DataFrame], hub: DataFrame, key: str) -> DataFrame:
    """Satellite rows of a hub, as :func:`of_keys` has them, in one frame: columns by name, the satellite's name as a tag."""
    keys = hashed(hub.select(key))
    return union_by_name([s.join(keys, key, "left_semi").withColumn("satellite", F.lit(n)) for n, s in satellites.items()])


def latest_by_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the last by ``order``, of equal ones the largest by all columns. Combines on the map side."""
    rest = [c for c in df.columns if c != key]
    rank = F.struct(*[F.col(f"`{c}`") for c in [*order, *rest]])
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    return df.groupBy(key).agg(F.max_by(row, rank).alias("_row")).select(key, *[F.col("_row")[c].alias(c) for c in rest])


def one_big_table(entity: DataFrame, satellites: Mapping[str, DataFrame], key: str, order: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Hub or link with its satellites' columns at its side, one row for each of its own: a satellite gives the last
    row of the key by its ``order`` ({satellite: columns}; default: all its columns). Repeated column names
    are taken once, from the left. All rows of several satellites are what :func:`stacked` gives."""
    out = entity
    for name, s in satellites.items():
        fresh = [c for c in s.columns if c == key or c not in set(out.columns)]
        out = out.join(latest_by_key(s, key, (order or {}).get(name, ())).select(*fresh), key, "left")
    return out


def obt_of_link(link: DataFrame, hubs: Mapping[str, DataFrame], satellites: Mapping[str, DataFrame], key: str, order: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Link rows with the columns of the hubs they connect and of those hubs' satellites."""
    return one_big_table(link, {**hubs, **satellites}, key, order)
