"""Ordered operators over time, written so that one busy key does not end in one task.

Every window here is partitioned by (key, time bucket). What a row needs from outside its bucket arrives by
one of two routes:

* *carry* - per-bucket summaries (pre-aggregated on the map side) are chained in a second, small window:
  one row per (key, bucket), bounded by the time span and not by the row count;
* *halo* - when the reach is bounded (a tolerance), only the rows near a bucket edge are copied across.

Buckets are fixed cuts of the clock, so a recomputed task sees the same groups.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmart.operators.settle import settle

DAY = 86_400
HOUR = 3_600


def bucket_of(ts: Column, width: int) -> Column:
    return F.floor(F.unix_seconds(ts) / F.lit(width)).cast("long")


def spare_bucket(df: DataFrame) -> Column:
    """Bucket for rows without a key or time: they have no neighbours, so they are simply spread out (copies of
    one row by the task they come from, which a repeated task does again)."""
    mixed = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) + F.spark_partition_id()
    return (F.lit(-1) - F.pmod(mixed, F.lit(4096))).cast("long")


def placed(keys: Sequence[str], ts: str) -> Column:
    out = F.col(ts).isNotNull()
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def order_of(cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in cols])


def with_context(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    lag: Mapping[str, str] | None = None,
    lead: Mapping[str, str] | None = None,
    fill: Mapping[str, str] | None = None,
    first: Mapping[str, str] | None = None,
    width: int = DAY,
    computed: bool = False,
) -> DataFrame:
    """Add previous-row, next-row, last-known and first-of-key values along each key's time line.

    ``order`` starts with the timestamp and must be a total order; each mapping is {output: input}.
    ``fill`` is the last non-NULL value up to and including the row. Rows with a NULL key or time have no
    place on a time line: they stay, with NULL context. The input is read twice (once pruned, for the summaries);
    ``computed`` says that it is the result of a longer plan, which is then settled instead of run twice.
    """
    lag, lead, fill, first = dict(lag or {}), dict(lead or {}), dict(fill or {}), dict(first or {})
    keys = list(keys)
    if computed:
        df = settle(df)
    here = bucket_of(F.col(order[0]), width)
    src = df.withColumn("_v", placed(keys, order[0])).withColumn("_b", F.when(F.col("_v"), here).otherwise(spare_bucket(df)))
    rank = order_of(order)

    summary = [F.lit(1).alias("_one")]
    if lag:
        summary.append(F.max_by(F.struct(*[F.col(c).alias(o) for o, c in lag.items()]), rank).alias("_tail"))
    if lead:
        summary.append(F.min_by(F.struct(*[F.col(c).alias(o) for o, c in lead.items()]), rank).alias("_head"))
    if first:
        summary.append(F.min_by(F.struct(*[F.col(c).alias(o) for o, c in first.items()]), rank).alias("_start"))
    for o, c in fill.items():
        summary.append(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(f"_fill_{o}"))
    chain = Window.partitionBy(*keys).orderBy("_b")
    before = chain.rowsBetween(Window.unboundedPreceding, -1)
    edges = df.filter(placed(keys, order[0])).withColumn("_b", here).groupBy(*keys, "_b").agg(*summary).select(
        *keys,
        "_b",
        *([F.lag("_tail").over(chain).alias("_tail")] if lag else []),
        *([F.lead("_head").over(chain).alias("_head")] if lead else []),
        *([F.first("_start").over(chain.rowsBetween(Window.unboundedPreceding, 0)).alias("_start")] if first else []),
        *[F.last(f"_fill_{o}", True).over(before).alias(f"_fill_{o}") for o in fill],
    )

    inside = Window.partitionBy(*keys, "_b", "_v").orderBy(*order)
    out = src.join(edges, keys + ["_b"], "left")
    added: dict[str, Column] = {}
    if lag:
        prev = F.coalesce(F.lag(F.struct(*[F.col(c).alias(o) for o, c in lag.items()])).over(inside), F.col("_tail"))
        added |= {o: prev[o] for o in lag}
    if lead:
        nxt = F.coalesce(F.lead(F.struct(*[F.col(c).alias(o) for o, c in lead.items()])).over(inside), F.col("_head"))
        added |= {o: nxt[o] for o in lead}
    for o, c in fill.items():
        known = F.last(c, True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
        added[o] = F.coalesce(known, F.col(f"_fill_{o}"))
    added |= {o: F.col("_start")[o] for o in first}
    added = {o: F.when(F.col("_v"), c) for o, c in added.items()}
    return out.withColumns(added).select(*[F.col(f"`{c}`") for c in df.columns if c not in added], *added)


def top_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], latest: bool = True) -> DataFrame:
    """One whole row per key: the last (or first) by a total order. Combines on the map side, so a hot key
    shuffles one row per map task instead of all of its rows."""
    pick = F.max_by if latest else F.min_by
    keep = [c for c in df.columns if c not in set(keys)]
    if not keep:
        return df.dropDuplicates(list(keys))
    best = df.groupBy(*keys).agg(pick(F.struct(*[F.col(f"`{c}`") for c in keep]), order_of(order)).alias("_row"))
    return best.select(*[F.col(f"`{c}`") if c in set(keys) else F.col("_row")[c].alias(c) for c in df.columns])


def asof_nearest(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    tolerance: int,
    take: Mapping[str, str],
    tie: Sequence[str],
    how: str = "left",
    width: int | None = None,
) -> DataFrame:
    """Each left row with the right row of the same key nearest in time, at most ``tolerance`` seconds away.

    Equal distances go to the earlier right row, then to the smaller ``tie``. Both sides are laid on one
    time line per (key, bucket) and each left row looks at its neighbours there, so no pair is ever
    formed; right rows within the tolerance of a bucket edge are copied across it. Adds the ``take``
    columns ({output: right column}) and ``time_diff`` in seconds.
    """
    width = width or max(DAY, 4 * tolerance)
    keys, lcols = list(keys), list(left.columns)
    lts, rts = F.col(left_ts), F.col(right_ts)
    reach = F.make_dt_interval(secs=F.lit(tolerance))

    lrows = left.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.when(placed(keys, left_ts), bucket_of(lts, width)).otherwise(spare_bucket(left)).alias("_b"),
        lts.alias("_t"),
        F.lit(1).alias("_side"),
        F.struct(*[F.col(f"`{c}`") for c in lcols]).alias("_l"),
    )
    value = F.struct(rts.alias("_rt"), *[F.col(c).alias(o) for o, c in take.items()])
    rrows = (
        right.filter(rts.isNotNull())
        .dropna(subset=keys)
        .select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
            F.explode(F.sequence(bucket_of(rts - reach, width), bucket_of(rts + reach, width))).alias("_b"),
            rts.alias("_t"),
            F.lit(0).alias("_side"),
            value.alias("_r"),
            F.struct(*[F.col(c) for c in tie]).alias("_tie"),
        )
    )
    line = lrows.unionByName(rrows, allowMissingColumns=True)
    part = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))], "_b")
    seen = lambda *o: F.last("_r", True).over(part.orderBy(*o).rowsBetween(Window.unboundedPreceding, 0))
    both = line.select(
        "_side",
        "_l",
        "_t",
        seen("_t", "_side", F.desc("_tie")).alias("_back"),
        seen(F.desc("_t"), "_side", F.desc("_tie")).alias("_ahead"),
    ).filter(F.col("_side") == 1)

    def gap(c: str) -> Column:
        return F.abs(F.unix_micros(F.col("_t")) - F.unix_micros(F.col(c)["_rt"])) / F.lit(1e6)

    chosen = F.when(F.coalesce(gap("_back") <= gap("_ahead"), F.col("_back").isNotNull()), F.col("_back")).otherwise(F.col("_ahead"))
    out = both.select("_l", "_t", chosen.alias("_c")).withColumn("_gap", gap("_c"))
    out = out.withColumn("_ok", F.coalesce(F.col("_gap") <= tolerance, F.lit(False)))
    if how == "inner":
        out = out.filter("_ok")
    return out.select(
        *[F.col("_l")[c].alias(c) for c in lcols],
        *[F.when(F.col("_ok"), F.col("_c")[o]).alias(o) for o in take],
        F.when(F.col("_ok"), F.col("_gap")).alias("time_diff"),
    )


def halo(df: DataFrame, keys: Sequence[str], ts: str, back: int, ahead: int, width: int) -> DataFrame:
    """Copy each row into every bucket from which it can be seen; ``_home`` marks the one it belongs to. Rows without
    key or time are seen from nowhere: they stay once, in spare buckets, with ``_v`` false."""
    t = F.unix_seconds(F.col(ts))
    cut = lambda s: F.floor(s / F.lit(width)).cast("long")
    seen = F.when(F.col("_v"), F.sequence(cut(t - F.lit(back)), cut(t + F.lit(ahead)))).otherwise(F.array(spare_bucket(df).cast("long")))
    return df.withColumn("_v", placed(keys, ts)).withColumn("_b", F.explode(seen)).withColumn("_home", ~F.col("_v") | (F.col("_b") == cut(t)))


def range_min(df: DataFrame, keys: Sequence[str], ts: str, value: str, radius: int, out: str, width: int | None = None) -> DataFrame:
    """Minimum of ``value`` over the rows of the same key within ``radius`` seconds on either side. Rows without key or
    time stay, with NULL."""
    width = width or max(DAY, 4 * radius)
    near = Window.partitionBy(*keys, "_b", "_v").orderBy(F.unix_seconds(F.col(ts))).rangeBetween(-radius, radius)
    return (
        halo(df, keys, ts, radius, radius, width)
        .withColumn(out, F.when(F.col("_v"), F.min(value).over(near)))
        .filter("_home")
        .drop("_b", "_home", "_v")
    )


def nearest_only(matched: DataFrame, keys: Sequence[str], ts: str, radius: int = 1_800) -> DataFrame:
    """Keep a match only if no other match of the same key within ``radius`` seconds is closer in time."""
    m = range_min(matched, keys, ts, "time_diff", radius, "_best")
    return m.filter(F.col("time_diff") == F.col("_best")).drop("_best")


def with_marks_ahead(df: DataFrame, keys: Sequence[str], ts: str, mark: Column, reach: int, width: int, value: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """Add ``_mark``: per row, the next marked row of its key at or after its own time (a struct of ``value``).

    One pass: each row is laid on its bucket's time line once, and marked rows again, as marks, on every bucket
    from which they can be seen within ``reach`` seconds. Marks further ahead may be missed. Of marks with
    equal time the smallest ``tie`` counts.
    """
    t = F.unix_seconds(F.col(ts))
    cut = lambda s: F.floor(s / F.lit(width)).cast("long")
    home = F.when(placed(keys, ts), cut(t)).otherwise(spare_bucket(df))
    own = F.array(F.struct(F.lit(1).alias("side"), home.alias("b")))
    seen_from = F.transform(F.sequence(cut(t - F.lit(reach)), cut(t)), lambda b: F.struct(F.lit(0).alias("side"), b.alias("b")))
    places = F.when(mark & placed(keys, ts), F.concat(own, seen_from)).otherwise(own)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    line = df.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(ts).alias("_t"), row.alias("_row"),
        F.struct(*[F.col(c) for c in tie or [ts]]).alias("_tie"), F.explode(places).alias("_at"),
    )
    w = (
        Window.partitionBy(*[f"_k{i}" for i in range(len(keys))], "_at.b")
        .orderBy(F.desc("_t"), "_at.side", F.desc("_tie"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    ahead = F.last(F.when(F.col("_at.side") == 0, F.struct(*[F.col("_row")[c].alias(c) for c in value])), True).over(w)
    return line.withColumn("_mark", ahead).filter(F.col("_at.side") == 1).select("_row.*", "_mark")


def without_follower(df: DataFrame, keys: Sequence[str], ts: str, mark: Column, days: int = 2, width: int = 4 * DAY) -> DataFrame:
    """Unmarked rows with no marked row of the same key from their own time up to midnight ``days`` days on."""
    rows = df.withColumn("_marked", F.coalesce(mark, F.lit(False)))
    seen = with_marks_ahead(rows, keys, ts, F.col("_marked"), days * DAY, width, [ts])
    limit = F.date_add(F.to_date(F.col(ts)), days).cast("timestamp")
    alone = F.col("_mark").isNull() | (F.col("_mark")[ts] > limit)
    return seen.filter(~F.col("_marked") & F.coalesce(alone, F.lit(True))).drop("_marked", "_mark")


def between_marks(df: DataFrame, keys: Sequence[str], order: Sequence[str], mark: Column) -> DataFrame:
    """Rows from the first to the last marked row of their key, both included."""
    from fleetmart.operators.joins import fact_join

    rank = order_of(order)
    bounds = df.groupBy(*keys).agg(F.min(F.when(mark, rank)).alias("_lo"), F.max(F.when(mark, rank)).alias("_hi"))
    return (
        fact_join(df, bounds.filter(F.col("_lo").isNotNull()), keys, "inner", computed=True)
        .filter((rank >= F.col("_lo")) & (rank <= F.col("_hi")))
        .select(*[F.col(f"`{c}`") for c in df.columns])
    )


def days_without(df: DataFrame, keys: Sequence[str], ts: str, mark: Column) -> DataFrame:
    """(key, day) pairs that have rows but no marked row: one pre-aggregated pass, no join."""
    return (
        df.groupBy(*keys, F.to_date(F.col(ts)).alias("report_day"))
        .agg(F.max(F.coalesce(mark, F.lit(False))).alias("_any"))
        .filter(~F.col("_any"))
        .drop("_any")
    )
