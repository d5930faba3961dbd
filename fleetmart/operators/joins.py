"""Joins whose small side is size-checked and whose hot keys are split.

``fact_join`` is the general tool: the keyed side is broadcast only after its row count was checked;
otherwise hot keys of the fact side are found by a map-side-combined count and spread over salts.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.operators.settle import settle

BROADCAST_ROWS = 100_000
HOT_ROWS = 20_000_000


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether df has at most ``max_rows`` rows; the check reads no more than one row beyond."""
    return df.limit(max_rows + 1).count() <= max_rows


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint, given only to a frame whose size was checked."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def hashed(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The keyed side of an equi join as a hash table: broadcast if its size was checked, else one table for each
    partition of both sides. The other side passes by unsorted, so what a task holds is its share of this side."""
    return F.broadcast(df) if is_small(df, max_rows) else df.hint("shuffle_hash")


def config_frame(spark, values: Mapping[str, Mapping[str, object]] | Mapping[str, object], key: str, schema: str) -> DataFrame:
    """Driver-side settings as a dimension: {key: value} or {key: {column: value}}.

    Its rows are known here, so the broadcast hint is given here, within the usual bound."""
    rows = []
    names = [part.strip().split(" ")[0] for part in schema.split(",")]
    for k, v in values.items():
        row = v if isinstance(v, Mapping) else {names[1]: v}
        rows.append(tuple(k if n == key else row.get(n) for n in names))
    dim = spark.createDataFrame(rows, schema)
    return F.broadcast(dim) if len(rows) <= BROADCAST_ROWS else dim


def spread(df: DataFrame, on: Sequence[str], hot: DataFrame, salts: int, copy: bool) -> DataFrame:
    """Add a ``_salt``: rows of hot keys are spread over salts, or copied to every salt."""
    marked = df.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), list(on), "left")
    if copy:
        every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        return marked.withColumn("_salt", F.explode(every)).drop("_hot")
    # the task number tells copies of one row apart, and a repeated task draws the same salts again
    draw = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) + F.spark_partition_id(), F.lit(salts)).cast("int")
    return marked.withColumn("_salt", F.when(F.col("_hot"), draw).otherwise(F.lit(0))).drop("_hot")


def salted_join(fact: DataFrame, side: DataFrame, on: Sequence[str], how: str, salts: int = 64, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Equi join that splits the fact rows of hot keys over ``salts`` tasks.

    The hot-key list has at most (fact rows / hot_rows) entries, and is broadcast only when it passes the
    size check; beyond that the plain join with adaptive skew splitting is used.
    """
    on = list(on)
    hot = settle(fact.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows).select(*on))
    if hot.isEmpty() or not is_small(hot):
        return fact.join(side, on, how)
    joined = spread(fact, on, hot, salts, copy=False).join(spread(side, on, hot, salts, copy=True), on + ["_salt"], how)
    return joined.drop("_salt")


def fact_join(fact: DataFrame, side: DataFrame, on: Sequence[str], how: str = "left", computed: bool = False, max_rows: int = BROADCAST_ROWS, salts: int = 64, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join (inner, left, left_semi, left_anti) of a large table with a keyed side of unknown size.

    ``computed`` says that the side is the result of a pass over a large table: it is then settled first, so
    that the size check and the join do not repeat that pass.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"the fact side must be preserved or matched, not {how!r}")
    if computed:
        side = settle(side)
    if is_small(side, max_rows):
        return fact.join(F.broadcast(side), list(on), how)
    return salted_join(fact, side, on, how, salts, hot_rows)


def lookup(df: DataFrame, dim: DataFrame, key: Column, dim_key: str, required: bool = False, ignore_case: bool = True, config: bool = False) -> DataFrame:
    """Attach every value column of a dimension in one join; optionally keep only the rows it lists.

    ``config`` marks a dimension made by :func:`config_frame`, whose size needs no check.
    """
    fold = F.upper if ignore_case else (lambda c: c)
    side = dim.withColumn("_key", fold(F.col(dim_key))).drop(dim_key)
    keyed, how = df.withColumn("_key", fold(key)), "inner" if required else "left"
    out = keyed.join(side, "_key", how) if config else fact_join(keyed, side, ["_key"], how)
    return out.drop("_key")


def unseen(candidates: DataFrame, known: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows of ``candidates`` whose (renamed) key does not occur in ``known``."""
    keys = known.select(*[F.col(k).alias(c) for c, k in on.items()])
    return candidates.join(keys, list(on), "left_anti").select(*candidates.columns)


def interval_join(
    facts: DataFrame, spans: DataFrame, key: str, day: str, start: str, end: str, open_end: str,
    bucket_days: int = 32, clip: tuple[str, str] | None = None, how: str = "inner", piece_rows: int | None = None, salts: int = 16,
) -> DataFrame:
    """Facts with every span of the same key that covers the fact's day (both ends included).

    Spans are cut into pieces of ``bucket_days``, so the join is an equi join on (key, piece): a busy key is
    split over the calendar, and a fact meets only the spans alive in its own piece. With ``piece_rows`` the facts of all
    pieces are counted, and a piece with more than so many is cut into single days, on which every span that a fact meets is one of its own, and the facts of a day are
    dealt over ``salts`` tasks; only its spans are copied. An open end is
    ``open_end`` (the day after the run). ``clip`` = (first, last) day of the facts, when known, keeps
    spans such as 1900-9999 from being cut into pieces no fact can meet.
    """
    def piece(d: Column) -> Column:
        return F.floor(F.date_diff(d, F.lit("1970-01-01").cast("date")) / F.lit(bucket_days)).cast("long")

    closed = spans.withColumn(end, F.coalesce(F.col(end), F.lit(open_end).cast("date")))
    lo, hi = F.col(start), F.col(end)
    if clip:
        lo, hi = F.greatest(lo, F.lit(clip[0]).cast("date")), F.least(hi, F.lit(clip[1]).cast("date"))
    cut = (
        closed.filter(lo <= hi)
        .withColumn("_piece", F.explode(F.sequence(piece(lo), piece(hi))))
        .withColumnRenamed(key, "_key")
    )
    left = facts.withColumn("_piece", piece(F.col(day)))
    plain = (left[key] == cut["_key"]) & (left["_piece"] == cut["_piece"]) & (cut[start] <= left[day]) & (left[day] <= cut[end])
    if piece_rows is None:
        return left.join(cut, plain, how).drop(left["_piece"]).drop(cut["_piece"]).drop("_key")
    busy = settle(left.groupBy(F.col(key).alias("_key"), "_piece").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > piece_rows).select("_key", "_piece", F.lit(True).alias("_busy")))
    first = F.col("_piece") * bucket_days
    number = lambda d: F.date_diff(d, F.lit("1970-01-01").cast("date")).cast("long")
    days = F.sequence(F.greatest(number(lo), first), F.least(number(hi), first + bucket_days - 1))
    none, every = F.lit(-1).cast("long"), F.sequence(F.lit(0), F.lit(salts - 1))
    # the task number tells copies of one row apart, and a repeated task draws the same salts again
    draw = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns]) + F.spark_partition_id(), F.lit(salts)).cast("int")
    marked = left.join(busy.withColumnsRenamed({"_key": "_bkey", "_piece": "_bpiece"}), (left[key] == F.col("_bkey")) & (left["_piece"] == F.col("_bpiece")), "left").drop("_bkey", "_bpiece")
    marked = marked.withColumns({"_day": F.when(F.col("_busy"), number(F.col(day))).otherwise(none), "_salt": F.when(F.col("_busy"), draw).otherwise(F.lit(0))}).drop("_busy")
    finer = cut.join(busy, ["_key", "_piece"], "left")
    finer = finer.withColumn("_day", F.explode(F.when(F.col("_busy"), days).otherwise(F.array(none))))
    finer = finer.withColumn("_salt", F.explode(F.when(F.col("_busy"), every).otherwise(F.array(F.lit(0))))).drop("_busy").select(*cut.columns, "_day", "_salt")
    on = (marked[key] == finer["_key"]) & (marked["_piece"] == finer["_piece"]) & (marked["_day"] == finer["_day"]) & (marked["_salt"] == finer["_salt"]) & (finer[start] <= marked[day]) & (marked[day] <= finer[end])
    out = marked.join(finer, on, how)
    for c in ("_piece", "_day", "_salt"):
        out = out.drop(marked[c]).drop(finer[c])
    return out.drop("_key")


def role_columns(matched: DataFrame, keys: Sequence[str], role: str, order: Sequence[str], roles: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """One row per key with the named attributes of each role: {role value: {output: source column}}.

    When several rows hold a role, the first by ``order`` is taken.
    """
    rank = F.struct(*[F.col(c) for c in order])
    aggs = []
    for value, cols in roles.items():
        picked = F.min_by(F.struct(*[F.col(src).alias(out) for out, src in cols.items()]), F.when(F.lower(F.col(role)) == value, rank))
        aggs += [picked[out].alias(out) for out in cols]
    return matched.groupBy(*keys).agg(*aggs)


def two_role_join(facts: DataFrame, crew: DataFrame, keys: tuple[str, str], crew_key: str, day: str, as_of: str, labels: tuple[str, str], code: str, both_required: bool = False) -> DataFrame:
    """Crew dimension joined twice: attributes for the first operator, code and role label for both.

    Only reports before ``as_of``. With ``both_required`` rows without a second operator are dropped. A blank id
    names nobody: it matches nothing, however many crew rows have one.
    """
    crew = crew.filter(F.trim(F.col(crew_key).cast("string")) != "")
    shared = set(facts.columns) & set(crew.columns)
    own = [c for c in crew.columns if c not in shared and c not in (crew_key, code)]
    recent = facts.filter(F.to_date(F.col(day)) < F.lit(as_of).cast("date"))
    first = crew.select(
        F.col(crew_key).alias(keys[0]), *own, F.col(code).alias("operator_secondary_code"), F.lit(labels[0]).alias("role_alias")
    )
    second = crew.select(
        F.col(crew_key).alias(keys[1]), F.col(code).alias("operator_secondary_code2"), F.lit(labels[1]).alias("role_alias2")
    )
    one = fact_join(recent, first, [keys[0]], "left")
    return fact_join(one, second, [keys[1]], "inner" if both_required else "left")


def same_day_join(frames: Iterable[DataFrame], on: Sequence[str]) -> DataFrame:
    """Inner join of frames that are already one row per (day, ship): one shuffle key for all of them."""
    it = iter(frames)
    out = next(it)
    for f in it:
        out = out.join(f, list(on), "inner")
    return out
