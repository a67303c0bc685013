"""Point-in-time join: for each entity row the newest feature row that was known by then."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..workdir import constant, cut, small_side
from .numbering import ordered_partitions


MAX_KEYS = 1_000_000
COUNTED_ROWS = 10_000


@dataclass(frozen=True)
class FeatureRows:
    """One side of the join: a frame, its time column, the columns to fetch and how long a row stays valid.

    `names` renames fetched columns in the result; `tie` orders rows of one key and time, the last one wins. `buckets` says that the
    frame is a table that is bucketed by the join's keys into that many buckets, see `write_bucketed`.
    """

    df: DataFrame
    timestamp: str
    features: Sequence[str]
    ttl: str | None = None
    tie: Sequence[str] = ()
    names: Sequence[str] = ()
    timestamp_name: str | None = None
    buckets: int = 0

    def result_names(self) -> list[str]:
        return list(self.names or self.features)


def asof_join(
    entities: DataFrame, keys: Sequence[str], timestamp: str, views: Sequence[FeatureRows], hot_rows: int = 5_000_000
) -> DataFrame:
    """Left as-of join of `entities` with every view at once.

    A feature row matches when its time is not after the entity's and, with a `ttl`, not more than `ttl` before it; both
    ends count. Entity rows without a match, or with a null key or time, keep null features.

    Entities and all views go through one shuffle by key, however many views there are: each row carries either entity
    columns or one view's features, and a running `last` per view fetches them. Feature rows that no entity row can need,
    by time and, when the entities have few keys, by key, are left out before the shuffle. A key with more than
    `hot_rows` rows would make one long task, so such keys, found by counting, take a second way: their rows are
    range-partitioned by key and time, which splits a key at any point, and the last feature row of each partition is
    handed on to the partitions after it.

    Views with `buckets` are not shuffled: their files are dealt by key already, and the entities, with the views that have other
    buckets or none, are dealt the same way.
    """
    keys = list(keys)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in [*keys, timestamp]])
    present = entities.filter(known)
    spans = _spans(present, keys, timestamp)
    rows = _stack(present, keys, timestamp, _needed(spans, keys, views))
    hot = _hot_keys(present, keys, timestamp, views, spans, hot_rows)
    names = _key_names(keys)
    if hot is None:
        matched = _forward_fill(rows, names, views)
    else:
        cold = _forward_fill(rows.join(hot, names, "left_anti"), names, views)
        matched = cold.unionByName(_forward_fill_ranges(rows.join(hot, names, "left_semi"), names, views))
    result = matched.select("_fm_entity.*", *_fetch(views))
    unknown = entities.filter(~known)
    return result.unionByName(unknown, allowMissingColumns=True)


@dataclass(frozen=True)
class _Spans:
    """First and last time per entity key, over all of them, and the number of keys."""

    df: DataFrame
    first: Column | None
    last: Column | None
    n: int


def _spans(entities: DataFrame, keys: Sequence[str], timestamp: str) -> _Spans:
    kind = entities.schema[timestamp].dataType
    spans = entities.groupBy(*keys).agg(F.min(timestamp).alias("_fm_a"), F.max(timestamp).alias("_fm_b"))
    spans = cut(spans, "entity-spans").withColumnsRenamed({k: f"_fm_k_{i}" for i, k in enumerate(keys)})
    row = spans.agg(_as_value(F.min("_fm_a"), kind).alias("a"), _as_value(F.max("_fm_b"), kind).alias("b"), F.count(F.lit(1)).alias("n")).first()
    if not row["n"]:
        return _Spans(spans, None, None, 0)
    return _Spans(spans, _as_moment(row["a"], kind), _as_moment(row["b"], kind), row["n"])


def _needed(spans: _Spans, keys: Sequence[str], views: Sequence[FeatureRows]) -> list[FeatureRows]:
    """The views without rows that are too new or too old for every entity row, or whose key no entity row has."""
    result = []
    for view in views:
        ts, df = F.col(view.timestamp), view.df

        def in_time(first: Column, last: Column, view: FeatureRows = view, ts: Column = ts) -> Column:
            known = ts <= last
            return known if view.ttl is None else known & (ts >= first - F.expr(f"INTERVAL {view.ttl}"))

        if spans.n:
            # Constants, so this part reaches the scan.
            df = df.filter(in_time(spans.first, spans.last))
        if spans.n <= MAX_KEYS:
            # Narrowing by key pays only where it needs no shuffle of its own.
            same = [F.col(k) == F.col(f"_fm_k_{i}") for i, k in enumerate(keys)]
            match = reduce(lambda a, b: a & b, [*same, in_time(F.col("_fm_a"), F.col("_fm_b"))])
            df = df.join(F.broadcast(spans.df), match, "left_semi")
        result.append(replace(view, df=df))
    return result


def _hot_keys(
    entities: DataFrame, keys: Sequence[str], timestamp: str, views: Sequence[FeatureRows], spans: _Spans, hot_rows: int
) -> DataFrame | None:
    """Keys with more than about `hot_rows` rows on both sides together, or None.

    The count only decides which way a key takes, and both give the same rows, so where many rows make a key hot, counting
    some of them is enough: about `COUNTED_ROWS` of each hot key.
    """
    share = min(1.0, COUNTED_ROWS / hot_rows)

    def some(df: DataFrame) -> DataFrame:
        return df if share == 1.0 else df.sample(share, seed=0)

    counted_views = _needed(spans, keys, [replace(v, df=some(v.df), buckets=0) for v in views])
    rows = _stack(some(entities), keys, timestamp, counted_views)
    names = _key_names(keys)
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_fm_n"))
    hot = cut(counted.filter(F.col("_fm_n") > hot_rows * share).select(*names), "hot-keys")
    # At most rows / hot_rows keys.
    return None if hot.isEmpty() else small_side(hot)


def _as_value(moment: Column, kind: T.DataType) -> Column:
    """A time in a form that survives the way to the driver and back, whatever the time zones."""
    return F.unix_micros(moment) if isinstance(kind, T.TimestampType) else moment.cast("string")


def _as_moment(value, kind: T.DataType) -> Column:
    return F.timestamp_micros(F.lit(value)) if isinstance(kind, T.TimestampType) else F.lit(value).cast(kind)


def _stack(entities: DataFrame, keys: Sequence[str], timestamp: str, views: Sequence[FeatureRows]) -> DataFrame:
    """Entities and views below each other: keys, time, side, ties, entity struct, one struct per view.

    Keys get names of their own. Where views have buckets, all parts are partitioned alike, and a union of parts that are partitioned
    by columns of one name and type is so too.
    """
    buckets = max((v.buckets for v in views), default=0)
    named = [F.col(k).alias(n) for k, n in zip(keys, _key_names(keys))]
    if buckets:
        entities = entities.repartition(buckets, *keys)
        views = [v if v.buckets == buckets else replace(v, df=v.df.repartition(buckets, *keys)) for v in views]
    parts = [
        entities.select(
            *named,
            F.col(timestamp).alias("_fm_ts"),
            F.lit(1).alias("_fm_side"),
            F.struct(*entities.columns).alias("_fm_entity"),
        )
    ]
    for i, view in enumerate(views):
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in [*keys, view.timestamp]])
        body = [F.col(view.timestamp).alias("ts"), *[F.col(f).alias(n) for f, n in zip(view.features, view.result_names())]]
        parts.append(
            view.df.filter(known).select(
                *named,
                F.col(view.timestamp).alias("_fm_ts"),
                F.lit(0).alias("_fm_side"),
                *[F.col(c).alias(n) for c, n in zip(view.tie, _tie_names(i, view))],
                F.struct(*body).alias(f"_fm_view_{i}"),
            )
        )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _key_names(keys: Sequence[str]) -> list[str]:
    return [f"_fm_key_{i}" for i in range(len(keys))]


def _order(views: Sequence[FeatureRows]) -> list[Column]:
    """Features before entities, so a feature row of the very same time is known; then each view's own tie columns."""
    return [F.col("_fm_ts"), F.col("_fm_side"), *[F.col(n) for i, v in enumerate(views) for n in _tie_names(i, v)]]


def _tie_names(i: int, view: FeatureRows) -> list[str]:
    return [f"_fm_tie_{i}_{j}" for j in range(len(view.tie))]


def _forward_fill(rows: DataFrame, keys: Sequence[str], views: Sequence[FeatureRows]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*_order(views)).rowsBetween(Window.unboundedPreceding, 0)
    slots = [F.last(f"_fm_view_{i}", ignorenulls=True).over(window).alias(f"_fm_view_{i}") for i in range(len(views))]
    return rows.select("_fm_ts", "_fm_entity", *slots).filter(F.col("_fm_entity").isNotNull())


def _forward_fill_ranges(rows: DataFrame, keys: Sequence[str], views: Sequence[FeatureRows]) -> DataFrame:
    placed = ordered_partitions(rows, [*keys, *_order(views)], "asof")
    parts = placed.agg(F.max("_fm_part")).first()[0] + 1
    key = F.struct(*keys)
    carriers = []
    for i in range(len(views)):
        slot = F.col(f"_fm_view_{i}")
        # The last feature row of each part; one row per part.
        last = placed.filter(slot.isNotNull()).groupBy("_fm_part").agg(
            F.max_by(F.struct(*keys, slot), F.col("_fm_place")).alias("_fm_carry")
        )
        last = cut(last, "asof-carry")
        holders = {r["_fm_part"] for r in last.select("_fm_part").collect()}
        targets: list[list[int]] = [[] for _ in range(parts)]
        holder = None
        for part in range(parts):
            if holder is not None:
                targets[holder].append(part)
            if part in holders:
                holder = part
        carriers.append(
            last.select(
                *[F.col(f"_fm_carry.{k}").alias(k) for k in keys],
                F.explode(F.get(constant(targets, "array<array<int>>"), F.col("_fm_part"))).alias("_fm_part"),
                F.lit(-1).cast("long").alias("_fm_place"),
                F.col(f"_fm_carry._fm_view_{i}").alias(f"_fm_view_{i}"),
            )
        )
    all_rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [placed, *carriers])

    # A part may hold several keys; the filled row counts only where its key is the entity's.
    window = Window.partitionBy("_fm_part").orderBy("_fm_place").rowsBetween(Window.unboundedPreceding, 0)
    filled = []
    for i in range(len(views)):
        slot = F.when(F.col(f"_fm_view_{i}").isNotNull(), F.struct(key.alias("k"), F.col(f"_fm_view_{i}").alias("v")))
        filled.append(F.last(slot, ignorenulls=True).over(window).alias(f"_fm_filled_{i}"))
    wide = all_rows.select(*keys, "_fm_ts", "_fm_entity", *filled).filter(F.col("_fm_entity").isNotNull())
    same = [F.when(F.col(f"_fm_filled_{i}.k") == key, F.col(f"_fm_filled_{i}.v")).alias(f"_fm_view_{i}") for i in range(len(views))]
    return wide.select("_fm_ts", "_fm_entity", *same)


def _fetch(views: Sequence[FeatureRows]) -> list[Column]:
    columns = []
    for i, view in enumerate(views):
        slot = f"_fm_view_{i}"
        valid = F.col(slot).isNotNull()
        if view.ttl is not None:
            valid = valid & (F.col(f"{slot}.ts") >= F.col("_fm_ts") - F.expr(f"INTERVAL {view.ttl}"))
        if view.timestamp_name:
            columns.append(F.when(valid, F.col(f"{slot}.ts")).alias(view.timestamp_name))
        columns += [F.when(valid, F.col(f"{slot}.{n}")).alias(n) for n in view.result_names()]
    return columns
