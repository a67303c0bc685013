"""Exact order statistics of a distributed column."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import as_column
from .numbering import number_rows


@dataclass
class _Search:
    """One wanted rank and the value range it is known to lie in."""

    where: Column
    group: int
    rank: int
    low: object
    high: object
    below: int
    inside: int

    @property
    def found(self) -> bool:
        return self.low == self.high


def order_statistics(
    df: DataFrame,
    value: Column | str,
    wanted: Mapping[str, tuple[Column | None, int]],
    finish_rows: int = 1_000_000,
    accuracy: int = 10_000,
    max_rounds: int = 8,
) -> dict[str, object]:
    """The values at 0-based ranks. `wanted` maps a name to a filter (or None) and a rank; nulls are left out.

    A quantile sketch proposes a range for each rank and exact counts confirm it, so no row is moved: every round is one
    scan with a few fixed-size aggregates. When a range holds `finish_rows` or fewer rows its distinct values are counted
    and the rank is read off. Copies of a value collapse in the partial aggregate. If ranges stop shrinking, the column
    is numbered in full. `df` is scanned several times: cut it first when it is expensive to compute.
    """
    value = as_column(value)
    df = df.filter(value.isNotNull())
    filters = {k: (F.lit(True) if cond is None else cond) for k, (cond, _) in wanted.items()}
    ends = df.agg(
        *[F.min(F.when(c, value)).alias(f"{k}_min") for k, c in filters.items()],
        *[F.max(F.when(c, value)).alias(f"{k}_max") for k, c in filters.items()],
        *[F.count_if(c).alias(f"{k}_n") for k, c in filters.items()],
    ).first()
    searches: dict[str, _Search] = {}
    for k, (_, rank) in wanted.items():
        n = ends[f"{k}_n"]
        if not 0 <= rank < n:
            raise ValueError(f"rank {rank} of {k} is outside its {n} rows")
        searches[k] = _Search(filters[k], id(wanted[k][0]), rank, ends[f"{k}_min"], ends[f"{k}_max"], 0, n)

    for _ in range(max_rounds):
        wide = {k: s for k, s in searches.items() if not s.found and s.inside > finish_rows}
        if not wide:
            break
        _narrow(df, value, wide, accuracy)

    result = {k: s.low for k, s in searches.items() if s.found}
    open_searches = {k: s for k, s in searches.items() if not s.found}
    result |= _read_off(df, value, {k: s for k, s in open_searches.items() if s.inside <= finish_rows})
    for k, s in open_searches.items():
        if s.inside > finish_rows:
            inside = df.filter(s.where & value.between(s.low, s.high)).select(value.alias("v"))
            numbered = number_rows(inside, ["v"], name="i", start=s.below)
            result[k] = numbered.filter(F.col("i") == s.rank).first()["v"]
    return result


def _narrow(df: DataFrame, value: Column, searches: Mapping[str, _Search], accuracy: int) -> None:
    # Searches over the same rows share a sketch.
    shared: dict[tuple, list[str]] = {}
    for k, s in searches.items():
        shared.setdefault((s.group, s.low, s.high), []).append(k)
    margin = 2.0 / accuracy
    proposals = []
    for i, names in enumerate(shared.values()):
        edges = []
        for s in (searches[k] for k in names):
            share = (s.rank - s.below + 0.5) / s.inside
            edges += [F.lit(max(0.0, share - margin)), F.lit(min(1.0, share + margin))]
        s = searches[names[0]]
        proposals.append(F.percentile_approx(F.when(s.where & value.between(s.low, s.high), value), F.array(*edges), accuracy).alias(f"s_{i}"))
    row = df.agg(*proposals).first()
    ranges = {k: row[f"s_{i}"][2 * j : 2 * j + 2] for i, names in enumerate(shared.values()) for j, k in enumerate(names)}
    checks = []
    for k, s in searches.items():
        low, high = ranges[k]
        checks.append(F.count_if(s.where & (value < low)).alias(f"{k}_below"))
        checks.append(F.count_if(s.where & (value <= high)).alias(f"{k}_upto"))
        checks.append(F.max(F.when(s.where & (value < low), value)).alias(f"{k}_prev"))
        checks.append(F.min(F.when(s.where & (value > high), value)).alias(f"{k}_next"))
    counts = df.agg(*checks).first()
    for k, s in searches.items():
        low, high = ranges[k]
        below, upto = counts[f"{k}_below"], counts[f"{k}_upto"]
        end = s.below + s.inside
        if s.rank < below:
            s.high, s.inside = counts[f"{k}_prev"], below - s.below
        elif s.rank >= upto:
            s.low, s.below, s.inside = counts[f"{k}_next"], upto, end - upto
        else:
            s.low, s.high, s.below, s.inside = low, high, below, upto - below


def _read_off(df: DataFrame, value: Column, searches: Mapping[str, _Search]) -> dict[str, object]:
    if not searches:
        return {}
    member = F.array_compact(F.array(*[F.when(s.where & value.between(s.low, s.high), F.lit(k)) for k, s in searches.items()]))
    values = df.select(F.explode(member).alias("k"), value.alias("v")).groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    # At most finish_rows rows per name reach this window.
    upto = F.sum("n").over(Window.partitionBy("k").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    pick = F.lit(None).cast("long")
    for k, s in searches.items():
        pick = F.when(F.col("k") == k, F.lit(s.rank - s.below)).otherwise(pick)
    hit = values.withColumn("upto", upto).withColumn("pick", pick)
    hit = hit.filter((F.col("pick") < F.col("upto")) & (F.col("pick") >= F.col("upto") - F.col("n")))
    return {row["k"]: row["v"] for row in hit.select("k", "v").collect()}


def quantile_ranks(n: int, share: float) -> tuple[int, int, float]:
    """Lower rank, upper rank and weight of the upper one for a linearly interpolated quantile."""
    place = share * (n - 1)
    low = math.floor(place)
    return low, min(low + 1, n - 1), place - low


def quantiles(df: DataFrame, value: Column | str, shares: Mapping[str, float], n: int, **options) -> dict[str, float]:
    """Linearly interpolated quantiles of `n` non-null values."""
    wanted: dict[str, tuple[Column | None, int]] = {}
    for k, share in shares.items():
        low, high, _ = quantile_ranks(n, share)
        wanted[f"{k}_lo"] = (None, low)
        wanted[f"{k}_hi"] = (None, high)
    found = order_statistics(df, value, wanted, **options)
    result = {}
    for k, share in shares.items():
        _, _, weight = quantile_ranks(n, share)
        low, high = found[f"{k}_lo"], found[f"{k}_hi"]
        result[k] = low + (high - low) * weight
    return result
