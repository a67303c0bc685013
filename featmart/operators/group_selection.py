"""Exact order statistics of very many groups at once, without sorting a group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workdir import cut

FINISH_ROWS = 100_000
SKETCH_SIZE = 1024
MARGIN = 0.006  # a sketch of that size is within about 0.3 % of a rank
GRID = 200
MAX_BROADCAST = 200_000  # ranges, of a few numbers and the group's columns each
MAX_ROUNDS = 12


def group_order_statistics(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    wanted: Mapping[str, Column],
    finish_rows: int = FINISH_ROWS,
    sketch_size: int = SKETCH_SIZE,
    margin: float = MARGIN,
    ends: DataFrame | None = None,
) -> DataFrame:
    """The values at 0-based ranks of each group: one row per group and a column per name of `wanted`.

    A rank is a column over `n`, the group's number of non-null values. What is known of each group and rank, the range its value
    lies in and how many values are below and inside, is a table of one row each and never leaves the cluster. A round is two scans. In the first
    each task feeds the values inside to a KLL sketch per group and rank, the merged sketches propose a narrower range, and in the second
    exact counts say in which part of the old range the rank is. So a group that holds most rows costs every task the same few kilobytes. When no
    range holds more than `finish_rows` values, these are counted per distinct value and the rank is read off. Copies of one value
    fold in the partial counts, so a range that has shrunk to one value is done whatever it holds.

    `df` is scanned several times: cut it first when it is expensive to compute. `ends` may give what is known of the groups already: columns of
    `group`, number of values, least and greatest value, in this order. NaN is above all numbers. Groups without a value are left out.
    """
    group = list(group)
    rows = df.filter(F.col(value).isNotNull()).select(*[F.col(g).alias(f"_fm_g{i}") for i, g in enumerate(group)], F.col(value).alias("v"))
    keys = [f"_fm_g{i}" for i in range(len(group))]
    if ends is None:
        ends = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    else:
        ends = ends.toDF(*keys, "n", "low", "high")
    ranks = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), rank.cast("long").alias("rank")) for name, rank in wanted.items()]))
    state = ends.filter("n > 0").select(*keys, "low", "high", F.lit(0).cast("long").alias("below"), F.col("n").alias("inside"), ranks.alias("w"))
    state = cut(state.select(*keys, "w.name", "w.rank", "low", "high", "below", "inside"), "rank-ranges")
    is_open = ~F.col("low").eqNullSafe(F.col("high"))
    is_wide = is_open & (F.col("inside") > finish_rows)
    known = state.agg(F.count(F.lit(1)).alias("ranges"), F.count_if(is_wide).alias("wide")).first()
    few = known["ranges"] <= MAX_BROADCAST
    for _ in range(MAX_ROUNDS):
        if not known["wide"]:
            break
        narrowed = _narrowed(rows, keys, state.filter(is_wide), few, sketch_size, margin)
        state = cut(state.filter(~is_wide).unionByName(narrowed), "rank-ranges")
        known = state.agg(F.count_if(is_wide).alias("wide")).first()
    found = state.filter(~is_open).select(*keys, "name", F.col("low").alias("v"))
    found = found.unionByName(_read_off(rows, keys, state.filter(is_open), few))
    pairs = F.map_from_entries(F.collect_list(F.struct("name", "v")))
    by_group = found.groupBy(*keys).agg(pairs.alias("_fm_values"))
    return by_group.select(*[F.col(k).alias(g) for k, g in zip(keys, group)], *[F.col("_fm_values")[name].alias(name) for name in wanted])


def _inside(rows: DataFrame, keys: Sequence[str], ranges: DataFrame, few: bool) -> DataFrame:
    """Values with the ranges they lie in; the ranges are broadcast where a count showed them to be few."""
    side = ranges.withColumnsRenamed({k: f"{k}_r" for k in keys})
    side = F.broadcast(side) if few else side
    same = [F.col(k).eqNullSafe(F.col(f"{k}_r")) for k in keys]
    return rows.join(side, reduce(lambda a, b: a & b, [*same, F.col("v").between(F.col("low"), F.col("high"))])).drop(*[f"{k}_r" for k in keys])


def _narrowed(rows: DataFrame, keys: Sequence[str], wide: DataFrame, few: bool, sketch_size: int, margin: float) -> DataFrame:
    """The ranges after one round."""
    d = F.col("v").cast("double")
    sketches = _inside(rows, keys, wide, few).groupBy(*keys, "name", "rank", "low", "high", "below", "inside").agg(F.kll_sketch_agg_double(d, F.lit(sketch_size)).alias("s"))
    share = (F.col("rank") - F.col("below") + 0.5) / F.kll_sketch_get_n_double("s")

    # Sketches answer for constant ranks only, so an even grid of them is asked for and the two that enclose the wanted one are taken.
    grid = F.kll_sketch_get_quantile_double("s", F.array(*[F.lit(i / GRID) for i in range(GRID + 1)]))

    def proposed(step: Column) -> Column:
        return F.get(F.col("grid"), F.greatest(F.lit(0), F.least(F.lit(GRID), step)).cast("int"))

    ranges = sketches.withColumn("grid", grid).select(
        *keys, "name", "rank", "low", "high", "below", "inside", proposed(F.floor((share - margin) * GRID)).alias("lo"), proposed(F.ceil((share + margin) * GRID)).alias("hi")
    )
    ranges = cut(ranges, "rank-proposals")
    members = _inside(rows, keys, ranges, few)
    under, over = d < F.col("lo"), d > F.col("hi")
    among = ~under & ~over
    kept = ["name", "rank", "low", "high", "below", "inside"]
    counts = members.groupBy(*keys, *kept).agg(
        F.count_if(under).alias("n_under"), F.count_if(~over).alias("n_upto"),
        F.max(F.when(under, F.col("v"))).alias("prev"), F.min(F.when(over, F.col("v"))).alias("next"),
        F.min(F.when(among, F.col("v"))).alias("first"), F.max(F.when(among, F.col("v"))).alias("last"),
    )
    place = F.col("rank") - F.col("below")
    before, after = place < F.col("n_under"), place >= F.col("n_upto")

    def choose(lower: Column, upper: Column, middle: Column) -> Column:
        return F.when(before, lower).when(after, upper).otherwise(middle)

    c = F.col
    return counts.select(
        *keys, "name", "rank",
        choose(c("low"), c("next"), c("first")).alias("low"), choose(c("prev"), c("high"), c("last")).alias("high"),
        choose(c("below"), c("below") + c("n_upto"), c("below") + c("n_under")).alias("below"),
        choose(c("n_under"), c("inside") - c("n_upto"), c("n_upto") - c("n_under")).alias("inside"),
    )


def _read_off(rows: DataFrame, keys: Sequence[str], ranges: DataFrame, few: bool) -> DataFrame:
    """The values of ranges that hold few rows, by counting their distinct values."""
    counted = _inside(rows, keys, ranges, few).groupBy(*keys, "name", "rank", "below", "v").agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(Window.partitionBy(*keys, "name").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    reached = counted.withColumn("upto", F.col("below") + upto).filter(F.col("upto") > F.col("rank"))
    return reached.groupBy(*keys, "name").agg(F.min("v").alias("v"))
