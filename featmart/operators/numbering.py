"""Exact global row numbers without a single-task sort."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import as_column
from ..workdir import constant, cut

_POSITION = "_fm_position"
_SALT = "_fm_salt"
_PART = "_fm_part"

# Spark documents monotonically_increasing_id as partition index * 2^33 + row index within the partition.
_PART_BITS = 33


def ordered_partitions(df: DataFrame, order_by: Iterable[Column | str], label: str, stable_input: bool = False) -> DataFrame:
    """Range-partition and sort `df`, write it once, and return it with its part and its place in the part.

    Row `(part, place)` order is the order of `order_by`; rows that tie on it are in arbitrary but fixed order. A salt is
    the last sort key, so equal rows, however many, spread over several partitions. The salt is the row's position in
    `df`, which a retried task must reproduce: frames that went through a shuffle are written out first, frames that
    come straight from files (`stable_input=True`) need no copy.
    """
    base = df if stable_input else cut(df, f"{label}-input")
    keys = [as_column(c) for c in order_by]
    salted = base.withColumn(_SALT, F.monotonically_increasing_id())
    keys.append(F.col(_SALT))
    ranged = salted.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(_SALT)
    fixed = cut(ranged.withColumn(_POSITION, F.monotonically_increasing_id()), label)
    return fixed.withColumns(
        {
            _PART: F.shiftright(_POSITION, _PART_BITS).cast("int"),
            "_fm_place": F.col(_POSITION).bitwiseAND(F.lit((1 << _PART_BITS) - 1)),
        }
    ).drop(_POSITION)


def number_rows(
    df: DataFrame, order_by: Iterable[Column | str], name: str = "row_id", start: int = 1, stable_input: bool = False
) -> DataFrame:
    """`row_number() over (order by ...)` as one range shuffle.

    Each partition counts its own rows; the offsets are running sums over one count per partition, so what the driver
    sees and puts into the plan is as long as the number of shuffle partitions, whatever the number of rows.
    """
    placed = ordered_partitions(df, order_by, "numbered", stable_input)
    counts = {r[_PART]: r["n"] for r in placed.groupBy(_PART).agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, offset = [], start
    for part in range(max(counts, default=-1) + 1):
        offsets.append(offset)
        offset += counts.get(part, 0)
    number = F.get(constant(offsets, "array<bigint>"), F.col(_PART)) + F.col("_fm_place")
    return placed.withColumn(name, number).drop(_PART, "_fm_place")


def number_by_digest(
    df: DataFrame,
    groups: Sequence[str],
    digest: str,
    name: str = "row_id",
    bucket_rows: int = 2_000_000,
    max_buckets: int = 1_000_000,
    stable_input: bool = False,
) -> DataFrame:
    """`row_number() over (order by groups, digest)` where `digest` is a column of md5 texts.

    Digests are uniform, so their first digits cut every group into buckets that keep the order and are about equally
    large. One narrow scan counts the buckets, and the numbering itself is one shuffle by bucket; nothing is written in
    between. Where that does not hold, because there are very many groups or because copies of a row fill one bucket,
    the rows are numbered by ranges instead.
    """
    known = df.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64(F.lit(0), *groups)).alias("g")).first()
    rows, n_groups = known["n"], max(1, known["g"])
    digits = 1
    while rows / n_groups / 16**digits > bucket_rows:
        digits += 1
    order = [*groups, digest]
    if n_groups * 16**digits > max_buckets:
        return number_rows(df, order, name, stable_input=stable_input)
    prefix = F.substring(digest, 1, digits)
    tagged = df.withColumn("_fm_prefix", prefix)
    buckets = cut(tagged.groupBy(*groups, "_fm_prefix").agg(F.count(F.lit(1)).alias("_fm_n")), "digest-buckets")
    largest = buckets.agg(F.max("_fm_n")).first()[0] or 0
    if largest > 8 * bucket_rows:
        return number_rows(df, order, name, stable_input=stable_input)
    # At most max_buckets narrow rows: one task can add them up, and they can be broadcast.
    before = Window.orderBy(*groups, "_fm_prefix").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.withColumn("_fm_start", F.coalesce(F.sum("_fm_n").over(before), F.lit(0))).drop("_fm_n")
    within = Window.partitionBy(*groups, "_fm_prefix").orderBy(digest)
    numbered = tagged.withColumn("_fm_i", F.row_number().over(within))
    matched = _match(numbered, offsets, [*groups, "_fm_prefix"])
    return matched.withColumn(name, F.col("_fm_start") + F.col("_fm_i")).select(*df.columns, name)


def _match(df: DataFrame, small: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Join a small frame by columns where null equals null."""
    renamed = small.withColumnsRenamed({c: f"_fm_r_{i}" for i, c in enumerate(columns)})
    same = [F.col(c).eqNullSafe(F.col(f"_fm_r_{i}")) for i, c in enumerate(columns)]
    return df.join(F.broadcast(renamed), reduce(lambda a, b: a & b, same)).drop(*[f"_fm_r_{i}" for i in range(len(columns))])
