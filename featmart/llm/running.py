"""Running totals over a global order without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.numbering import ordered_partitions
from ..workdir import constant


def running_total(df: DataFrame, order_by: Sequence[Column | str], value: str, name: str, stable_input: bool = False) -> DataFrame:
    """Add `name`: the sum of the long column `value` over all rows before this one in the order of `order_by`.

    Rows are range-partitioned (rows that tie spread over partitions), each partition adds up its own rows, and one sum per
    partition, which is all the driver sees, shifts them. Rows that tie on the whole order come in arbitrary order.
    """
    placed = ordered_partitions(df, order_by, name.strip("_"), stable_input)
    sums = {r["_fm_part"]: r["n"] for r in placed.groupBy("_fm_part").agg(F.sum(value).alias("n")).collect()}
    offsets, offset = [], 0
    for part in range(max(sums, default=-1) + 1):
        offsets.append(offset)
        offset += sums.get(part) or 0
    before = Window.partitionBy("_fm_part").orderBy("_fm_place").rowsBetween(Window.unboundedPreceding, -1)
    total = F.get(constant(offsets, "array<bigint>"), F.col("_fm_part")) + F.coalesce(F.sum(value).over(before), F.lit(0))
    return placed.withColumn(name, total).drop("_fm_part", "_fm_place")
