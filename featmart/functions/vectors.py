"""Expressions on array columns; all run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .hashing import as_column


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def array_mean(values: Column | str) -> Column:
    values = as_column(values)
    return F.when(F.size(values) > 0, array_sum(doubles(values)) / F.size(values))


def array_variance(values: Column | str) -> Column:
    """Population variance of the elements, in one pass over them."""
    values = doubles(as_column(values))
    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(acc: Column, x: Column) -> Column:
        n, gap = acc["n"] + 1.0, x - acc["mean"]
        mean = acc["mean"] + gap / n
        return F.struct(n.alias("n"), mean.alias("mean"), (acc["m2"] + gap * (x - mean)).alias("m2"))

    return F.aggregate(values, start, add, lambda acc: F.when(acc["n"] > 0, acc["m2"] / acc["n"]))


def doubles(values: Column) -> Column:
    return values.cast("array<double>")


def abs_differences(a: Column | str, b: Column | str, truncate: bool = False) -> Column:
    """Element-wise `|a - b|`. Null when the lengths differ, unless `truncate` pairs up to the shorter one."""
    a, b = doubles(as_column(a)), doubles(as_column(b))
    if truncate:
        shorter = F.least(F.size(a), F.size(b))
        return F.zip_with(F.slice(a, F.lit(1), shorter), F.slice(b, F.lit(1), shorter), lambda x, y: F.abs(x - y))
    return F.when(F.size(a) == F.size(b), F.zip_with(a, b, lambda x, y: F.abs(x - y)))


def mean_square(values: Column) -> Column:
    return F.when(F.size(values) > 0, array_sum(F.transform(values, lambda x: x * x)) / F.size(values))


def clean_number(col: Column | str, text: bool = False) -> Column:
    """A double with null, NaN and (for text) anything unreadable as 0."""
    col = as_column(col)
    value = col.try_cast("double") if text else col.cast("double")
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))
