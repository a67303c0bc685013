"""Latency statistics of benchmark runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workdir import cut
from .group_selection import group_order_statistics

# Latency limits in ms of the gate, and the reported percentiles.
MEAN_LIMIT_MS, P99_LIMIT_MS = 100, 500
PERCENTILES = (50, 95, 99)


def latency_statistics(
    df: DataFrame, group: Sequence[str] = ("model",), latency: str = "latency_ms", percentiles: Sequence[int] = PERCENTILES, **options
) -> DataFrame:
    """Count, mean, extremes, percentiles and throughput per group, fractions of milliseconds included.

    Percentile p is the value at index `floor(p / 100 * (n - 1))` of the sorted latencies; null latencies are left out of all
    figures. Everything but the percentiles is one aggregate; these are selected without sorting a group, see
    `group_order_statistics`, whose options may be given. Throughput is 0 when the sum is 0.
    """
    group = list(group)
    if not group:
        return latency_statistics(df.withColumn("_fm_all", F.lit(1)), ["_fm_all"], latency, percentiles, **options).drop("_fm_all")
    total = F.sum(latency)
    n = F.count(latency)
    figures = df.groupBy(*group).agg(
        n.alias("total_samples"),
        (total / n).alias("avg_latency_ms"),
        F.min(latency).alias("min_latency_ms"),
        F.max(latency).alias("max_latency_ms"),
        F.when(total > 0, n * F.lit(1000.0) / total).otherwise(F.lit(0.0)).alias("throughput_samples_per_sec"),
    )
    figures = cut(figures, "latency-figures")

    def index(p: int) -> Column:
        return F.floor(F.lit(p / 100.0) * (F.col("n") - 1))

    wanted = {f"p{p}_latency_ms": index(p) for p in percentiles}
    ends = figures.select(*group, "total_samples", "min_latency_ms", "max_latency_ms")
    selected = group_order_statistics(df, group, latency, wanted, ends=ends, **options)
    renamed = selected.withColumnsRenamed({g: f"_fm_g_{i}" for i, g in enumerate(group)})
    found = figures.join(renamed, [F.col(g).eqNullSafe(F.col(f"_fm_g_{i}")) for i, g in enumerate(group)], "left")
    ordered = [*group, "total_samples", "avg_latency_ms", "min_latency_ms", "max_latency_ms", *wanted, "throughput_samples_per_sec"]
    return found.select(*ordered)


def latency_gate(stats: DataFrame, mean_limit: float = MEAN_LIMIT_MS, p99_limit: float = P99_LIMIT_MS) -> DataFrame:
    """Whether mean and 99th percentile are below their limits."""
    return stats.withColumn("passed", (F.col("avg_latency_ms") < mean_limit) & (F.col("p99_latency_ms") < p99_limit))
