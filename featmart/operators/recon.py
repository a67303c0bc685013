"""Reconstruction error of scored samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import abs_differences, array_mean, mean_square
from ..workdir import cut
from .selection import order_statistics, quantile_ranks

CONSISTENT_PCT, MINOR_PCT = 1.0, 5.0
BINS = 100


def with_errors(df: DataFrame, x: str = "features", y: str = "reconstructed") -> DataFrame:
    """Append mean squared and mean absolute error; vectors of unequal length have none."""
    diff = df.withColumn("_fm_d", abs_differences(x, y))
    return diff.withColumns({"mse": mean_square(F.col("_fm_d")), "mae": array_mean("_fm_d")}).drop("_fm_d")


def recon_rows(df: DataFrame, key: str = "sample_id", x: str = "features", y: str = "reconstructed") -> DataFrame:
    """Mean squared and mean absolute error of each sample."""
    return with_errors(df, x, y).select(key, "mse", "mae").filter(F.col("mse").isNotNull())


def feature_errors(df: DataFrame, names: Sequence[str] | None = None, x: str = "features", y: str = "reconstructed") -> DataFrame:
    """Mean squared error of each feature over all rows. Tasks send one row per feature."""
    return _feature_errors(df.select(abs_differences(x, y).alias("_fm_d")), names)


def _feature_errors(differences: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    diff = differences.select(F.posexplode("_fm_d").alias("pos", "d"))
    errors = diff.groupBy("pos").agg(F.avg(F.col("d") * F.col("d")).alias("mean_squared_error"))
    name = F.col("pos").cast("string") if names is None else F.element_at(F.array(*[F.lit(n) for n in names]), F.col("pos") + 1)
    return errors.select("pos", name.alias("feature_name"), "mean_squared_error")


def top_features(errors: DataFrame, k: int = 10) -> DataFrame:
    return errors.orderBy(F.desc("mean_squared_error"), "pos").limit(k)


def error_summary(df: DataFrame, key: str = "sample_id", x: str = "features", y: str = "reconstructed", finish_rows: int = 1_000_000) -> DataFrame:
    """One row: mean, sample deviation, extremes, lower median, 95th and 99th percentile of the samples' errors, and the
    largest and smallest feature error.

    The differences and each sample's errors are written once, so that `df` is computed once; later passes read the two
    numbers per row, one pass the differences. Quantiles are found by counting.
    """
    differences = df.select(abs_differences(x, y).alias("_fm_d")).filter(F.col("_fm_d").isNotNull())
    errors = cut(differences.select("_fm_d", mean_square(F.col("_fm_d")).alias("mse"), array_mean("_fm_d").alias("mae")), "sample-errors")
    sums = errors.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("mse").alias("test_mse"),
        F.avg("mae").alias("test_mae"),
        F.stddev_samp("mse").alias("test_mse_std"),
        F.min("mse").alias("test_mse_min"),
        F.max("mse").alias("test_mse_max"),
    ).first()
    n = sums["n"]
    if n == 0:
        raise ValueError("no sample was scored")
    wanted = {"median": (None, (n - 1) // 2)}
    for p in (95, 99):
        low, high, _ = quantile_ranks(n, p / 100)
        wanted |= {f"p{p}_lo": (None, low), f"p{p}_hi": (None, high)}
    at = order_statistics(errors.select("mse"), "mse", wanted, finish_rows=finish_rows)
    quantile = {}
    for p in (95, 99):
        _, _, weight = quantile_ranks(n, p / 100)
        quantile[p] = at[f"p{p}_lo"] + (at[f"p{p}_hi"] - at[f"p{p}_lo"]) * weight
    ends = _feature_errors(errors).agg(
        F.max("mean_squared_error").alias("test_max_feature_error"), F.min("mean_squared_error").alias("test_min_feature_error")
    )
    known = {
        "eval_samples": n,
        "test_loss": sums["test_mse"],
        "test_mse": sums["test_mse"],
        "test_mae": sums["test_mae"],
        "test_mse_std": sums["test_mse_std"],
        "test_mse_min": sums["test_mse_min"],
        "test_mse_max": sums["test_mse_max"],
        "test_mse_median": at["median"],
        "test_mse_p95": quantile[95],
        "test_mse_p99": quantile[99],
    }
    return ends.select(
        *[F.lit(v).cast("long" if k == "eval_samples" else "double").alias(k) for k, v in known.items()],
        "test_max_feature_error",
        "test_min_feature_error",
    )


def histogram(df: DataFrame, value: str, bins: int = BINS) -> DataFrame:
    """Counts in `bins` equal-width bins from minimum to maximum, empty bins included; the last bin has its right end.

    When all values are equal the range is half a unit to either side. `df` is read twice: cut it first when it is expensive
    to compute.
    """
    ends = df.agg(F.min(value).alias("a"), F.max(value).alias("b")).first()
    low, high = ends["a"], ends["b"]
    if low is None:
        raise ValueError("no value to count")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    place = F.least(F.floor((F.col(value) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.filter(F.col(value).isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("c"))
    # `bins` rows on either side.
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("lower"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
        F.coalesce("c", F.lit(0).cast("long")).alias("count"),
    )


def drift_percent(old: Column, new: Column) -> Column:
    """Change in percent of the old value; null when there is no old value or it is 0."""
    return F.when(old != 0, (new - old) / old * 100)


def drift_band(percent: Column) -> Column:
    size = F.abs(percent)
    band = F.when(size < CONSISTENT_PCT, "consistent").when(size < MINOR_PCT, "minor").otherwise("significant")
    return F.when(percent.isNotNull(), band).otherwise("not available")


def metric_drift(df: DataFrame, old: str, new: str) -> DataFrame:
    """Append difference, change in percent and its band."""
    percent = drift_percent(F.col(old), F.col(new))
    return df.withColumns({"difference": F.col(new) - F.col(old), "pct_difference": percent, "band": drift_band(percent)})
