"""Comparing two result sets sample by sample within a tolerance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import abs_differences, array_mean, doubles, mean_square

TOLERANCE = 0.01
PASS_RATE = 0.99
REPEATABLE = 1e-6
WORST_STORED, WORST_SHOWN = 20, 5


def _paired(a: DataFrame, b: DataFrame, key: str, values: str, how: str) -> DataFrame:
    left = a.select(F.col(key), F.col(values).alias("_fm_a"))
    right = b.select(F.col(key), F.col(values).alias("_fm_b"))
    return left.join(right, key, how)


def _measures(paired: DataFrame, key: str, tolerance: float, truncate: bool) -> DataFrame:
    diff = paired.withColumn("_fm_d", abs_differences("_fm_a", "_fm_b", truncate))
    return diff.select(
        key,
        F.array_max("_fm_d").alias("max_diff"),
        array_mean("_fm_d").alias("mean_diff"),
        mean_square(F.col("_fm_d")).alias("mse"),
        (F.array_max("_fm_d") <= tolerance).alias("within_tolerance"),
    )


def compare_rows(
    a: DataFrame, b: DataFrame, key: str = "sample_id", values: str = "outputs", tolerance: float = TOLERANCE, truncate: bool = False
) -> DataFrame:
    """Differences of the samples both sides have. Samples of unequal length are left out, or cut to the shorter one."""
    return _measures(_paired(a, b, key, values, "inner"), key, tolerance, truncate).filter(F.col("max_diff").isNotNull())


def unmatched(a: DataFrame, b: DataFrame, key: str = "sample_id") -> DataFrame:
    """Samples of `a` that `b` lacks."""
    return a.select(key).join(b.select(key), key, "left_anti")


def compare_summary(
    a: DataFrame, b: DataFrame, key: str = "sample_id", values: str = "outputs", tolerance: float = TOLERANCE, truncate: bool = False
) -> DataFrame:
    """One row: counts, pass rate, figures of the samples' largest differences, verdict.

    Samples of unequal length count as matched but give no difference. When no sample gives one, all figures are 0.
    One left join and one aggregate; nothing but partial sums is shuffled after the join. A sample that occurs twice in
    `b` is an error, since it would count twice; the ids alone are counted for that first.
    """
    if not b.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        raise ValueError(f"a {key} occurs twice on the right side")
    right = b.select(key, F.col(values).alias("_fm_b"), F.lit(True).alias("_fm_seen"))
    left = a.select(F.col(key), F.col(values).alias("_fm_a"))
    diff = F.array_max(abs_differences("_fm_a", "_fm_b", truncate))
    rows = left.join(right, key, "left").select("_fm_seen", diff.alias("d"))
    sums = rows.agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.count("_fm_seen").alias("seen"),
        F.count("d").alias("n"),
        F.count_if(F.col("d") <= tolerance).alias("within_tolerance"),
        F.max("d").alias("max_diff"),
        F.avg("d").alias("avg_diff"),
        F.stddev_pop("d").alias("std_diff"),
    )
    matched = F.when(F.col("n") > 0, F.col("seen")).otherwise(F.lit(0).cast("long"))
    rate = F.when(F.col("n") > 0, F.col("within_tolerance") / F.col("seen")).otherwise(F.lit(0.0))
    zero = F.lit(0.0)
    return sums.select(
        "total_samples",
        matched.alias("matched_samples"),
        "within_tolerance",
        rate.alias("pass_rate"),
        F.coalesce("max_diff", zero).alias("max_diff"),
        F.coalesce("avg_diff", zero).alias("avg_diff"),
        F.coalesce("std_diff", zero).alias("std_diff"),
        F.lit(tolerance).alias("tolerance"),
        passes(rate).alias("passed"),
    )


def passes(rate: Column) -> Column:
    return rate >= PASS_RATE


def worst_samples(rows: DataFrame, k: int = WORST_STORED, key: str = "sample_id") -> DataFrame:
    """The `k` samples with the largest difference."""
    return rows.orderBy(F.desc("max_diff"), key).limit(k)


def mean_of_means(df: DataFrame, values: str = "outputs") -> DataFrame:
    """The average over samples of each vector's average."""
    return df.agg(F.avg(array_mean(values)).alias("mean_output"))


def determinism(runs: DataFrame, key: str = "sample_id", values: str = "outputs", limit: float = REPEATABLE) -> DataFrame:
    """Per sample the largest spread of a position over repeated runs, and whether it is below the limit."""
    flat = runs.select(key, F.posexplode(doubles(F.col(values))).alias("_fm_pos", "_fm_x"))
    spread = flat.groupBy(key, "_fm_pos").agg((F.max("_fm_x") - F.min("_fm_x")).alias("_fm_spread"))
    return spread.groupBy(key).agg(F.max("_fm_spread").alias("max_spread")).withColumn("deterministic", F.col("max_spread") < limit)
