"""Statistics that take new rows without the old ones: what is known of the old rows is a small table, and tables of parts merge.

A state has a row per feature, or per family, whatever the number of rows it stands for. New rows make a state of their own, and merging
is an aggregate of states, so any number of parts, in any order, gives the same as one pass over all rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workdir import constant
from .marts import BENIGN, family_name
from .normalize import EPSILON, Normalizer, feature_values
from .staging import DATA_SOURCE

LG_ENTRIES = 12  # theta sketches are exact up to 2^12 distinct values, and within about 3 % beyond


# Mean and deviation per feature


def moments_state(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(pos, feature, n, mean, m2): m2 is the sum of squared differences from the mean; null and NaN count as 0."""
    values = feature_values(df, features)
    state = values.groupBy("pos").agg(F.count("x").alias("n"), F.avg("x").alias("mean"), (F.var_pop("x") * F.count("x")).alias("m2"))
    return state.select("pos", F.get(constant(list(features), "array<string>"), F.col("pos")).alias("feature"), "n", "mean", "m2")


def merge_moments(*states: DataFrame) -> DataFrame:
    """One state of all parts, by Chan's formula: the parts' own spread and that of their means round the common one."""
    rows = reduce(DataFrame.unionByName, states)
    part = Window.partitionBy("pos")
    # One row per part and feature.
    total = F.sum("n").over(part)
    common = F.sum(F.col("n") / total * F.col("mean")).over(part)
    placed = rows.withColumn("_fm_total", total).where("_fm_total > 0").withColumn("_fm_common", common)
    apart = F.col("mean") - F.col("_fm_common")
    return placed.groupBy("pos", "feature").agg(
        F.sum("n").alias("n"), F.any_value("_fm_common").alias("mean"), F.sum(F.col("m2") + F.col("n") * apart * apart).alias("m2")
    )


def moments_of(state: DataFrame) -> DataFrame:
    """(feature, mean, std) as `column_statistics` has them."""
    return state.select("feature", "mean", (F.sqrt(F.col("m2") / F.col("n")) + EPSILON).alias("std"))


def normalizer_of(state: DataFrame) -> Normalizer:
    """The normalizer of all rows that a state stands for."""
    return Normalizer.from_frame(state.join(moments_of(state).select("feature", "std"), "feature"))


# Families


def family_state(samples: DataFrame, family: str = "family", sample: str = "sha256", year: str | Column = "year", lg_entries: int = LG_ENTRIES) -> DataFrame:
    """One row per family: counts, years, and a theta sketch of its distinct samples."""
    year = F.col(year) if isinstance(year, str) else year
    keyed = samples.select(family_name(family).alias("family_id"), F.col(sample).cast("string").alias("s"), F.col(DATA_SOURCE).alias("src"), year.alias("y"))
    return keyed.groupBy("family_id").agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.theta_sketch_agg("s", lg_entries).alias("samples"),
        F.count_if(F.col("src") == "emulator").alias("emulator_count"),
        F.count_if(F.col("src") == "real_device").alias("real_device_count"),
        F.min("y").alias("earliest_year"),
        F.max("y").alias("latest_year"),
    )


def merge_families(*states: DataFrame, lg_entries: int = LG_ENTRIES) -> DataFrame:
    counts = ("total_samples", "emulator_count", "real_device_count")
    return reduce(DataFrame.unionByName, states).groupBy("family_id").agg(
        *[F.sum(c).alias(c) for c in counts],
        F.theta_union_agg("samples", lg_entries).alias("samples"),
        F.min("earliest_year").alias("earliest_year"),
        F.max("latest_year").alias("latest_year"),
    )


def distinct_samples(samples: DataFrame, family: str = "family", sample: str = "sha256") -> DataFrame:
    """(family_id, sample): the exact state beside the sketch, as long as there are distinct samples."""
    return samples.select(family_name(family).alias("family_id"), F.col(sample).cast("string").alias("sample")).where("sample is not null").distinct()


def families_of(state: DataFrame, exact: DataFrame | None = None) -> DataFrame:
    """The family dimension's columns; unique_samples is the sketch's estimate, or counted where the distinct samples are given."""
    estimate = F.theta_sketch_estimate("samples")
    rows = state.withColumn("unique_samples", estimate)
    if exact is not None:
        counted = exact.distinct().groupBy("family_id").agg(F.count(F.lit(1)).alias("_fm_exact"))
        rows = state.join(counted, "family_id", "left").withColumn("unique_samples", F.coalesce("_fm_exact", F.lit(0).cast("long")))
    return rows.select(
        "family_id", (F.col("family_id") != BENIGN).alias("is_malware_family"), "total_samples", "unique_samples", "emulator_count", "real_device_count",
        "earliest_year", "latest_year", (F.col("latest_year") - F.col("earliest_year")).alias("year_span"),
    )
