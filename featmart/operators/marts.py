"""Fact and dimension tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.files import INGESTION_TIME, timestamp_literal
from .staging import DATA_SOURCE, LOADED_AT, SAMPLE_ID


def event_time(df: DataFrame, run_ts: str | datetime) -> Column:
    """The ingestion time, or the run's time where that is null or the column is absent."""
    now = timestamp_literal(run_ts)
    return F.coalesce(F.col(INGESTION_TIME), now) if INGESTION_TIME in df.columns else now


def fact_samples(staged: DataFrame, run_ts: str | datetime) -> DataFrame:
    """Samples with a text id first, then every staged column, event time and feature time."""
    return (
        staged.select(
            F.col(SAMPLE_ID).cast("string").alias(SAMPLE_ID),
            *[c for c in staged.columns if c != SAMPLE_ID],
            event_time(staged, run_ts).alias("event_timestamp"),
        )
        .withColumn("feature_timestamp", F.col(LOADED_AT))
    )


def source_dimension(staged: DataFrame, run_ts: str | datetime) -> DataFrame:
    """One row per data source, largest first. `unique_samples` repeats the count and `year_span` is 1, as published."""
    now = timestamp_literal(run_ts)
    year = F.year(INGESTION_TIME if INGESTION_TIME in staged.columns else now)
    rows = F.count(F.lit(1))
    by_source = staged.groupBy(F.col(DATA_SOURCE).alias("family_id")).agg(
        F.any_value(DATA_SOURCE).alias("family_name"),
        F.any_value(F.lit(True)).alias("is_data_source"),
        rows.alias("total_samples"),
        rows.alias("unique_samples"),
        *[F.count_if(F.col(DATA_SOURCE) == source).alias(f"{source}_count") for source in ("emulator", "real_device")],
        F.min(year).alias("earliest_year"),
        F.max(year).alias("latest_year"),
    )
    return by_source.withColumns({"year_span": F.lit(1), LOADED_AT: now}).orderBy(F.desc("total_samples"), "family_id")


BENIGN = "benign"


def family_name(family: str) -> Column:
    """A sample's family; none, or an empty name, is the benign one."""
    return F.coalesce(F.when(F.trim(F.col(family)) != "", F.col(family)), F.lit(BENIGN))


def family_dimension(
    samples: DataFrame, run_ts: str | datetime, family: str = "family", sample: str = "sha256", year: str | Column = "year"
) -> DataFrame:
    """One row per family. Samples without a family are the benign ones and form the row named `benign`."""
    year = F.col(year) if isinstance(year, str) else year
    keyed = samples.select(family_name(family).alias("family_id"), F.col(sample).alias("s"), F.col(DATA_SOURCE).alias("src"), year.alias("y"))
    grouped = keyed.groupBy("family_id").agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.count_distinct("s").alias("unique_samples"),
        F.count_if(F.col("src") == "emulator").alias("emulator_count"),
        F.count_if(F.col("src") == "real_device").alias("real_device_count"),
        F.min("y").alias("earliest_year"),
        F.max("y").alias("latest_year"),
    )
    return grouped.select(
        "family_id",
        F.col("family_id").alias("family_name"),
        (F.col("family_id") != BENIGN).alias("is_malware_family"),
        "total_samples",
        "unique_samples",
        "emulator_count",
        "real_device_count",
        "earliest_year",
        "latest_year",
        (F.col("latest_year") - F.col("earliest_year")).alias("year_span"),
        timestamp_literal(run_ts).alias(LOADED_AT),
    )


# Raw column names and the names and types the feature contract uses.
CONTRACT = {"family": ("malware_family", "string"), "year": ("first_seen_year", "bigint")}


def align_contract(df: DataFrame, contract: Mapping[str, tuple[str, str]] = CONTRACT) -> DataFrame:
    """Rename and cast the columns that the contract names; the others pass."""
    return df.select(
        *[F.col(c).cast(contract[c][1]).alias(contract[c][0]) if c in contract else F.col(c) for c in df.columns]
    )
