"""Staging: tag sources, union them, number the samples."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import row_digest
from ..sources.files import INGESTION_TIME, timestamp_literal
from .numbering import number_by_digest

DATA_SOURCE = "data_source"
LOADED_AT = "_dbt_loaded_at"
SAMPLE_ID = "sample_id"


def tag_source(df: DataFrame, source: str, run_ts: str | datetime) -> DataFrame:
    """Add the source's name and the run's load time."""
    return df.withColumns({DATA_SOURCE: F.lit(source), LOADED_AT: timestamp_literal(run_ts)})


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; a column that a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_by_position(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by position; all frames must have as many columns."""
    return reduce(DataFrame.union, frames)


def add_sample_ids(df: DataFrame, tie: Column | None = None, stable_input: bool = True, **options) -> DataFrame:
    """Number all rows by source, ingestion time and a tie-break.

    `tie` is an md5 text; the default is that of the row's content, so numbers do not depend on file or partition layout,
    and rows that are equal in every column are interchangeable. Staged frames come straight from files, hence
    `stable_input`.
    """
    groups = [DATA_SOURCE, *([INGESTION_TIME] if INGESTION_TIME in df.columns else [])]
    tied = df.withColumn("_fm_tie", row_digest(df) if tie is None else tie)
    return number_by_digest(tied, groups, "_fm_tie", SAMPLE_ID, stable_input=stable_input, **options).drop("_fm_tie")
