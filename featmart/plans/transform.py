"""From raw tables to staging and mart tables in one run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.marts import fact_samples, source_dimension
from ..operators.quality import Checks, require
from ..operators.splits import SPLIT, SPLITS, hash_split
from ..operators.staging import DATA_SOURCE, SAMPLE_ID, add_sample_ids, tag_source, union_by_name
from ..sources.files import read_raw
from .versions import MAIN, Commit, VersionLog

# Table names and data sources.
STG_COMBINED = "stg_combined"
FCT_SAMPLES = "fct_malware_samples"
DIM_FAMILIES = "dim_malware_families"
FCT_TRAINING = "fct_training_dataset"
SOURCES = ("emulator", "real_device")


@dataclass(frozen=True)
class TransformConfig:
    """`raw_tables` maps a data source to its raw table below `raw_base`; times and limits are arguments, not clocks.
    `source_checks` names what a source must satisfy before it is put together with the others."""

    raw_base: str
    raw_tables: Mapping[str, str]
    run_id: str
    run_ts: datetime
    limit: int = 0
    limit_order: Sequence[str] = ()
    schemas: Mapping[str, T.StructType] = field(default_factory=dict)
    target: str = MAIN
    source_checks: Mapping[str, Checks] = field(default_factory=dict)


def stage(frames: Mapping[str, DataFrame], run_ts: datetime) -> DataFrame:
    """Tag every source and put them below each other."""
    return union_by_name([tag_source(df, source, run_ts) for source, df in frames.items()])


def run_transform(spark: SparkSession, log: VersionLog, config: TransformConfig) -> Commit | None:
    """Write the staging and mart tables in order, each from the one before as it was written, check and publish them."""
    raw = {
        source: read_raw(spark, f"{config.raw_base}/{table}", config.schemas.get(source), limit=config.limit, order_by=config.limit_order)
        for source, table in config.raw_tables.items()
    }
    unknown = sorted(set(config.source_checks) - set(raw))
    if unknown:
        raise ValueError(f"checks for unknown sources: {', '.join(unknown)}")
    for source, checks in config.source_checks.items():
        require(raw[source], checks, source)
    run = log.begin(config.run_id, config.target)
    # A limited read is sorted, so its rows have been shuffled.
    numbered = add_sample_ids(stage(raw, config.run_ts), stable_input=config.limit <= 0)
    sources = {DATA_SOURCE: list(config.raw_tables)}
    combined = run.write(STG_COMBINED, numbered, Checks(not_null=[SAMPLE_ID], unique=[SAMPLE_ID], accepted=sources))
    samples = run.write(FCT_SAMPLES, fact_samples(combined, config.run_ts), Checks(not_null=[SAMPLE_ID, "event_timestamp"], unique=[SAMPLE_ID]))
    run.write(DIM_FAMILIES, source_dimension(combined, config.run_ts), Checks(not_null=["family_id"], unique=["family_id"]))
    run.write(
        FCT_TRAINING,
        hash_split(samples, SAMPLE_ID),
        Checks(not_null=[SAMPLE_ID, SPLIT], unique=[SAMPLE_ID], accepted={SPLIT: list(SPLITS)}),
    )
    return run.publish(f"transform {config.run_id}", config.run_ts)
