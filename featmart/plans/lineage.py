"""Run lineage: parameters, metrics and tags of runs, and model versions, as tables."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import schema_hash
from ..operators.latest import latest_per_key, newest_of_all
from ..sources.files import timestamp_literal
from ..workdir import append_entry, make_folder, text_map

_ENTRY = "run_id string, kind string, key string, value string, logged_at timestamp_ntz"
_MODEL = "model string, version string, stage string, run_id string"


class RunLog:
    """`(run_id, kind, key, value, logged_at)` rows; kind is param, metric or tag. The newest value of a key counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        for part in ("entries", "models"):
            make_folder(spark, f"{self.path}/{part}")

    def log(self, run_id: str, kind: str, values: Mapping, logged_at) -> None:
        texts = {str(k): v if isinstance(v, str) else json.dumps(v) for k, v in values.items()}
        if not texts:
            return
        rows = self.spark.range(1).coalesce(1).select(
            F.lit(run_id).alias("run_id"),
            F.lit(kind).alias("kind"),
            F.explode(text_map(texts)).alias("key", "value"),
            timestamp_literal(logged_at).alias("logged_at"),
        )
        rows.write.mode("append").json(f"{self.path}/entries")

    def log_params(self, run_id: str, values: Mapping, logged_at) -> None:
        self.log(run_id, "param", values, logged_at)

    def log_metrics(self, run_id: str, values: Mapping[str, float], logged_at) -> None:
        self.log(run_id, "metric", {k: float(v) for k, v in values.items()}, logged_at)

    def set_tags(self, run_id: str, values: Mapping[str, str], logged_at) -> None:
        self.log(run_id, "tag", values, logged_at)

    def log_dataset(self, run_id: str, df: DataFrame, counts: Mapping[str, int], features: Sequence[str], commit_id: str, logged_at) -> None:
        """What a run was trained on: data version, rows per split, feature names and schema hash."""
        params = {
            "data/commit": commit_id,
            "data/feature_names": list(features),
            "data/feature_schema_hash": schema_hash(df.select(*features).schema),
            **{f"data/{split}_samples": n for split, n in counts.items()},
        }
        self.log_params(run_id, params, logged_at)

    def entries(self) -> DataFrame:
        return self.spark.read.schema(_ENTRY).json(f"{self.path}/entries")

    def params(self, run_id: str) -> dict[str, str]:
        rows = newest_values(self.entries().filter((F.col("run_id") == run_id) & (F.col("kind") == "param")))
        return {r["key"]: r["value"] for r in rows.collect()}

    def register_model(self, model: str, run_id: str, stage: str = "None") -> int:
        """Add the next version of a model."""
        last = latest_versions(self.models().filter(F.col("model") == model)).first()
        version = 1 if last is None else last["version"] + 1
        entry = {"model": F.lit(model), "version": F.lit(str(version)), "stage": F.lit(stage), "run_id": F.lit(run_id)}
        append_entry(self.spark, f"{self.path}/models", entry, "append")
        return version

    def models(self) -> DataFrame:
        return self.spark.read.schema(_MODEL).json(f"{self.path}/models")

    def run_of_model(self, model: str, version: str) -> str:
        row = find_model(self.models(), model, version).first()
        if row is None:
            raise ValueError(f"no version {version} of {model}")
        return row["run_id"]


def newest_values(entries: DataFrame, order: Sequence[str] = ("logged_at",)) -> DataFrame:
    """The newest value of each run's key."""
    return latest_per_key(entries, ["run_id", "key"], order[0], order[1:]).select("run_id", "key", "value")


def run_table(entries: DataFrame, keys: Mapping[str, str], order: Sequence[str] = ("logged_at",)) -> DataFrame:
    """One row per run with a column per key: `keys` maps keys to column names.

    Entries are reduced to the newest one per run and wanted key without sorting them, and these few are put side by side.
    A run without any of the keys has nulls.
    """
    # Other keys count as one, so that every run stays.
    wanted = F.when(F.col("key").isin(list(keys)), F.col("key"))
    newest = latest_per_key(entries.withColumn("key", wanted), ["run_id", "key"], order[0], order[1:])
    pairs = F.collect_list(F.when(F.col("key").isNotNull(), F.struct("key", "value")))
    found = newest.groupBy("run_id").agg(F.map_from_entries(pairs).alias("_fm_values"))
    return found.select("run_id", *[F.col("_fm_values")[k].alias(n) for k, n in keys.items()])


def latest_versions(models: DataFrame, model: str = "model", version: str | Column = "version") -> DataFrame:
    """The largest whole-number version of each model; text that is no number is left out."""
    number = (F.col(version) if isinstance(version, str) else version).try_cast("int")
    return models.groupBy(model).agg(F.max(number).alias("version")).filter(F.col("version").isNotNull())


# Model stages.
STAGES = ("production", "staging", "none", "archived")


def find_model(models: DataFrame, model: str, version: str) -> DataFrame:
    """A model's version by number, or its newest one in a stage."""
    mine = models.filter(F.col("model") == model)
    if version.lower() in STAGES:
        in_stage = mine.filter(F.lower("stage") == version.lower())
        numbered = in_stage.withColumn("_fm_version", F.col("version").try_cast("int")).filter(F.col("_fm_version").isNotNull())
        return newest_of_all(numbered, ["_fm_version"]).drop("_fm_version")
    return mine.filter(F.col("version") == version)
