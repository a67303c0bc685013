"""Cutting lineage on shared storage.

A frame that several later steps read, or whose partition layout must stay fixed between two passes, is written once as
Parquet below the folder named by `spark.checkpoint.dir` and read back. The copy outlives lost executors, and because it
is columnar a later pass reads only the columns it needs.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"
_local_scratch: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    On a cluster the setting is required: a machine-local folder would be lost with its machine. Only a local master,
    where driver and executors share one disk, gets a scratch folder when nothing is set.
    """
    context = spark.sparkContext
    base = spark.conf.get(SETTING, None)
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError(f"{SETTING} must name a folder that every executor can reach")
        if context.applicationId not in _local_scratch:
            _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="featmart-")
        base = _local_scratch[context.applicationId]
    return f"{base.rstrip('/')}/featmart/{context.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write `df` to a fresh folder and read it back."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Mark a cut frame for broadcast when a count shows that it has at most `max_rows` narrow rows.

    A larger frame is returned as it is and joins by shuffle.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def make_folder(spark: SparkSession, path: str) -> str:
    """Make sure that a ledger's folder exists, so that reading it before the first entry gives no rows."""
    # Names with a leading underscore are not data for Spark's readers.
    spark.range(1).write.mode("ignore").json(f"{path}/_format")
    return path


def append_entry(spark: SparkSession, path: str, columns: Mapping[str, Column], mode: str) -> None:
    """Write one ledger row, given as constant columns, as one small file."""
    spark.range(1).coalesce(1).select(*[c.alias(n) for n, c in columns.items()]).write.mode(mode).json(path)


def constant(value, ddl: str) -> Column:
    """A constant of a nested type; the optimizer folds it once, tasks only see the value."""
    return F.from_json(F.lit(json.dumps(value)), ddl)


def text_map(values: Mapping[str, str]) -> Column:
    """A constant map."""
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
