"""Writing tables and files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.files import tables_by_file, with_provenance


def ensure_databases(spark: SparkSession, databases: Iterable[str], catalog: str | None = None, location: str | None = None) -> None:
    """Create databases that do not exist, each in its own folder below `location` if that is given."""
    for name in databases:
        place = f" LOCATION '{location}/{name}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {f'{catalog}.' if catalog else ''}{name}{place}")


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows while they are written, instead of running the plan again."""
    watch = Observation()
    return df.observe(watch, F.count(F.lit(1)).alias("rows")), watch


def write_table(df: DataFrame, name: str, mode: str = "overwrite", partition_by: Sequence[str] = (), provider: str | None = None) -> int:
    """Write a catalog table and return the number of rows.

    Parquet in the session catalog by default. With a `provider` such as an Iceberg catalog's, the table is created or
    replaced in one commit. Partitioned tables are rebalanced first: a partition value that holds most rows is written
    by several tasks, small ones share a task.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    counted, watch = observed(df)
    if provider is not None:
        writer = counted.writeTo(name).using(provider)
        if partition_by:
            writer = writer.partitionedBy(*[F.col(c) for c in partition_by])
        writer.append() if mode == "append" else writer.createOrReplace()
    else:
        writer = counted.write.mode(mode).format("parquet")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(name)
    return watch.get["rows"]


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], order_by: Sequence[str], buckets: int) -> int:
    """Write a catalog table whose files are dealt by key into buckets, sorted by key and `order_by` inside them; the number of rows.

    Joins and windows by these keys read it without a shuffle. One task writes a bucket, so their number is the number of tasks later.
    """
    counted, watch = observed(df.repartition(buckets, *keys))
    ordered = [*keys, *order_by]
    counted.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*ordered).saveAsTable(name)
    return watch.get["rows"]


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = ()) -> int:
    """Write Parquet files and return the number of rows."""
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    counted, watch = observed(df)
    writer = counted.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return watch.get["rows"]


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> int:
    """Replace only the partitions that `df` has rows for."""
    counted, watch = observed(df.hint("rebalance", *[F.col(c) for c in partition_by]))
    counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    return watch.get["rows"]


def drop_partitions(spark: SparkSession, path: str, column: str, values: Iterable[str]) -> None:
    """Remove partitions of a table of files, as `ALTER TABLE DROP PARTITION` does for a catalog table; absent ones are skipped."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for value in values:
        folder = hadoop.Path(f"{path.rstrip('/')}/{column}={value}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


WRITES_AT_A_TIME = 4


def write_side_by_side(frames: Mapping[str, DataFrame], target: str) -> dict[str, int]:
    """Every frame to its own folder, replacing an earlier one; some are written at the same time, so that small tables do not wait for each
    other's last task. The rows per table; the first failure is raised when the others are done."""
    with ThreadPoolExecutor(WRITES_AT_A_TIME) as pool:
        jobs = {name: pool.submit(write_parquet, df, f"{target.rstrip('/')}/{name}", "overwrite") for name, df in frames.items()}
    return {name: job.result() for name, job in jobs.items()}


def load_raw(spark: SparkSession, directory: str, target: str, run_ts: str | datetime) -> dict[str, int]:
    """Every table below a directory as a raw Parquet table with provenance columns, replacing an earlier load."""
    return write_side_by_side({name: with_provenance(df, run_ts) for name, df in tables_by_file(spark, directory).items()}, target)


def csv_to_parquet(spark: SparkSession, directory: str, target: str) -> dict[str, int]:
    """One Parquet file set per CSV file or folder of CSV parts."""
    return write_side_by_side(tables_by_file(spark, directory, formats=("csv",)), target)


def publish_layer(frames: Mapping[str, DataFrame], as_views: bool, database: str | None = None) -> None:
    """A layer as temporary views or as tables."""
    for name, df in frames.items():
        if as_views:
            df.createOrReplaceTempView(name)
        else:
            write_table(df, f"{database}.{name}" if database else name)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)
