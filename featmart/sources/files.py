"""Raw files: scans, provenance, inventories."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import table_name

SOURCE_FILE = "_source_file"
INGESTION_TIME = "_ingestion_timestamp"


def timestamp_literal(moment: str | datetime) -> Column:
    """A run's one timestamp. A zone-free literal, so the session's time zone does not move it."""
    text = moment if isinstance(moment, str) else moment.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(text).cast("timestamp_ntz")


def read_files(spark: SparkSession, directory: str, fmt: str, schema: T.StructType | None = None, pattern: str | None = None) -> DataFrame:
    """All files of one format below a directory. Give a schema: inferring one from CSV reads the data twice."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern or f"*.{fmt}")
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", schema is None)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.format(fmt).load(directory)


def list_files(spark: SparkSession, directory: str, pattern: str = "*") -> DataFrame:
    """Key, size and time of every file below a directory; file contents are pruned from the scan."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(directory)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )


def inventory(spark: SparkSession, directory: str, pattern: str = "*", max_objects: int | None = None) -> DataFrame:
    """The listing by path; `max_objects` shows the first ones only."""
    listing = list_files(spark, directory, pattern).withColumn("table_name", table_name("path"))
    return listing if max_objects is None else listing.orderBy("path").limit(max_objects)


def inventory_summary(spark: SparkSession, directory: str, pattern: str = "*") -> DataFrame:
    """Number and bytes of the files per folder."""
    folder = F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
    return (
        list_files(spark, directory, pattern)
        .groupBy(folder.alias("folder"))
        .agg(F.count(F.lit(1)).alias("objects"), F.sum("length").alias("bytes"))
    )


PARTS = r"/part-[^/]*$"


def tables_by_file(spark: SparkSession, directory: str, formats: Iterable[str] = ("parquet", "csv")) -> dict[str, DataFrame]:
    """One frame per table, Parquet before CSV. A table is a file, named after it, or a folder of part files, named after the folder.

    One listing finds the tables of a format, and only their names and places reach the driver. The files of a table are one scan, with
    the columns of all of them: Parquet schemas are merged from the footers, in tasks.
    """
    tables: dict[str, DataFrame] = {}
    for fmt in formats:
        place = F.when(F.col("path").rlike(PARTS), F.regexp_replace("path", PARTS, "")).otherwise(F.col("path"))
        places = list_files(spark, directory, f"*.{fmt}").select(place.alias("path")).distinct()
        for row in places.select("path", table_name("path").alias("name")).orderBy("path").toLocalIterator():
            if row["name"] in tables:
                raise ValueError(f"two files give the table name {row['name']}: {row['path']}")
            reader = spark.read.format(fmt).option("pathGlobFilter", f"*.{fmt}")
            if fmt == "csv":
                reader = reader.option("header", True).option("inferSchema", True).option("enforceSchema", False)
            else:
                reader = reader.option("mergeSchema", True)
            tables[row["name"]] = reader.load(row["path"])
    return tables


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def with_provenance(df: DataFrame, run_ts: str | datetime) -> DataFrame:
    """Add the source file's name and the run's timestamp. `df` must come straight from a file scan."""
    return df.withColumns({SOURCE_FILE: F.col("_metadata.file_name"), INGESTION_TIME: timestamp_literal(run_ts)})


def first_rows(df: DataFrame, limit: int, order_by: Iterable[str]) -> DataFrame:
    """The repeatable test limit: the first rows by a key; 0 means all. Spark keeps `limit` rows per task, not a sort."""
    return df if limit <= 0 else df.orderBy(*order_by).limit(limit)


def read_raw(
    spark: SparkSession,
    directory: str,
    schema: T.StructType | None = None,
    pattern: str = "*",
    limit: int = 0,
    order_by: Iterable[str] = (),
) -> DataFrame:
    """A raw table's compressed JSON lines or, where there are none, its Parquet files.

    The folder's listing decides, so a broken JSON file is an error and not a silent fall back.
    """
    fmt, suffix = ("json", ".jsonl.gz") if has_files(spark, directory, f"{pattern}.jsonl.gz") else ("parquet", ".parquet")
    reader = spark.read.option("pathGlobFilter", f"{pattern}{suffix}")
    df = (reader.schema(schema) if schema is not None else reader).format(fmt).load(directory)
    return first_rows(df, limit, order_by or df.columns)


def has_files(spark: SparkSession, path: str, pattern: str) -> bool:
    """Whether an existing folder has files of that name. The listing is read, not the files."""
    return not spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path").isEmpty()


def data_files(df: DataFrame) -> DataFrame:
    """Per file of a table: path, format, rows and bytes. The row count reads file footers or one narrow pass."""
    meta = df.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size_in_bytes"),
    )
    return (
        meta.groupBy("file_path", "file_size_in_bytes")
        .agg(F.count(F.lit(1)).alias("record_count"))
        .withColumn("file_format", F.upper(F.regexp_extract("file_path", r"\.([^.]+)$", 1)))
    )


def read_table(spark: SparkSession, name: str, limit: int = 0, order_by: Iterable[str] = ()) -> DataFrame:
    df = spark.table(name)
    return first_rows(df, limit, order_by or df.columns)


def run_query(spark: SparkSession, text: str, **args) -> DataFrame:
    """SQL text with named parameters."""
    return spark.sql(text, args=args or None)
