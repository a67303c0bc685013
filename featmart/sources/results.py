"""JSON result files: result sets, benchmark records, expected outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import as_column
from ..functions.text import padded_id
from .split_json import object_entry, read_entries

RESULT_SET = "map<string,array<double>>"

# Field names and types of a benchmark file and of an expected-output file. Latencies may be whole or have fractions.
METRIC_FIELDS = (
    "totalSamples int, avgLatencyMs double, minLatencyMs double, maxLatencyMs double, p50LatencyMs double, "
    "p95LatencyMs double, p99LatencyMs double, throughputSamplesPerSec double"
)
BENCHMARK = (
    "modelName string, modelPath string, timestamp bigint, "
    "deviceInfo struct<device string, manufacturer string, model string, sdk int, abi string, cpuCores int, totalMemoryMb bigint>, "
    f"metrics struct<{METRIC_FIELDS}>, "
    "results array<struct<sampleId string, latencyMs double, outputs array<float>>>, "
    f"{METRIC_FIELDS}"
)
# The documents of a run that was written in several parts share this one more field.
RUN_ID = "runId"
EXPECTED = "array<struct<sampleId string, input array<float>, expected array<float>>>"

_METRICS = [part.split()[0] for part in METRIC_FIELDS.split(", ")]


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """JSON files as one text value each. A file is one document, so its size is that of one result file."""
    return spark.read.text(path, wholetext=True)


def result_rows(df: DataFrame, json: Column | str = "value", id_name: str = "sample_id", values_name: str = "outputs") -> DataFrame:
    """`{id: [float]}` documents to one row per sample."""
    parsed = F.from_json(as_column(json), RESULT_SET)
    return df.select(F.explode(parsed).alias(id_name, values_name))


def large_result_rows(spark: SparkSession, path: str, id_name: str = "sample_id", values_name: str = "outputs", **options) -> DataFrame:
    """The same rows from files of any size: a document is read by as many tasks as it has byte ranges."""
    rows = read_entries(spark, path, **options)
    return result_rows(rows, object_entry(), id_name, values_name)


def large_expected_rows(spark: SparkSession, path: str, **options) -> DataFrame:
    """Expected-output files of any size, one row per sample. Samples must have ids: a task does not know how many came before its own."""
    parsed = F.from_json("entry", EXPECTED.removeprefix("array<").removesuffix(">"))
    missing = F.raise_error(F.lit("a sample of a split file has no id"))
    return read_entries(spark, path, **options).select(parsed.alias("r")).select(
        F.coalesce("r.sampleId", missing).alias("sample_id"), F.col("r.input").alias("input"), F.col("r.expected").alias("expected")
    )


def parse_benchmarks(df: DataFrame, json: Column | str = "value") -> DataFrame:
    """One row per benchmark document with a `run` struct. Metrics are read nested, else from the top level."""
    return df.withColumn("run", F.from_json(as_column(json), f"{BENCHMARK}, {RUN_ID} string"))


def benchmark_runs(df: DataFrame, json: Column | str = "value") -> DataFrame:
    """One row per run: model, device and metrics.

    Documents that share a run id are parts of one run; a document without one is a run of its own. Headers are folded before
    the shuffle, results are not parsed.
    """
    parsed = parse_benchmarks(df, json)
    metrics = [F.coalesce(F.col(f"run.metrics.{m}"), F.col(f"run.{m}")).alias(m) for m in _METRICS]
    own = F.concat(F.lit("document "), F.monotonically_increasing_id())
    key = F.coalesce(F.concat(F.lit("run "), F.col(f"run.{RUN_ID}")), own).alias("_fm_run")
    headers = parsed.select(key, "run.modelName", "run.modelPath", "run.timestamp", "run.deviceInfo.device", *metrics)
    return headers.distinct().drop("_fm_run")


def benchmark_samples(df: DataFrame, json: Column | str = "value") -> DataFrame:
    """One row per sample of every run."""
    parsed = parse_benchmarks(df, json)
    return parsed.select("run.modelName", F.explode("run.results").alias("r")).select(
        "modelName", F.col("r.sampleId").alias("sample_id"), F.col("r.latencyMs").alias("latency_ms"), F.col("r.outputs").alias("outputs")
    )


def result_fields(df: DataFrame, json: Column | str = "value", at: str = "$", keep: Sequence[str] = ()) -> DataFrame:
    """`(keep, path, value)`: the fields of the object at a path of each document, whatever a schema knows of them; values are variants.

    Documents are parsed once into VARIANT. What is no JSON, or has no object there, has no rows.
    """
    parsed = df.select(*keep, F.try_variant_get(F.try_parse_json(as_column(json)), at, "variant").alias("_fm_doc"))
    # Arrays explode too; their elements have no key.
    fields = parsed.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_fm_doc").outer()))
    return fields.where("key is not null").select(*keep, F.concat(F.lit(f"{at}."), "key").alias("path"), "value")


# Names that a benchmark document or its metrics have by the schema above.
_DOCUMENT_FIELDS = ("modelName", "modelPath", "timestamp", "deviceInfo", "metrics", "results", RUN_ID, *_METRICS)


def unknown_metrics(df: DataFrame, json: Column | str = "value") -> DataFrame:
    """`(modelName, path, value)`: metrics of benchmark documents that the schema does not know, nested or at the top level, as variants.

    A run in several documents repeats its metrics; equal ones count once.
    """
    text = as_column(json)
    named = df.select(text.alias("_fm_text"), F.try_variant_get(F.try_parse_json(text), "$.modelName", "string").alias("modelName"))
    parts = []
    for at, known in (("$.metrics", _METRICS), ("$", _DOCUMENT_FIELDS)):
        found = result_fields(named, "_fm_text", at, ["modelName"])
        parts.append(found.where(~F.col("path").isin([f"{at}.{name}" for name in known])))
    rows = parts[0].unionByName(parts[1]).select("modelName", "path", F.to_json("value").alias("value")).distinct()
    return rows.withColumn("value", F.parse_json("value"))


def seen_schema(df: DataFrame, json: Column | str = "value") -> str:
    """The schema of all documents together, as SQL text; partial schemas are merged in tasks."""
    row = df.agg(F.schema_of_variant_agg(F.try_parse_json(as_column(json))).alias("s")).first()
    return row["s"]


def expected_rows(df: DataFrame, json: Column | str = "value") -> DataFrame:
    """Expected-output documents to one row per sample; samples without an id are numbered by position."""
    parsed = F.from_json(as_column(json), EXPECTED)
    return df.select(F.posexplode(parsed).alias("pos", "r")).select(
        F.coalesce("r.sampleId", padded_id(F.col("pos"))).alias("sample_id"),
        F.col("r.input").alias("input"),
        F.col("r.expected").alias("expected"),
    )


def benchmark_struct(model: Column, path: Column, timestamp: Column, device: Column, metrics: Column, results: Column, run_id: Column) -> Column:
    """The nested benchmark record, ready for `to_json`."""
    return F.struct(
        model.alias("modelName"),
        path.alias("modelPath"),
        timestamp.alias("timestamp"),
        device.alias("deviceInfo"),
        metrics.alias("metrics"),
        results.alias("results"),
        run_id.alias(RUN_ID),
    )


def sample_struct(sample_id: Column, latency: Column, outputs: Column) -> Column:
    return F.struct(sample_id.alias("sampleId"), latency.alias("latencyMs"), outputs.alias("outputs"))

