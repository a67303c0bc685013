"""Result files: benchmark records and comparison summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import digest
from ..operators.compare import worst_samples
from ..operators.latency import latency_statistics
from ..sources.results import METRIC_FIELDS, benchmark_struct, sample_struct
from ..workdir import cut, small_side

SAMPLES_PER_DOCUMENT = 10_000


def metrics_struct() -> Column:
    """The metrics block of a benchmark record, from the columns of `latency_statistics`."""
    return F.struct(
        F.col("total_samples").cast("int").alias("totalSamples"),
        F.col("avg_latency_ms").alias("avgLatencyMs"),
        F.col("min_latency_ms").alias("minLatencyMs"),
        F.col("max_latency_ms").alias("maxLatencyMs"),
        F.col("p50_latency_ms").alias("p50LatencyMs"),
        F.col("p95_latency_ms").alias("p95LatencyMs"),
        F.col("p99_latency_ms").alias("p99LatencyMs"),
        F.col("throughput_samples_per_sec").alias("throughputSamplesPerSec"),
    )


def metrics_names() -> list[str]:
    return [part.split()[0] for part in METRIC_FIELDS.split(", ")]


def _as_object(known: Column, names: Sequence[str], more: Column) -> Column:
    """A struct's fields and a map's variants as one variant object."""
    have = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.parse_json(F.to_json(F.struct(known[n].alias("v")))) for n in names]))
    values = F.transform_values(have, lambda _, v: F.variant_get(v, "$.v", "variant"))
    return F.to_variant_object(F.when(more.isNull(), values).otherwise(F.map_concat(values, more)))


def benchmark_documents(
    samples: DataFrame, device: Column, timestamp: Column, model_path: Column, per_document: int = SAMPLES_PER_DOCUMENT, more: DataFrame | None = None
) -> DataFrame:
    """Benchmark records as JSON text, from rows `(model, sample_id, latency_ms, outputs)`.

    A run of more than `per_document` samples becomes several documents with the same header and metrics and about that
    many samples each, so no task ever holds a whole run. They share a run id, a digest of the header, by which readers see
    one run. Samples are dealt by their place, so that copies of one id spread over the documents too. `more` gives further metrics,
    rows `(model, name, value)` with values as variants, which stand beside the known ones.
    """
    stats = latency_statistics(samples).withColumn("_fm_parts", F.ceil(F.col("total_samples") / F.lit(per_document)))
    header = cut(stats.select("model", "_fm_parts", metrics_struct().alias("metrics")), "benchmark-headers")
    placed = samples.withColumn("_fm_place", F.monotonically_increasing_id())
    joined = placed.join(small_side(header), "model")
    part = F.pmod(F.xxhash64("_fm_place"), F.col("_fm_parts")).alias("part")
    sample = sample_struct(F.col("sample_id"), F.col("latency_ms"), F.col("outputs"))
    grouped = joined.groupBy("model", part).agg(F.first("metrics").alias("metrics"), F.collect_list(sample).alias("results"))
    metrics = F.col("metrics")
    if more is not None:
        pairs = F.map_from_entries(F.collect_list(F.struct("name", "value")))
        grouped = grouped.join(small_side(cut(more.groupBy("model").agg(pairs.alias("_fm_more")), "more-metrics")), "model", "left")
        metrics = _as_object(F.col("metrics"), metrics_names(), F.col("_fm_more"))
    header = F.struct(F.col("model").alias("model"), model_path.alias("path"), timestamp.alias("time"), device.alias("device"), F.col("metrics").alias("metrics"))
    record = benchmark_struct(F.col("model"), model_path, timestamp, device, metrics, F.col("results"), digest(F.to_json(header)))
    return grouped.select("model", "part", F.to_json(record).alias("value"))


def comparison_document(summary: DataFrame, rows: DataFrame, source_a: str, source_b: str, worst: int | None = None) -> DataFrame:
    """A comparison as JSON: the summary and, one row each, its samples (only the `worst` ones, if that is given).

    Rows are `(kind, value)`: one of kind `summary`, the others of kind `sample`.
    """
    names = [F.lit(source_a).alias("source_a"), F.lit(source_b).alias("source_b")]
    head = summary.select(F.lit("summary").alias("kind"), F.to_json(F.struct(*names, *summary.columns)).alias("value"))
    body = rows if worst is None else worst_samples(rows, worst)
    return head.unionByName(body.select(F.lit("sample").alias("kind"), F.to_json(F.struct(*rows.columns)).alias("value")))
