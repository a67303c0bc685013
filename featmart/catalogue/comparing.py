"""Result files, comparisons, reconstruction, latency, models, quantization."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import padded_id
from ..operators import compare, latency, model, quantize, recon
from ..sinks.results import benchmark_documents, comparison_document
from ..sources import results
from ..workdir import cut, new_path
from .base import (
    A_SQL, B_SQL, DIFFS_SQL, FEAT_SQL, LAT_SQL, Query, feat, latencies, results_a, results_b, rounded, scored, table,
)

# Result files: a document holds the samples of a hundred ids, so documents grow in number and not in size.


def _chunk():
    return F.floor(F.col("vec_id") / 100)


def _result_documents(spark, sf_dir):
    """JSON result sets with single-precision values."""
    rows = table(spark, sf_dir, "embeddings").withColumn("chunk", _chunk())
    entry = F.struct(F.col("vec_id").cast("string").alias("k"), F.col("embedding").alias("v"))
    return rows.groupBy("chunk").agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))


def res_map_explode(spark, sf_dir):
    rows = results.result_rows(_result_documents(spark, sf_dir))
    return rows.select("sample_id", F.posexplode("outputs").alias("pos", "x")).withColumn("x", rounded(F.col("x").cast("float").cast("double"), 5))


def res_split_explode(spark, sf_dir):
    """All documents in one file, read in ranges of 64 KB."""
    path = new_path(spark, "documents")
    _result_documents(spark, sf_dir).select("value").coalesce(1).write.text(path)
    rows = results.large_result_rows(spark, path, range_bytes=1 << 16)
    return rows.select("sample_id", F.posexplode("outputs").alias("pos", "x")).withColumn("x", rounded(F.col("x").cast("float").cast("double"), 5))


_FLAT_SQL = "select vec_id, unnest(range(len(embedding))) as pos, unnest(embedding) as x from embeddings"


def expected_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").withColumn("chunk", _chunk())
    entry = F.struct(
        padded_id("vec_id").alias("sampleId"), F.slice("embedding", 1, 48).alias("input"), F.slice("embedding", 49, 16).alias("expected")
    )
    documents = rows.groupBy("chunk").agg(F.to_json(F.collect_list(entry)).alias("value"))
    parsed = results.expected_rows(documents)
    return parsed.select(
        "sample_id", F.size("input").alias("n_input"), F.size("expected").alias("n_expected"), F.posexplode(F.concat("input", "expected")).alias("pos", "x")
    ).withColumn("x", rounded(F.col("x").cast("double"), 5))


def cmp_document(spark, sf_dir):
    """The comparison as a JSON document, read again: the summary's figures and every sample's differences."""
    a, b = results_a(spark, sf_dir), results_b(spark, sf_dir)
    document = comparison_document(compare.compare_summary(a, b), compare.compare_rows(a, b), "emulator", "device")
    fields = "source_a string, source_b string, total_samples long, matched_samples long, sample_id long, max_diff double, mean_diff double, within_tolerance string, passed boolean"
    parsed = document.select("kind", F.from_json("value", fields).alias("r")).select("kind", "r.*")
    return parsed.withColumns({c: rounded(c) for c in ("max_diff", "mean_diff")})


def _benchmarks(spark, sf_dir, more=None):
    device = F.struct(
        F.lit("device").alias("device"), F.lit("maker").alias("manufacturer"), F.lit("model").alias("model"), F.lit(33).alias("sdk"),
        F.lit("arm64-v8a").alias("abi"), F.lit(8).alias("cpuCores"), F.lit(8192).cast("long").alias("totalMemoryMb"),
    )
    return benchmark_documents(latencies(spark, sf_dir), device, F.lit(1706745600000).cast("long"), F.lit("model.bin"), per_document=500, more=more)


def bench_parse(spark, sf_dir):
    """Runs, read back from their documents: one row per run, although every document repeats its header and metrics."""
    runs = results.benchmark_runs(_benchmarks(spark, sf_dir))
    return runs.select(
        "modelName", "device", "totalSamples", rounded("avgLatencyMs").alias("avgLatencyMs"), "minLatencyMs", "maxLatencyMs",
        "p50LatencyMs", "p95LatencyMs", "p99LatencyMs", rounded("throughputSamplesPerSec").alias("throughputSamplesPerSec"),
    )


def bench_to_json(spark, sf_dir):
    """Samples, read back from the documents they were written to."""
    samples = results.benchmark_samples(_benchmarks(spark, sf_dir))
    return samples.select("modelName", "sample_id", "latency_ms", rounded(F.col("outputs")[0].cast("double"), 4).alias("output"))


def bench_unknown(spark, sf_dir):
    """Metrics that the schema does not know, written beside the known ones and read back: a number, a list and an object per model."""
    by_model = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("model"))
    made = by_model.agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first"), F.max("event_id").alias("last"))
    values = {
        "warmupRuns": F.to_json(F.struct("n")), "eventIds": F.to_json(F.struct(F.array("first", "last").alias("n"))),
        "span": F.to_json(F.struct(F.struct("first", "last").alias("n"))),
    }
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.variant_get(F.parse_json(v), "$.n", "variant").alias("value")) for k, v in values.items()]))
    more = made.select("model", pairs.alias("m")).select("model", "m.name", "m.value")
    found = results.unknown_metrics(_benchmarks(spark, sf_dir, more))
    return found.select("modelName", "path", F.to_json("value").alias("value"))


_UNKNOWN_SQL = """
with m as (select event_type as model, count(*) as n, min(event_id) as a, max(event_id) as b from events group by 1)
select model as "modelName", '$.metrics.warmupRuns' as path, n::varchar as value from m
union all select model, '$.metrics.eventIds', '[' || a || ',' || b || ']' from m
union all select model, '$.metrics.span', '{"first":' || a || ',"last":' || b || '}' from m"""
_INDEX = "cast(floor({p} / 100.0::double * (n - 1)) as bigint)"


def _at(p: int) -> str:
    return f"min(case when i = {_INDEX.format(p=p)} then latency_ms end)"


_STATS_SQL = f"""
select model, max(n) as total_samples, sum(latency_ms) / max(n) as avg_latency_ms, min(latency_ms) as min_latency_ms,
       max(latency_ms) as max_latency_ms, {_at(50)} as p50_latency_ms, {_at(95)} as p95_latency_ms, {_at(99)} as p99_latency_ms,
       case when sum(latency_ms) > 0 then max(n) * 1000.0::double / sum(latency_ms) else 0.0::double end as throughput_samples_per_sec
from (select model, latency_ms, count(*) over (partition by model) as n,
             row_number() over (partition by model order by latency_ms) - 1 as i
      from ({LAT_SQL})) group by model"""
_ROUNDED_STATS = "* replace (round(avg_latency_ms, 6) as avg_latency_ms, round(throughput_samples_per_sec, 6) as throughput_samples_per_sec)"


def latency_stats(spark, sf_dir):
    stats = latency.latency_statistics(latencies(spark, sf_dir))
    return stats.withColumns({c: rounded(c) for c in ("avg_latency_ms", "throughput_samples_per_sec")})


def latency_gate(spark, sf_dir):
    return latency.latency_gate(latency_stats(spark, sf_dir), mean_limit=50, p99_limit=230)


# Comparisons


def cmp_rows(spark, sf_dir):
    rows = compare.compare_rows(results_a(spark, sf_dir), results_b(spark, sf_dir))
    return rows.withColumns({c: rounded(c) for c in ("max_diff", "mean_diff", "mse")})


def _measures(d: str) -> str:
    return f"""round(list_max({d}), 6) as max_diff, round(list_avg({d}), 6) as mean_diff,
       round(list_avg([x * x for x in {d}]), 6) as mse, list_max({d}) <= 0.01 as within_tolerance"""


def cmp_rows_trunc(spark, sf_dir):
    rows = compare.compare_rows(results_a(spark, sf_dir), results_b(spark, sf_dir), truncate=True)
    return rows.withColumns({c: rounded(c) for c in ("max_diff", "mean_diff", "mse")})


_TRUNCATED_SQL = f"""
select sample_id, {_measures('d')}
from (select sample_id, [abs(a.outputs[i] - b.outputs[i]) for i in range(1, least(len(a.outputs), len(b.outputs)) + 1)] as d
      from ({A_SQL}) a join ({B_SQL}) b using (sample_id))"""


def cmp_unmatched(spark, sf_dir):
    return compare.unmatched(results_a(spark, sf_dir), results_b(spark, sf_dir))


def cmp_summary(spark, sf_dir):
    row = compare.compare_summary(results_a(spark, sf_dir), results_b(spark, sf_dir))
    return row.withColumns({c: rounded(c) for c in ("pass_rate", "max_diff", "avg_diff", "std_diff")})


_SUMMARY_SQL = f"""
select total_samples, matched_samples, within_tolerance, round(within_tolerance / matched_samples, 6) as pass_rate,
       round(max_diff, 6) as max_diff, round(avg_diff, 6) as avg_diff, round(std_diff, 6) as std_diff, 0.01::double as tolerance,
       within_tolerance / matched_samples >= 0.99 as passed
from (select count(*) as total_samples from embeddings), (select count(*) as matched_samples from embeddings where label <> 3),
     (select count(*) filter (list_max(d) <= 0.01) as within_tolerance, max(list_max(d)) as max_diff, avg(list_max(d)) as avg_diff,
             stddev_pop(list_max(d)) as std_diff from ({DIFFS_SQL}))"""


def cmp_worst(spark, sf_dir):
    rows = compare.worst_samples(compare.compare_rows(results_a(spark, sf_dir), results_b(spark, sf_dir)))
    return rows.withColumns({c: rounded(c) for c in ("max_diff", "mean_diff", "mse")})


def cmp_mean_of_means(spark, sf_dir):
    return compare.mean_of_means(results_a(spark, sf_dir)).select(rounded("mean_output", 8).alias("mean_output"))


def determinism(spark, sf_dir):
    """Three runs: the result set twice and, as one that strayed, its rounded copy."""
    a, b = results_a(spark, sf_dir), results_b(spark, sf_dir)
    rows = compare.determinism(a.unionByName(a).unionByName(b))
    return rows.withColumn("max_spread", rounded("max_spread"))


_DETERMINISM_SQL = f"""
select sample_id, round(max(spread), 6) as max_spread, max(spread) < 1e-6 as deterministic
from (select sample_id, pos, max(x) - min(x) as spread
      from (select sample_id, unnest(range(len(outputs))) as pos, unnest(outputs) as x from ({A_SQL} union all {A_SQL} union all {B_SQL}))
      group by sample_id, pos)
group by sample_id"""


# Reconstruction


def recon_rows(spark, sf_dir):
    return recon.recon_rows(scored(spark, sf_dir)).select("sample_id", rounded("mse", 9).alias("mse"), rounded("mae", 9).alias("mae"))


_ERRORS_SQL = f"select sample_id, list_avg([x * x for x in d]) as mse, list_avg(d) as mae from ({DIFFS_SQL})"
_BY_FEATURE_SQL = f"""
select pos, cast(pos as varchar) as feature_name, avg(x * x) as mean_squared_error
from (select unnest(range(len(d)))::integer as pos, unnest(d) as x from ({DIFFS_SQL})) group by pos"""
_SUMMARY_COLUMNS = (
    "test_loss", "test_mse", "test_mae", "test_mse_std", "test_mse_min", "test_mse_max", "test_mse_median", "test_mse_p95", "test_mse_p99",
    "test_max_feature_error", "test_min_feature_error",
)


def recon_summary(spark, sf_dir):
    row = recon.error_summary(scored(spark, sf_dir))
    return row.select("eval_samples", *[rounded(c, 9).alias(c) for c in _SUMMARY_COLUMNS])


_RECON_SQL = f"""
select eval_samples, {', '.join(f'round({c}, 9) as {c}' for c in _SUMMARY_COLUMNS)}
from (select count(*) as eval_samples, avg(mse) as test_loss, avg(mse) as test_mse, avg(mae) as test_mae, stddev_samp(mse) as test_mse_std,
             min(mse) as test_mse_min, max(mse) as test_mse_max, quantile_disc(mse, 0.5) as test_mse_median,
             quantile_cont(mse, 0.95) as test_mse_p95, quantile_cont(mse, 0.99) as test_mse_p99
      from ({_ERRORS_SQL})),
     (select max(mean_squared_error) as test_max_feature_error, min(mean_squared_error) as test_min_feature_error from ({_BY_FEATURE_SQL}))"""


def recon_by_feature(spark, sf_dir):
    rows = recon.feature_errors(scored(spark, sf_dir))
    return rows.withColumn("mean_squared_error", rounded("mean_squared_error", 9))


def recon_top_features(spark, sf_dir):
    rows = recon.top_features(recon.feature_errors(scored(spark, sf_dir)), 20)
    return rows.withColumn("mean_squared_error", rounded("mean_squared_error", 9))


def error_hist(spark, sf_dir):
    rows = recon.histogram(cut(recon.recon_rows(scored(spark, sf_dir)).select("mse"), "sample-errors"), "mse")
    return rows.select("bin", rounded("lower", 9).alias("lower"), rounded("upper", 9).alias("upper"), "count")


_HIST_SQL = f"""
with e as ({_ERRORS_SQL}), r as (select min(mse) as a, max(mse) as b, (max(mse) - min(mse)) / 100 as w from e),
     c as (select least(cast(floor((mse - a) / w) as integer), 99) as bin, count(*) as n from e, r group by 1)
select cast(g.bin as integer) as bin, round(a + g.bin * w, 9) as lower, round(a + (g.bin + 1) * w, 9) as upper, coalesce(n, 0) as count
from (select unnest(range(100)) as bin) g left join c on g.bin = c.bin, r"""


def metric_drift(spark, sf_dir):
    """Per user the mean event value of the month's first half against its second half."""
    half = F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    means = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.avg(F.when(half, F.col("value"))).alias("old"), F.avg(F.when(~half, F.col("value"))).alias("new")
    )
    return recon.metric_drift(means, "old", "new").select(
        "user_id", rounded("difference").alias("difference"), rounded("pct_difference").alias("pct_difference"), "band"
    )


_DRIFT_SQL = """
select user_id, round(new - old, 6) as difference, round(pct, 6) as pct_difference,
       case when pct is null then 'not available' when abs(pct) < 1 then 'consistent' when abs(pct) < 5 then 'minor' else 'significant' end as band
from (select user_id, avg(value) filter (ts < timestamp '2024-01-16 00:00:00') as old,
             avg(value) filter (ts >= timestamp '2024-01-16 00:00:00') as new,
             case when old <> 0 then (new - old) / old * 100 end as pct
      from events group by user_id)"""


# Models

_NET = model.Autoencoder.random(64, 4, (8,), seed=42)


def ae_score(spark, sf_dir):
    rows = results_a(spark, sf_dir).withColumnRenamed("outputs", "features")
    return recon.with_errors(model.score_autoencoder(rows, _NET)).select(
        "sample_id", *[rounded(F.col("latent")[i], 6).alias(f"z_{i}") for i in range(4)], rounded("mse").alias("mse"), rounded("mae").alias("mae")
    )


def _layer_sql(layer: model.Layer, x: str) -> str:
    """One layer as a DuckDB list expression with the weights as literals."""
    outputs = []
    for i, (row, bias) in enumerate(zip(layer.weight, layer.bias)):
        y = f"list_dot_product({x}, {_list_sql(row)}) + {_number(bias)}"
        if layer.hidden:
            spread = float((layer.var[i] + 1e-5) ** 0.5)
            y = f"(greatest({y}, 0.0::double) - {_number(layer.mean[i])}) / {_number(spread)} * {_number(layer.scale[i])} + {_number(layer.shift[i])}"
        outputs.append(y)
    return f"[{', '.join(outputs)}]"


def _number(x) -> str:
    return f"({float(x)!r})::double"


def _list_sql(values) -> str:
    return f"[{', '.join(repr(float(v)) for v in values)}]::double[]"


def net_sql(net: model.Autoencoder, vectors: str) -> str:
    """`vectors` selects x0; each layer adds the next x."""
    text, name = vectors, "x0"
    for i, layer in enumerate([*net.encoder, *net.decoder], 1):
        text = f"select *, {_layer_sql(layer, name)} as x{i} from ({text})"
        name = f"x{i}"
    return text


_AE_SQL = f"""
select sample_id, {', '.join(f'round(x2[{i + 1}], 6) as z_{i}' for i in range(4))},
       round(list_avg([(x0[i] - x4[i]) * (x0[i] - x4[i]) for i in range(1, 65)]), 6) as mse,
       round(list_avg([abs(x0[i] - x4[i]) for i in range(1, 65)]), 6) as mae
from ({net_sql(_NET, A_SQL.replace("as outputs", "as x0"))})"""


def pca_recon(spark, sf_dir):
    """A linear bottleneck of width 1 fitted on two features, and each sample's error."""
    pair = F.array(*[F.col(c).cast("double") / 10 for c in ("clone", "bind")])
    rows = cut(feat(spark, sf_dir).select("sample_id", pair.alias("features")), "features")
    net = model.linear_autoencoder(rows, 1)
    errors = recon.recon_rows(model.score_autoencoder(rows, net))
    return errors.select("sample_id", rounded("mse", 5).alias("mse"), rounded("mae", 5).alias("mae"))


# Of a 2 x 2 covariance matrix the main axis has a closed form; what is left is the distance to it.
_PCA_SQL = f"""
with f as (select sample_id, clone / 10.0::double as x, bind / 10.0::double as y from ({FEAT_SQL})),
     s as (select avg(x) as mx, avg(y) as my, var_samp(x) as a, var_samp(y) as c, covar_samp(x, y) as b from f),
     e as (select *, (a + c) / 2 + sqrt(((a - c) / 2) ** 2 + b * b) as l from s),
     v as (select *, b / sqrt(b * b + (l - a) ** 2) as vx, (l - a) / sqrt(b * b + (l - a) ** 2) as vy from e),
     d as (select sample_id, vx, vy, x - mx as dx, y - my as dy, (x - mx) * vx + (y - my) * vy as z from f, v)
select sample_id, round(((dx - z * vx) ** 2 + (dy - z * vy) ** 2) / 2, 5) as mse, round((abs(dx - z * vx) + abs(dy - z * vy)) / 2, 5) as mae
from d"""


def quantize_stats(spark, sf_dir):
    """Every tenth sample's first value is NaN, which counts as missing."""
    gap = (F.col("sample_id") % 10 == 0) & F.lit(True)
    with_gaps = F.transform("outputs", lambda x, i: F.when(gap & (i == 0), F.lit(float("nan"))).otherwise(x))
    rows = results_a(spark, sf_dir).withColumn("outputs", with_gaps)
    fit = quantize.fit_quantizer(rows, "sample_id", "outputs")
    errors = quantize.quantization_errors(rows, fit, "outputs")
    return errors.withColumns({c: rounded(c, 8) for c in ("mean_error", "max_error")})


_QUANTIZE_SQL = f"""
with flat as (select sample_id, pos, case when pos = 0 and sample_id % 10 = 0 then null else x end as x
              from (select sample_id, unnest(range(64))::integer as pos, unnest(outputs) as x from ({A_SQL}))),
     fit as (select pos, greatest(abs(min(x)), abs(max(x))) / 127 as s from flat group by pos),
     q as (select pos, x, s, case when x is not null then least(greatest(round_even(x / s, 0), -128), 127) end as level from flat join fit using (pos))
select pos, round(avg(abs(x - level * s)), 8) as mean_error, round(max(abs(x - level * s)), 8) as max_error,
       count(*) filter (level in (-128, 127)) as at_limit, count(*) filter (x is null) as missing
from q group by pos"""


QUERIES = [
    Query(
        "res_map_explode", res_map_explode,
        f"select cast(vec_id as varchar) as sample_id, cast(pos as integer) as pos, round(cast(x as double), 5) as x from ({_FLAT_SQL})",
    ),
    Query(
        "res_split_explode", res_split_explode,
        f"select cast(vec_id as varchar) as sample_id, cast(pos as integer) as pos, round(cast(x as double), 5) as x from ({_FLAT_SQL})",
    ),
    Query(
        "expected_rows", expected_rows,
        """
select 'sample_' || lpad(cast(vec_id as varchar), cast(greatest(4, length(cast(vec_id as varchar))) as integer), '0') as sample_id, 48 as n_input,
       16 as n_expected, unnest(range(64))::integer as pos, round(unnest(embedding)::double, 5) as x
from embeddings""",
    ),
    Query(
        "cmp_document", cmp_document,
        f"""
select 'summary' as kind, 'emulator' as source_a, 'device' as source_b, total_samples, matched_samples, null::bigint as sample_id, max_diff, null::double as mean_diff,
       within_tolerance::varchar as within_tolerance, passed from ({_SUMMARY_SQL})
union all select 'sample', null, null, null, null, sample_id, max_diff, mean_diff, within_tolerance::varchar, null
from (select sample_id, {_measures('d')} from ({DIFFS_SQL}))""",
    ),
    Query(
        "bench_parse", bench_parse,
        f"""
select model as "modelName", 'device' as device, cast(total_samples as integer) as "totalSamples", round(avg_latency_ms, 6) as "avgLatencyMs",
       min_latency_ms as "minLatencyMs", max_latency_ms as "maxLatencyMs", p50_latency_ms as "p50LatencyMs",
       p95_latency_ms as "p95LatencyMs", p99_latency_ms as "p99LatencyMs", round(throughput_samples_per_sec, 6) as "throughputSamplesPerSec"
from ({_STATS_SQL})""",
    ),
    Query("bench_unknown", bench_unknown, _UNKNOWN_SQL),
    Query(
        "bench_to_json", bench_to_json,
        f'select model as "modelName", sample_id, latency_ms, round(cast(cast(value as float) as double), 4) as output from ({LAT_SQL})',
    ),
    Query("latency_stats", latency_stats, f"select {_ROUNDED_STATS} from ({_STATS_SQL})"),
    Query(
        "latency_gate", latency_gate,
        f"select {_ROUNDED_STATS}, avg_latency_ms < 50 and p99_latency_ms < 230 as passed from ({_STATS_SQL})",
    ),
    Query("cmp_rows", cmp_rows, f"select sample_id, {_measures('d')} from ({DIFFS_SQL})"),
    Query("cmp_rows_trunc", cmp_rows_trunc, _TRUNCATED_SQL),
    Query("cmp_unmatched", cmp_unmatched, "select vec_id as sample_id from embeddings where label = 3"),
    Query("cmp_summary", cmp_summary, _SUMMARY_SQL),
    Query("cmp_worst", cmp_worst, f"select sample_id, {_measures('d')} from ({DIFFS_SQL}) order by list_max(d) desc, sample_id limit 20"),
    Query("cmp_mean_of_means", cmp_mean_of_means, f"select round(avg(list_avg(outputs)), 8) as mean_output from ({A_SQL})"),
    Query("determinism", determinism, _DETERMINISM_SQL),
    Query("recon_rows", recon_rows, f"select sample_id, round(mse, 9) as mse, round(mae, 9) as mae from ({_ERRORS_SQL})"),
    Query("recon_summary", recon_summary, _RECON_SQL),
    Query(
        "recon_by_feature", recon_by_feature,
        f"select pos, feature_name, round(mean_squared_error, 9) as mean_squared_error from ({_BY_FEATURE_SQL})",
    ),
    Query(
        "recon_top_features", recon_top_features,
        f"select pos, feature_name, round(mean_squared_error, 9) as mean_squared_error from ({_BY_FEATURE_SQL} order by mean_squared_error desc, pos limit 20)",
    ),
    Query("error_hist", error_hist, _HIST_SQL),
    Query("metric_drift", metric_drift, _DRIFT_SQL),
    Query("ae_score", ae_score, _AE_SQL),
    Query("pca_recon", pca_recon, _PCA_SQL),
    Query("quantize_stats", quantize_stats, _QUANTIZE_SQL),
]
