import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from featmart.operators import compare, latency, quantize, recon
from featmart.sinks.results import benchmark_documents, comparison_document
from featmart.sources import results


def vectors(spark, rows, name="outputs"):
    return spark.createDataFrame(rows, f"sample_id string, {name} array<double>")


@pytest.fixture
def a(spark):
    return vectors(spark, [("s1", [1.0, 2.0]), ("s2", [1.0, 2.0, 3.0]), ("s3", [5.0]), ("s4", [0.0, 0.0])])


@pytest.fixture
def b(spark):
    return vectors(spark, [("s1", [1.0, 2.004]), ("s2", [1.0, 2.0]), ("s4", [0.0, 0.5]), ("s9", [1.0])])


def test_rows(a, b):
    rows = {r["sample_id"]: r for r in compare.compare_rows(a, b).collect()}
    assert set(rows) == {"s1", "s4"}
    assert rows["s1"]["max_diff"] == pytest.approx(0.004) and rows["s1"]["mean_diff"] == pytest.approx(0.002)
    assert rows["s1"]["mse"] == pytest.approx(0.004**2 / 2) and rows["s1"]["within_tolerance"]
    assert not rows["s4"]["within_tolerance"]
    cut = {r["sample_id"]: r["max_diff"] for r in compare.compare_rows(a, b, truncate=True).collect()}
    assert set(cut) == {"s1", "s2", "s4"} and cut["s2"] == 0.0
    assert [r[0] for r in compare.unmatched(a, b).collect()] == ["s3"]
    assert [r["sample_id"] for r in compare.worst_samples(compare.compare_rows(a, b), 1).collect()] == ["s4"]


def test_summary(a, b):
    row = compare.compare_summary(a, b).first()
    assert (row["total_samples"], row["matched_samples"], row["within_tolerance"]) == (4, 3, 1)
    assert row["pass_rate"] == pytest.approx(1 / 3) and not row["passed"]
    assert row["max_diff"] == pytest.approx(0.5) and row["avg_diff"] == pytest.approx(0.252) and row["std_diff"] == pytest.approx(0.248)


def test_summary_without_a_match(spark, a):
    for other in ([("x", [1.0])], [("s1", [1.0])]):
        row = compare.compare_summary(a, vectors(spark, other)).first()
        assert tuple(row)[:7] == (4, 0, 0, 0.0, 0.0, 0.0, 0.0) and not row["passed"]


def test_pass_rate_limit(spark):
    left = vectors(spark, [(str(i), [0.0]) for i in range(100)])
    for bad, passed in ((1, True), (2, False)):
        right = vectors(spark, [(str(i), [1.0 if i < bad else 0.01]) for i in range(100)])
        assert compare.compare_summary(left, right).first()["passed"] is passed


def test_means_and_determinism(spark, a):
    assert compare.mean_of_means(a).first()[0] == pytest.approx(np.mean([1.5, 2.0, 5.0, 0.0]))
    runs = vectors(spark, [("x", [1.0, 2.0]), ("x", [1.0, 2.0 + 5e-7]), ("y", [1.0]), ("y", [1.0 + 2e-6])])
    got = {r["sample_id"]: r["deterministic"] for r in compare.determinism(runs).collect()}
    assert got == {"x": True, "y": False}


def kotlin_percentile(values, p):
    return sorted(values)[int(p / 100.0 * (len(values) - 1))]


def test_latency(spark):
    groups = {"one": [7], "even": [5, 1, 9, 3], "odd": [2, 2, 8, 4, 100], "zero": [0, 0, 0], "many": [(i * 37) % 101 for i in range(1000)]}
    df = spark.createDataFrame([(m, v) for m, vs in groups.items() for v in vs], "model string, latency_ms long")
    rows = {r["model"]: r for r in latency.latency_statistics(df).collect()}
    for m, vs in groups.items():
        r = rows[m]
        assert (r["total_samples"], r["min_latency_ms"], r["max_latency_ms"]) == (len(vs), min(vs), max(vs))
        assert [r[f"p{p}_latency_ms"] for p in (50, 95, 99)] == [kotlin_percentile(vs, p) for p in (50, 95, 99)]
        assert r["avg_latency_ms"] == pytest.approx(np.mean(vs))
        assert r["throughput_samples_per_sec"] == pytest.approx(len(vs) * 1000 / sum(vs) if sum(vs) else 0.0)
    gate = {r["model"]: r["passed"] for r in latency.latency_gate(latency.latency_statistics(df), mean_limit=7, p99_limit=10).collect()}
    assert gate == {"one": False, "even": True, "odd": False, "zero": True, "many": False}


def scored_frame(spark, n=200, d=7, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    y = x + rng.normal(size=(n, d)) * 0.3
    rows = [(str(i), x[i].tolist(), y[i].tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "sample_id string, features array<double>, reconstructed array<double>").repartition(3), (x - y)


@pytest.mark.parametrize("finish_rows", [5, 10**6])
def test_error_summary(spark, finish_rows):
    df, d = scored_frame(spark)
    mse, by_feature = (d**2).mean(axis=1), (d**2).mean(axis=0)
    row = recon.error_summary(df, finish_rows=finish_rows).first().asDict()
    want = {
        "eval_samples": 200, "test_loss": mse.mean(), "test_mse": mse.mean(), "test_mae": np.abs(d).mean(), "test_mse_std": mse.std(ddof=1),
        "test_mse_min": mse.min(), "test_mse_max": mse.max(), "test_mse_median": np.sort(mse)[99], "test_mse_p95": np.quantile(mse, 0.95),
        "test_mse_p99": np.quantile(mse, 0.99), "test_max_feature_error": by_feature.max(), "test_min_feature_error": by_feature.min(),
    }
    assert row.keys() == want.keys()
    assert all(row[k] == pytest.approx(want[k], rel=1e-9) for k in want)


def test_feature_errors(spark):
    df, d = scored_frame(spark)
    names = [f"f{i}" for i in range(7)]
    rows = {r["feature_name"]: r["mean_squared_error"] for r in recon.feature_errors(df, names).collect()}
    assert all(rows[n] == pytest.approx(e) for n, e in zip(names, (d**2).mean(axis=0)))
    top = recon.top_features(recon.feature_errors(df, names), 3).collect()
    assert [r["feature_name"] for r in top] == [names[i] for i in np.argsort(-(d**2).mean(axis=0))[:3]]


def test_histogram(spark):
    data = np.random.default_rng(2).normal(size=500)
    df = spark.createDataFrame([(float(x),) for x in data], "v double")
    rows = recon.histogram(df, "v", 20).orderBy("bin").collect()
    counts, edges = np.histogram(data, 20)
    assert [r["count"] for r in rows] == counts.tolist()
    assert np.allclose([r["lower"] for r in rows], edges[:-1]) and np.allclose([r["upper"] for r in rows], edges[1:])
    same = recon.histogram(spark.createDataFrame([(2.0,)] * 4, "v double"), "v", 10).orderBy("bin").collect()
    assert [r["count"] for r in same] == np.histogram([2.0] * 4, 10)[0].tolist()


def test_drift(spark):
    df = spark.createDataFrame([(1.0, 1.005), (1.0, 0.96), (1.0, 1.05), (0.0, 1.0), (None, 1.0), (2.0, 2.02)], "old double, new double")
    assert [r["band"] for r in recon.metric_drift(df, "old", "new").collect()] == [
        "consistent", "minor", "significant", "not available", "not available", "minor",
    ]


@pytest.mark.parametrize("symmetric", [True, False])
@pytest.mark.parametrize("per_channel", [True, False])
def test_quantize(spark, symmetric, per_channel):
    x = np.random.default_rng(5).normal(size=(300, 4)) * [1, 10, 0.1, 0] + [0, 5, 0, 0]
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id long, features array<double>")
    fit = quantize.fit_quantizer(df, "id", n=300, per_channel=per_channel, symmetric=symmetric)
    assert len(set(fit.scale)) == (4 if per_channel else 1)
    got = quantize.quantize(df, fit).orderBy("id").collect()
    levels = np.clip(np.rint(x / fit.scale) + fit.zero, -128, 127)
    assert [list(r["quantized"]) for r in got] == levels.astype(int).tolist()
    back = (levels - fit.zero) * fit.scale
    assert np.allclose([r["restored"] for r in got], back)
    assert np.all(np.abs(back - x) <= np.array(fit.scale) * (0.5001 if symmetric else 1.0))
    errors = {r["pos"]: r for r in quantize.quantization_errors(df, fit).collect()}
    assert all(errors[i]["mean_error"] == pytest.approx(np.abs(back - x)[:, i].mean()) for i in range(4))
    assert [errors[i]["at_limit"] for i in range(4)] == [int(np.isin(levels[:, i], (-128, 127)).sum()) for i in range(4)]


def test_quantizer_sees_all_rows_and_positions(spark):
    df = spark.createDataFrame([(i, [0.5]) for i in range(300)] + [(300, [97.5])], "id long, features array<double>")
    fit = quantize.fit_quantizer(df, "id")
    assert quantize.quantization_errors(df, fit).first()["max_error"] < 1
    wider = spark.createDataFrame([(1, [0.5, 2.0])], "id long, features array<double>")
    with pytest.raises(Exception, match="1 positions"):
        quantize.quantization_errors(wider, fit).collect()


def test_latency_keeps_fractions(spark):
    df = spark.createDataFrame([("m", 0.9), ("m", 1.9)], "model string, latency_ms double")
    r = latency.latency_statistics(df).first()
    assert (r["avg_latency_ms"], r["max_latency_ms"], r["p99_latency_ms"]) == (pytest.approx(1.4), 1.9, 0.9)
    assert r["throughput_samples_per_sec"] == pytest.approx(2000 / 2.8)


def test_calibration_sample_is_repeatable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    one = {r["k"] for r in quantize.calibration_sample(df.repartition(3), "k", 50).collect()}
    two = {r["k"] for r in quantize.calibration_sample(df.repartition(7), "k", 50).collect()}
    assert one == two and len(one) == 50


# Result files

METRICS = {"totalSamples": 2, "avgLatencyMs": 1.5, "minLatencyMs": 1, "maxLatencyMs": 2, "p50LatencyMs": 1, "p95LatencyMs": 1, "p99LatencyMs": 1}
SAMPLES = [{"sampleId": "a", "latencyMs": 1, "outputs": [0.5]}, {"sampleId": "b", "latencyMs": 2, "outputs": []}]


def test_benchmark_files(spark, tmp_path):
    documents = {
        "nested": {"modelName": "nested", "deviceInfo": {"device": "d"}, "metrics": METRICS, "results": SAMPLES},
        "top": {"modelName": "top", **METRICS, "results": SAMPLES[:1]},
        "none": {"modelName": "none"},
    }
    for name, text in documents.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(text, indent=2))
    files = results.read_documents(spark, str(tmp_path))
    runs = {r["modelName"]: r for r in results.benchmark_runs(files).collect()}
    assert runs["nested"]["avgLatencyMs"] == runs["top"]["avgLatencyMs"] == 1.5
    assert runs["nested"]["device"] == "d" and runs["none"]["totalSamples"] is None
    samples = sorted(tuple(r) for r in results.benchmark_samples(files).collect())
    assert samples == [("nested", "a", 1, [0.5]), ("nested", "b", 2, []), ("top", "a", 1, [0.5])]


def test_result_set_and_expected(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"s1": [1, 2.5], "s2": []}')
    rows = results.result_rows(results.read_documents(spark, str(tmp_path))).collect()
    assert sorted((r["sample_id"], r["outputs"]) for r in rows) == [("s1", [1.0, 2.5]), ("s2", [])]
    (tmp_path / "e.json").write_text('[{"input": [1], "expected": [2]}, {"sampleId": "x", "input": [3], "expected": [4]}]')
    expected = results.expected_rows(results.read_documents(spark, str(tmp_path / "e.json"))).collect()
    assert [tuple(r) for r in expected] == [("sample_0000", [1.0], [2.0]), ("x", [3.0], [4.0])]


@pytest.mark.parametrize("per_document", [7, 10**6])
def test_benchmark_documents_round_trip(spark, per_document):
    samples = spark.range(100).select(
        F.when(F.col("id") < 70, "m1").otherwise("m2").alias("model"), F.col("id").cast("string").alias("sample_id"),
        (F.col("id") % 9).alias("latency_ms"), F.array(F.col("id").cast("float")).alias("outputs"),
    )
    device = F.struct(F.lit("d").alias("device"))
    documents = benchmark_documents(samples, device, F.lit(1).cast("long"), F.lit("p"), per_document)
    assert documents.count() == (2 if per_document > 100 else documents.count()) and (per_document > 100 or documents.count() > 10)
    back = results.benchmark_samples(documents)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in samples.collect())
    assert sorted((r["modelName"], r["totalSamples"]) for r in results.benchmark_runs(documents).collect()) == [("m1", 70), ("m2", 30)]


def test_copies_of_a_sample_spread_over_documents(spark):
    samples = spark.range(1000).selectExpr("'m' as model", "'s' as sample_id", "5L as latency_ms", "array(1f) as outputs")
    documents = benchmark_documents(samples, F.struct(F.lit("d").alias("device")), F.lit(1).cast("long"), F.lit("p"), 10)
    parsed = results.parse_benchmarks(documents).select(F.size("run.results").alias("n")).collect()
    assert sum(r["n"] for r in parsed) == 1000 and max(r["n"] for r in parsed) < 40
    assert [r["totalSamples"] for r in results.benchmark_runs(documents).collect()] == [1000]


def test_runs_of_equal_figures_stay_apart(spark):
    record = {"modelName": "m", "timestamp": 1, "metrics": {"totalSamples": 3}}
    files = spark.createDataFrame([(json.dumps(record),)] * 2, "value string")
    assert [r["totalSamples"] for r in results.benchmark_runs(files).collect()] == [3, 3]


def test_comparison_document(a, b):
    rows = comparison_document(compare.compare_summary(a, b), compare.compare_rows(a, b), "A", "B").collect()
    summary = [json.loads(r["value"]) for r in rows if r["kind"] == "summary"]
    assert len(summary) == 1 and summary[0]["source_a"] == "A" and summary[0]["matched_samples"] == 3
    assert {json.loads(r["value"])["sample_id"] for r in rows if r["kind"] == "sample"} == {"s1", "s4"}


def test_repeated_id_on_the_right_is_an_error(spark):
    a = spark.createDataFrame([("s", [1.0])], "sample_id string, outputs array<double>")
    assert compare.compare_summary(a, a).first()["total_samples"] == 1
    with pytest.raises(Exception, match="occurs twice"):
        compare.compare_summary(a, a.union(a)).collect()


def test_quantizer_leaves_nan_out_and_refuses_wide_vectors(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, [2.0, nan]), (2, [nan, -4.0]), (3, [1.0, nan]), (4, None), (5, [0.5])], "k int, features array<double>")
    fit = quantize.fit_quantizer(df, "k")
    assert fit.scale == (2.0 / 127, 4.0 / 127)
    rows = {r["k"]: r for r in quantize.quantize(df, fit).collect()}
    assert rows[1]["quantized"] == [127, None] and rows[1]["restored"] == [2.0, None] and rows[1]["quantization_error"] == 0.0
    assert rows[2]["quantized"] == [None, -127] and rows[4]["quantized"] is None and len(rows[5]["restored"]) == 1
    errors = {r["pos"]: (r["missing"], r["at_limit"], r["max_error"]) for r in quantize.quantization_errors(df, fit).collect()}
    assert errors[0][0] == 1 and errors[1] == (2, 0, 0.0)
    wide = spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "k int, features array<double>")
    with pytest.raises(Exception, match="2 positions"):
        quantize.quantize(wide, fit).collect()
    nothing = quantize.fit_quantizer(spark.createDataFrame([(1, [nan])], "k int, features array<double>"), "k", symmetric=False)
    assert nothing.scale == (1.0,)


def test_fractional_latencies_survive_their_documents(spark):
    samples = spark.createDataFrame([("m", "a", 0.9, [1.0]), ("m", "b", 1.9, [2.0]), ("w", "c", 3.0, [])], "model string, sample_id string, latency_ms double, outputs array<float>")
    device = F.struct(F.lit("d").alias("device"))
    documents = benchmark_documents(samples, device, F.lit(1).cast("long"), F.lit("p"))
    runs = {r["modelName"]: r for r in results.benchmark_runs(documents).collect()}
    assert (runs["m"]["minLatencyMs"], runs["m"]["maxLatencyMs"], runs["m"]["p99LatencyMs"], runs["w"]["p50LatencyMs"]) == (0.9, 1.9, 0.9, 3.0)
    assert {r["sample_id"]: r["latency_ms"] for r in results.benchmark_samples(documents).collect()} == {"a": 0.9, "b": 1.9, "c": 3.0}
    whole = spark.createDataFrame([('{"modelName": "m", "minLatencyMs": 7, "results": [{"sampleId": "a", "latencyMs": 7}]}',)], "value string")
    assert results.benchmark_runs(whole).first()["minLatencyMs"] == 7.0 and results.benchmark_samples(whole).first()["latency_ms"] == 7.0


def test_unknown_metrics_survive_a_round_trip(spark):
    texts = [
        '{"modelName": "m", "metrics": {"avgLatencyMs": 1.5, "energy": {"mj": [1, 2.5]}, "odd name": null}, "results": [], "host": "h"}',
        '{"modelName": "m", "metrics": {"avgLatencyMs": 1.5, "energy": {"mj": [1, 2.5]}}, "results": [], "host": "h"}',
        '{"modelName": "w", "avgLatencyMs": 2, "metrics": [1]}', "no json", None, "[1, 2]",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    found = results.unknown_metrics(df)
    want = {("m", "$.metrics.energy", '{"mj":[1,2.5]}'), ("m", "$.metrics.odd name", "null"), ("m", "$.host", '"h"')}
    assert {(r["modelName"], r["path"], r["v"]) for r in found.select("modelName", "path", F.to_json("value").alias("v")).collect()} == want and found.count() == 3
    assert "energy" in results.seen_schema(df.where("value like '%host%'"))
    samples = spark.createDataFrame([("m", "a", 0.9, [1.0]), ("w", "b", 1.0, [])], "model string, sample_id string, latency_ms double, outputs array<float>")
    more = found.where("path = '$.metrics.energy'").select(F.col("modelName").alias("model"), F.lit("energy").alias("name"), "value")
    documents = benchmark_documents(samples, F.struct(F.lit("d").alias("device")), F.lit(1).cast("long"), F.lit("p"), more=more)
    again = results.unknown_metrics(documents).select("modelName", "path", F.to_json("value").alias("v")).collect()
    assert [tuple(r) for r in again] == [("m", "$.metrics.energy", '{"mj":[1,2.5]}')]
    assert {r["modelName"]: r["minLatencyMs"] for r in results.benchmark_runs(documents).collect()} == {"m": 0.9, "w": 1.0}
