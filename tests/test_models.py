from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import featmart
from featmart.operators import model
from featmart.operators.splits import SPLIT, hash_split
from featmart.plans.evaluate import evaluate, train
from featmart.sources.synthetic import correlated_features


def frame(spark, x):
    return spark.createDataFrame([(str(i), row.tolist()) for i, row in enumerate(x)], "sample_id string, features array<double>").repartition(3)


def by_id(df, column):
    return np.array([r[column] for r in sorted(df.collect(), key=lambda r: int(r["sample_id"]))])


def test_scores_equal_the_plain_network(spark):
    net = model.Autoencoder.random(6, 2, (5, 4), seed=1)
    x = np.random.default_rng(0).normal(size=(50, 6))
    done = model.score_autoencoder(frame(spark, x), net)

    def forward(layers, h):
        for layer in layers:
            h = h @ layer.weight.T + layer.bias
            if layer.scale is not None:
                h = np.where(h > 0, h, 0)
                h = layer.scale * (h - layer.mean) / np.sqrt(layer.var + 1e-5) + layer.shift
        return h

    z = forward(net.encoder, x)
    assert [len(layer.bias) for layer in (*net.encoder, *net.decoder)] == [5, 4, 2, 4, 5, 6]
    assert np.allclose(by_id(done, "latent"), z)
    assert np.allclose(by_id(done, "reconstructed"), forward(net.decoder, z))


def test_weights_survive_json():
    net = model.Autoencoder.random(6, 2, (5,), seed=1)
    back = model.Autoencoder.from_json(net.to_json())
    x = np.ones((1, 6))
    assert np.array_equal(back.decode(back.encode(x)), net.decode(net.encode(x)))
    assert back.decoder[-1].scale is None


def test_missing_values_score_as_zero(spark):
    net = model.Autoencoder.random(2, 1, (), seed=1)
    df = spark.createDataFrame([("0", [float("nan"), 1.0]), ("1", [0.0, 1.0])], "sample_id string, features array<double>")
    z = by_id(model.score_autoencoder(df, net), "latent")
    assert np.allclose(z[0], z[1])
    nulls = spark.createDataFrame([("0", [None, 1.0])], "sample_id string, features array<double>")
    assert np.allclose(by_id(model.score_autoencoder(nulls, net), "latent")[0], z[0])
    for bad in ([1.0], None):
        with pytest.raises(Exception, match="not 2 long"):
            model.score_autoencoder(spark.createDataFrame([("0", bad)], "sample_id string, features array<double>"), net).collect()


def test_linear_bottleneck_is_the_best_one(spark):
    x = np.random.default_rng(1).normal(size=(300, 6)) @ np.diag([5, 4, 3, 0.5, 0.2, 0.1]) + 2.0
    net = model.linear_autoencoder(frame(spark, x), 3)
    got = by_id(model.score_autoencoder(frame(spark, x), net), "reconstructed")
    centred = x - x.mean(axis=0)
    u, s, v = np.linalg.svd(centred, full_matrices=False)
    best = (u[:, :3] * s[:3]) @ v[:3] + x.mean(axis=0)
    assert np.allclose(got, best, atol=1e-8)
    projected = by_id(model.project(frame(spark, x), model.fit_reconstruction(frame(spark, x), 3)), "latent")
    assert np.allclose(np.abs(projected - projected.mean(axis=0)), np.abs(centred @ v[:3].T), atol=1e-8)


def test_train_and_evaluate(spark, tmp_path):
    names = [f"f_{i}" for i in range(6)]
    df = hash_split(correlated_features(spark.range(1500).withColumnRenamed("id", "sample_id"), "sample_id", 6, 42), "sample_id")
    df = df.withColumn("sample_id", F.col("sample_id").cast("string"))
    fit, net = train(df, names, latent_dim=3)
    result = evaluate(df, names, net, fit, trained_loss=1e-9)

    data = df.toPandas().sort_values("sample_id")
    rows = data[data[SPLIT] == "train"][names].to_numpy(dtype=np.float32).astype(float)
    mean, std = rows.mean(axis=0), rows.std(axis=0) + 1e-8
    z = (rows - mean) / std
    v = np.linalg.svd(z - z.mean(axis=0), full_matrices=False)[2][:3]
    test = (data[data[SPLIT] == "test"][names].to_numpy(dtype=np.float32).astype(float) - mean) / std
    error = test - ((test - z.mean(axis=0)) @ v.T @ v + z.mean(axis=0))
    mse = (error**2).mean(axis=1)
    assert result.metrics["eval_samples"] == len(test)
    assert result.metrics["test_loss"] == pytest.approx(mse.mean(), rel=1e-6)
    assert result.metrics["test_mse_p95"] == pytest.approx(np.quantile(mse, 0.95), rel=1e-6)
    assert result.metrics["band"] == "significant" and result.metrics["eval_throughput_samples_per_sec"] > 0
    top = [r["feature_name"] for r in result.top_features(2).collect()]
    assert top == [names[i] for i in np.argsort(-(error**2).mean(axis=0))[:2]]
    result.export(str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out/error_distribution")).count() == len(test)
    assert spark.read.option("header", True).csv(str(tmp_path / "out/feature_errors")).columns == ["feature_name", "mean_squared_error"]
    unfitted = evaluate(df, names, net)
    assert "band" not in unfitted.metrics and unfitted.metrics["eval_samples"] == len(test)


def test_synthetic_features(spark):
    df = correlated_features(spark.range(4000).withColumnRenamed("id", "k"), "k", 4, 42)
    x = df.toPandas().sort_values("k")[["f_0", "f_1", "f_2", "f_3"]].to_numpy()
    assert np.allclose(x.std(axis=0), [0.5, np.hypot(0.4, 0.2)] * 2, atol=0.02)
    c = np.corrcoef(x.T)
    assert c[0, 1] == pytest.approx(0.4 / np.hypot(0.4, 0.2), abs=0.02) and abs(c[0, 2]) < 0.06
    again = correlated_features(spark.range(4000).withColumnRenamed("id", "k").repartition(7), "k", 4, 42)
    assert np.array_equal(again.toPandas().sort_values("k")[["f_0", "f_1", "f_2", "f_3"]].to_numpy(), x)


def test_dates_are_arguments():
    """No operator reads a clock: only durations of an evaluation are measured."""
    for path in Path(featmart.__file__).parent.rglob("*.py"):
        text = path.read_text()
        assert "current_timestamp" not in text and "datetime.now" not in text, path
