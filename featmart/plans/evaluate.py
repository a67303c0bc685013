"""Evaluating a reconstruction model on a test split."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.model import Autoencoder, linear_autoencoder, score_autoencoder
from ..operators.normalize import Normalizer, fit_normalizer, normalized_vector, normalizer_for
from ..operators.recon import error_summary, feature_errors, metric_drift, recon_rows, top_features
from ..operators.splits import SPLIT
from ..operators.staging import SAMPLE_ID
from ..sinks.tables import write_csv
from ..workdir import cut


@dataclass(frozen=True)
class Evaluation:
    """Frames and one-row figures of an evaluation."""

    summary: DataFrame
    samples: DataFrame
    features: DataFrame
    metrics: dict[str, float]

    def export(self, path: str) -> None:
        """Per-sample and per-feature errors as CSV."""
        write_csv(self.samples.select(SAMPLE_ID, F.col("mse").alias("reconstruction_error_mse")), f"{path}/error_distribution")
        write_csv(self.features.select("feature_name", "mean_squared_error"), f"{path}/feature_errors")

    def top_features(self, k: int = 10) -> DataFrame:
        return top_features(self.features, k)


def vectors(df: DataFrame, fit: Normalizer, key: str = SAMPLE_ID) -> DataFrame:
    """Normalized feature vectors by key; only the key and the features are read."""
    return df.select(key, normalized_vector(df, fit).alias("features"))


def train(df: DataFrame, features: Sequence[str], latent_dim: int = 16) -> tuple[Normalizer, Autoencoder]:
    """Fit normalizer and bottleneck on the training split only."""
    rows = df.filter(F.col(SPLIT) == "train")
    fit = fit_normalizer(rows, features)
    return fit, linear_autoencoder(vectors(rows, fit), latent_dim)


def evaluate(
    df: DataFrame, features: Sequence[str], model: Autoencoder, fit: Normalizer | None = None, trained_loss: float | None = None, split: str = "test"
) -> Evaluation:
    """Normalize, score and summarize a split, and compare with the loss known from training.

    The split filter and the column choice reach the scan. Scores are written once, since three results read them.
    """
    started = time.monotonic()
    rows = df.filter(F.col(SPLIT) == split)
    fit = normalizer_for(rows, features, fit)
    scored = cut(score_autoencoder(vectors(rows, fit), model).drop("latent"), "scores")
    summary = error_summary(scored)
    samples = recon_rows(scored)
    by_feature = feature_errors(scored, list(fit.features))
    metrics = summary.first().asDict()
    seconds = time.monotonic() - started
    metrics |= {"eval_time_seconds": seconds, "eval_throughput_samples_per_sec": metrics["eval_samples"] / seconds}
    if trained_loss:
        pair = df.sparkSession.range(1).select(F.lit(float(trained_loss)).alias("old"), F.lit(metrics["test_loss"]).alias("new"))
        drift = metric_drift(pair, "old", "new").first()
        metrics |= {"original_test_loss": drift["old"], "test_loss_diff": drift["difference"], "test_loss_pct_diff": drift["pct_difference"], "band": drift["band"]}
    return Evaluation(summary, samples, by_feature, metrics)
