"""Scoring and fitting reconstruction models."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import doubles


@dataclass(frozen=True)
class Layer:
    """A linear map and, for hidden layers, ReLU and batch normalization with running statistics.

    `weight` is (outputs x inputs). `scale`, `shift`, `mean`, `var` are the batch normalization's numbers.
    """

    weight: np.ndarray
    bias: np.ndarray
    scale: np.ndarray | None = None
    shift: np.ndarray | None = None
    mean: np.ndarray | None = None
    var: np.ndarray | None = None

    @property
    def hidden(self) -> bool:
        return self.scale is not None

    def __call__(self, x: np.ndarray) -> np.ndarray:
        y = x @ self.weight.T + self.bias
        if not self.hidden:
            return y
        return (np.maximum(y, 0.0) - self.mean) / np.sqrt(self.var + 1e-5) * self.scale + self.shift

    def to_dict(self) -> dict:
        fields = ("weight", "bias", "scale", "shift", "mean", "var")
        return {f: np.asarray(getattr(self, f)).tolist() for f in fields if getattr(self, f) is not None}

    @classmethod
    def from_dict(cls, data: dict) -> Layer:
        return cls(**{k: np.asarray(v, dtype=float) for k, v in data.items()})


@dataclass(frozen=True)
class Autoencoder:
    """Weights of an encoder and its mirrored decoder. Their size depends on layer widths, not on rows."""

    encoder: tuple[Layer, ...]
    decoder: tuple[Layer, ...]

    def encode(self, x: np.ndarray) -> np.ndarray:
        for layer in self.encoder:
            x = layer(x)
        return x

    def decode(self, z: np.ndarray) -> np.ndarray:
        for layer in self.decoder:
            z = layer(z)
        return z

    def to_json(self) -> str:
        return json.dumps({"encoder": [x.to_dict() for x in self.encoder], "decoder": [x.to_dict() for x in self.decoder]})

    @classmethod
    def from_json(cls, text: str) -> Autoencoder:
        data = json.loads(text)
        return cls(*[tuple(Layer.from_dict(x) for x in data[side]) for side in ("encoder", "decoder")])

    @classmethod
    def random(cls, input_dim: int, latent_dim: int, hidden_dims: Sequence[int], seed: int) -> Autoencoder:
        """Seeded starting weights with the given widths."""
        rng = np.random.RandomState(seed)

        def build(widths: Sequence[int]) -> tuple[Layer, ...]:
            layers = []
            for i, (n_in, n_out) in enumerate(zip(widths, widths[1:])):
                weight = rng.standard_normal((n_out, n_in)) / np.sqrt(n_in)
                bias = rng.standard_normal(n_out) * 0.1
                if i == len(widths) - 2:
                    layers.append(Layer(weight, bias))
                else:
                    layers.append(
                        Layer(weight, bias, rng.uniform(0.5, 1.5, n_out), rng.standard_normal(n_out) * 0.1,
                              rng.standard_normal(n_out) * 0.1, rng.uniform(0.5, 1.5, n_out))
                    )
            return tuple(layers)

        widths = [input_dim, *hidden_dims, latent_dim]
        return cls(build(widths), build(widths[::-1]))


def score_autoencoder(df: DataFrame, model: Autoencoder, features: str = "features") -> DataFrame:
    """Append the latent vector and the reconstruction, one matrix product per layer and Arrow batch.

    Vectors go from Arrow's buffers to a matrix and back without a Python object per row; rows are neither shuffled nor
    gathered. Null and NaN elements count as 0; every row must have a vector of the model's width.
    """
    width = model.encoder[0].weight.shape[1]
    doubles_type = T.ArrayType(T.DoubleType())
    schema = T.StructType([*df.schema.fields, T.StructField("latent", doubles_type), T.StructField("reconstructed", doubles_type)])
    place = df.columns.index(features)

    def rows_of(matrix: np.ndarray) -> pa.Array:
        n, m = matrix.shape
        return pa.ListArray.from_arrays(np.arange(0, n * m + 1, m, dtype=np.int32), np.ascontiguousarray(matrix).ravel())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place)
            lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
            if (lengths != width).any():
                raise ValueError(f"a feature vector is not {width} long")
            x = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)
            z = model.encode(np.nan_to_num(x, nan=0.0))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, rows_of(z), rows_of(model.decode(z))], names=[*batch.schema.names, "latent", "reconstructed"]
            )

    return df.mapInArrow(score, schema)


def fit_reconstruction(df: DataFrame, k: int = 16, features: str = "features") -> PCAModel:
    """The best linear bottleneck of width `k` under squared error, which principal components span.

    Fitting is one distributed pass that adds up a features x features matrix. The result is the same whatever the
    rows' mean; `features` should be normalized.
    """
    vectors = df.select(array_to_vector(doubles(F.col(features))).alias("v"))
    return PCA(k=k, inputCol="v", outputCol="z").fit(vectors)


def linear_autoencoder(df: DataFrame, k: int = 16, features: str = "features") -> Autoencoder:
    """The fitted components as a model without hidden layers; encoding centres on the mean of the rows."""
    components = fit_reconstruction(df, k, features).pc.toArray()
    # By position: a task sends a row per feature, and no row is wider than generated code can take.
    places = df.select(F.posexplode(doubles(F.col(features))).alias("pos", "x")).groupBy("pos").agg(F.avg("x").alias("mean"))
    mean = np.zeros(components.shape[0])
    for row in places.collect():
        mean[row["pos"]] = row["mean"]
    return Autoencoder((Layer(components.T, -components.T @ mean),), (Layer(components, mean),))


def project(df: DataFrame, model: PCAModel, features: str = "features") -> DataFrame:
    """Append the latent vector of a fitted model, computed in the JVM."""
    vectors = df.withColumn("v", array_to_vector(doubles(F.col(features))))
    return model.transform(vectors).withColumn("latent", vector_to_array("z")).drop("v", "z")
