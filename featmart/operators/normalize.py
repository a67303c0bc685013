"""Column statistics and normalization."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import quoted
from ..workdir import constant
from .features import cleaned_text, is_text, number_text

EPSILON = 1e-8
DIRECT_COLUMNS = 40


@dataclass(frozen=True)
class Normalizer:
    """Mean and standard deviation per feature; as many numbers as there are columns."""

    features: tuple[str, ...]
    mean: tuple[float, ...]
    std: tuple[float, ...]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = list(zip(range(len(self.features)), self.features, self.mean, self.std))
        return spark.createDataFrame(rows, "pos int, feature string, mean double, std double")

    @classmethod
    def from_frame(cls, df: DataFrame) -> Normalizer:
        rows = df.orderBy("pos").collect()
        return cls(tuple(r["feature"] for r in rows), tuple(r["mean"] for r in rows), tuple(r["std"] for r in rows))


# What null and NaN become: 0, or missing.
_ZERO = "coalesce(nanvl(cast({x} as double), 0D), 0D)"
_MISSING = "nanvl(cast({x} as double), cast(null as double))"


def _floats(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns as float32 in SQL text, not yet cleaned."""
    return [f"{'try_cast' if is_text(df, c) else 'cast'}({quoted(c)} as float)" for c in columns]


def _by_position(df: DataFrame, values: Sequence[str], finish: str, deviation: str) -> DataFrame:
    """Mean and deviation per position: rows become (position, value) pairs, and a task sends one row per position.

    Values are finished after they left the row: hundreds of conditions in one row are too much code to be compiled.
    """
    return _pairs(df, values, finish).groupBy("pos").agg(F.avg("x").alias("mean"), F.expr(f"{deviation}(x)").alias("std"))


def _pairs(df: DataFrame, values: Sequence[str], finish: str) -> DataFrame:
    pairs = df.select(F.expr(f"posexplode(array({', '.join(values)}))").alias("pos", "raw"))
    return pairs.select("pos", F.expr(finish.format(x="raw")).alias("x"))


def feature_values(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(pos, x): every feature's value of every row as the normalizer sees it, null and NaN as 0."""
    return _pairs(df, _floats(df, features), _ZERO)


def _moments(df: DataFrame, values: Sequence[str], finish: str, deviation: str) -> list[tuple[float | None, float | None]]:
    """Mean and deviation of each SQL expression. A few are plain aggregates; hundreds would be too wide for generated code."""
    if len(values) <= DIRECT_COLUMNS:
        done = [finish.format(x=v) for v in values]
        row = df.agg(*[F.expr(f"{function}({v})") for v in done for function in ("avg", deviation)]).first()
        return [(row[2 * i], row[2 * i + 1]) for i in range(len(values))]
    found = {r["pos"]: (r["mean"], r["std"]) for r in _by_position(df, values, finish, deviation).collect()}
    return [found.get(i, (None, None)) for i in range(len(values))]


def fit_normalizer(df: DataFrame, features: Sequence[str]) -> Normalizer:
    """Mean and population deviation + 1e-8 of every feature in one pass, null and NaN as 0."""
    moments = _moments(df, _floats(df, features), _ZERO, "stddev_pop")
    if any(m is None for m, _ in moments):
        raise ValueError("cannot fit a normalizer on no rows")
    return Normalizer(tuple(features), tuple(m for m, _ in moments), tuple(s + EPSILON for _, s in moments))


def _normalized_text(df: DataFrame, fit: Normalizer) -> list[str]:
    """`(x - mean) / std` per feature, with the fit's numbers as literals: a projection without any join."""
    return [
        f"(cast({cleaned_text(df, c)} as double) - {number_text(m)}) / {number_text(s)}" for c, m, s in zip(fit.features, fit.mean, fit.std)
    ]


def apply_normalizer(df: DataFrame, fit: Normalizer) -> DataFrame:
    by_name = dict(zip(fit.features, _normalized_text(df, fit)))
    return df.selectExpr(*[f"{by_name[c]} as {quoted(c)}" if c in by_name else quoted(c) for c in df.columns])


def normalized_vector(df: DataFrame, fit: Normalizer) -> Column:
    return F.expr(f"array({', '.join(_normalized_text(df, fit))})")


def normalizer_for(df: DataFrame, features: Sequence[str], saved: Normalizer | None = None) -> Normalizer:
    """The saved fit or, when there is none, one fitted on the evaluated rows."""
    return saved if saved is not None else fit_normalizer(df, features)


def column_statistics(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row per feature: mean and std as `fit_normalizer` has them. A task sends one row per feature."""
    stats = _by_position(df, _floats(df, features), _ZERO, "stddev_pop").withColumn("std", F.col("std") + EPSILON)
    return stats.select(F.get(constant(list(features), "array<string>"), F.col("pos")).alias("feature"), "mean", "std")


def zscore(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`(x - mean) / std` with the sample deviation; absent columns are skipped, a deviation of 0 gives null.

    NaN counts as missing, in the statistics and in the result.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    values = [f"cast({quoted(c)} as double)" for c in present]
    changed = {}
    for c, value, (mean, std) in zip(present, values, _moments(df, values, _MISSING, "stddev_samp")):
        missing = _MISSING.format(x=value)
        changed[c] = f"({missing} - {number_text(mean)}) / {number_text(std)}" if std else "cast(null as double)"
    return df.selectExpr(*[f"{changed[c]} as {quoted(c)}" if c in changed else quoted(c) for c in df.columns])


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum, one row per column; of all numeric columns, decimals included, if none are given.

    Values go by their position, so the plan does not grow with the columns; a task sends one row per column.
    """
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    columns = list(columns)
    values = df.selectExpr(f"posexplode(array({', '.join(f'cast({quoted(c)} as double)' for c in columns)})) as (pos, x)") if columns else None
    if values is None:
        return df.sparkSession.createDataFrame([], "column_name string, count long, mean double, std double, min double, max double")
    found = values.groupBy("pos").agg(
        F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("min"), F.max("x").alias("max")
    )
    # One row per column, also of a table without rows.
    names = df.sparkSession.range(1).select(F.posexplode(constant(columns, "array<string>")).alias("pos", "column_name"))
    return names.join(F.broadcast(found), "pos", "left").select("column_name", F.coalesce("count", F.lit(0).cast("long")).alias("count"), "mean", "std", "min", "max")
