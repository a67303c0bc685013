"""Int8 quantization of feature vectors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import digest
from ..functions.vectors import array_mean, doubles

LOWEST, HIGHEST = -128, 127

# Calibration sample sizes of the dynamic and the static setting.
DYNAMIC_SAMPLES, STATIC_SAMPLES = 100, 200


@dataclass(frozen=True)
class Quantizer:
    """Scale and zero point per position; as many numbers as a vector has elements."""

    scale: tuple[float, ...]
    zero: tuple[int, ...]


def calibration_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """`n` rows in md5 order of their key: a repeatable sample, kept as a top-n per task."""
    return df.orderBy(digest(key), key).limit(n)


def fit_quantizer(
    df: DataFrame, key: str, features: str = "features", n: int | None = None, per_channel: bool = True, symmetric: bool = True
) -> Quantizer:
    """Scales from the smallest and largest value of each position (or of all positions), over all rows or a calibration sample of `n`.

    NaN counts as missing. A position without any value gets scale 1.
    """
    rows = df.select(key, features)
    values = (rows if n is None else calibration_sample(rows, key, n)).select(F.posexplode(features).alias("pos", "x"))
    known = _known(F.col("x").cast("double"))
    ends = values.groupBy("pos").agg(F.coalesce(F.min(known), F.lit(0.0)).alias("a"), F.coalesce(F.max(known), F.lit(0.0)).alias("b"))
    rows = sorted(ends.collect(), key=lambda r: r["pos"])
    pairs = [(r["a"], r["b"]) for r in rows]
    if not per_channel:
        pairs = [(min(a for a, _ in pairs), max(b for _, b in pairs))] * len(pairs)
    if symmetric:
        scale = [max(abs(a), abs(b)) / HIGHEST or 1.0 for a, b in pairs]
        return Quantizer(tuple(scale), tuple(0 for _ in pairs))
    # The range must hold 0 so that 0 is exact.
    pairs = [(min(a, 0.0), max(b, 0.0)) for a, b in pairs]
    scale = [(b - a) / (HIGHEST - LOWEST) or 1.0 for a, b in pairs]
    return Quantizer(tuple(scale), tuple(round(LOWEST - a / s) for (a, _), s in zip(pairs, scale)))


def _parameters(fit: Quantizer) -> Column:
    return F.array(*[F.struct(F.lit(s).alias("scale"), F.lit(z).alias("zero")) for s, z in zip(fit.scale, fit.zero)])


def _known(x: Column) -> Column:
    """A value, NaN as null."""
    return F.when(~F.isnan(x), x)


def _level(x: Column, p: Column) -> Column:
    """`round(x / scale) + zero`, half to even, clamped to the int8 range; null for a missing value."""
    level = F.rint(x / p["scale"]) + p["zero"]
    clamped = F.least(F.greatest(level, F.lit(float(LOWEST))), F.lit(float(HIGHEST))).cast("tinyint")
    return F.when(_known(x).isNotNull(), clamped)


def _value(q: Column, p: Column) -> Column:
    return (q - p["zero"]) * p["scale"]


def quantized(features: Column, fit: Quantizer) -> Column:
    """The int8 vector; a vector wider than the fit is an error."""
    wider = F.raise_error(F.concat(F.lit(f"the quantizer has {len(fit.scale)} positions, a vector has "), F.size(features).cast("string")))
    checked = F.when(F.coalesce(F.size(features), F.lit(0)) > len(fit.scale), wider).otherwise(doubles(features))
    return F.zip_with(checked, F.slice(_parameters(fit), 1, F.greatest(F.size(features), F.lit(0))), _level)


def restored(levels: Column, fit: Quantizer) -> Column:
    return F.zip_with(levels, F.slice(_parameters(fit), 1, F.greatest(F.size(levels), F.lit(0))), _value)


def quantize(df: DataFrame, fit: Quantizer, features: str = "features") -> DataFrame:
    """Append the int8 vector, the restored vector and the sample's mean absolute error over the values that are not missing."""
    made = df.withColumn("quantized", quantized(F.col(features), fit)).withColumn("restored", restored(F.col("quantized"), fit))
    error = F.zip_with(doubles(F.col(features)), F.col("restored"), lambda x, y: F.abs(x - y))
    return made.withColumn("quantization_error", array_mean(F.filter(error, lambda e: e.isNotNull() & ~F.isnan(e))))


def quantization_errors(df: DataFrame, fit: Quantizer, features: str = "features") -> DataFrame:
    """Mean and largest absolute error and numbers of clamped and of missing values per position, over all rows; a vector wider than the fit is an error."""
    flat = df.select(F.posexplode(features).alias("pos", "x")).select("pos", F.col("x").cast("double").alias("x"))
    wider = F.raise_error(F.concat(F.lit(f"the quantizer has {len(fit.scale)} positions, a vector has position "), F.col("pos").cast("string")))
    known = F.get(_parameters(fit), F.col("pos"))
    flat = flat.withColumn("p", F.when(F.col("pos") < len(fit.scale), known).otherwise(wider))
    levels = flat.withColumn("q", _level(F.col("x"), F.col("p")))
    error = F.abs(_known(F.col("x")) - _value(F.col("q"), F.col("p")))
    return levels.groupBy("pos").agg(
        F.avg(error).alias("mean_error"),
        F.max(error).alias("max_error"),
        F.count_if(F.col("q").isin(LOWEST, HIGHEST)).alias("at_limit"),
        F.count_if(_known(F.col("x")).isNull()).alias("missing"),
    )
