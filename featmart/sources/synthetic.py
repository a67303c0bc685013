"""Synthetic features for load tests."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import digest, digest_number

# The spread of the base columns, and weight and noise of the columns that follow their left neighbour.
SPREAD, FOLLOW, NOISE = 0.5, 0.8, 0.2


def uniform(key: Column, seed: int, stream: str) -> Column:
    """A number in (0, 1) that is a function of seed, stream and key, wherever a row is processed."""
    return (digest_number(digest(F.lit(seed), F.lit(stream), key)) + F.lit(0.5)) / F.lit(float(2**32))


def normal(key: Column, seed: int, stream: str) -> Column:
    """A standard normal number by the Box-Muller formula."""
    radius = F.sqrt(F.lit(-2.0) * F.log(uniform(key, seed, f"{stream}a")))
    return radius * F.cos(F.lit(2 * math.pi) * uniform(key, seed, f"{stream}b"))


def correlated_features(keys: DataFrame, key: str, columns: int, seed: int) -> DataFrame:
    """One row of features per key: even columns are noise, odd ones follow their left neighbour."""
    base = keys.select(key)
    made = {}
    for i in range(columns):
        noise = normal(F.col(key), seed, str(i))
        if i % 2 == 0:
            made[f"f_{i}"] = F.lit(SPREAD) * noise
        else:
            made[f"f_{i}"] = F.lit(FOLLOW) * made[f"f_{i - 1}"] + F.lit(NOISE) * noise
    return base.withColumns(made)
