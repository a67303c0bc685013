import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from featmart.operators import selection

CASES = {
    "normal": lambda rng: rng.normal(size=5000),
    "copies": lambda rng: np.where(rng.random(5000) < 0.4, 1.5, rng.random(5000)),
    "outliers": lambda rng: np.concatenate([rng.random(4990), 10.0 ** rng.integers(5, 300, 10)]),
    "constant": lambda rng: np.full(5000, 3.0),
    "few": lambda rng: rng.integers(0, 4, 5000).astype(float),
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("finish_rows", [10, 1_000_000])
def test_order_statistics(spark, case, finish_rows):
    data = CASES[case](np.random.default_rng(3))
    df = spark.createDataFrame([(float(x),) for x in data], "v double").repartition(5)
    ranks = [0, 1, 1234, 2500, 4749, 4999]
    found = selection.order_statistics(df, "v", {str(r): (None, r) for r in ranks}, finish_rows=finish_rows, accuracy=100)
    assert found == {str(r): np.sort(data)[r] for r in ranks}


def test_fall_back_to_numbering(spark):
    df = spark.range(5000).select(F.col("id").cast("double").alias("v"))
    found = selection.order_statistics(df, "v", {"m": (None, 2500)}, finish_rows=10, max_rounds=0)
    assert found == {"m": 2500.0}


def test_filters_and_nulls(spark):
    df = spark.range(100).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("v"), (F.col("id") < 50).alias("low"))
    found = selection.order_statistics(df, "v", {"a": (F.col("low"), 24), "b": (~F.col("low"), 0)})
    assert found == {"a": 48, "b": 50}
    with pytest.raises(ValueError):
        selection.order_statistics(df, "v", {"a": (F.col("low"), 25)})


def test_quantiles(spark):
    data = np.random.default_rng(4).normal(size=997)
    df = spark.createDataFrame([(float(x),) for x in data], "v double")
    found = selection.quantiles(df, "v", {"p95": 0.95, "p99": 0.99, "p0": 0.0, "p1": 1.0}, len(data))
    for name, share in {"p95": 95, "p99": 99, "p0": 0, "p1": 100}.items():
        assert math.isclose(found[name], np.percentile(data, share), rel_tol=1e-12)
