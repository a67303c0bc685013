"""Mergeable statistics against one pass, and the SQL functions against the Python macros."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from featmart.functions.sql_functions import FUNCTIONS, register_functions
from featmart.operators import mergeable, normalize
from featmart.sources.files import run_query

FEATURES = ["a", "b c"]


def test_moments_of_parts_are_those_of_all_rows(spark):
    """Parts of different size, far from zero, one without rows and one of a single row; merged in two orders."""
    rng = random.Random(3)
    rows = [(i, None if i % 17 == 0 else float("nan") if i % 19 == 0 else 1e6 + rng.random(), rng.randint(0, 5)) for i in range(900)]
    df = spark.createDataFrame(rows, "i int, a double, `b c` int")
    parts = [df.where("i = 0"), df.where("i > 0 and i < 100"), df.where("i >= 100"), df.where("i < 0")]
    states = [mergeable.moments_state(p, FEATURES).cache() for p in parts]
    one = {r["feature"]: (r["mean"], r["std"]) for r in normalize.column_statistics(df, FEATURES).collect()}
    for merged in (mergeable.merge_moments(*states), mergeable.merge_moments(states[3], mergeable.merge_moments(states[2], states[0]), states[1])):
        got = {r["feature"]: (r["mean"], r["std"]) for r in mergeable.moments_of(merged).collect()}
        assert got.keys() == one.keys()
        for f in one:
            assert got[f] == pytest.approx(one[f], rel=1e-9)
        assert {r["n"] for r in merged.collect()} == {900}
    fit = mergeable.normalizer_of(mergeable.merge_moments(*states))
    want = normalize.fit_normalizer(df, FEATURES)
    assert fit.features == want.features and np.allclose(fit.mean, want.mean) and np.allclose(fit.std, want.std)
    assert mergeable.merge_moments(states[3]).collect() == []


def test_families_merge(spark):
    """Copies of a sample in two parts count once; beyond the sketch's size the estimate is close and the exact state is exact."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "f").when(F.col("id") % 3 == 1, " ").alias("family"), F.md5((F.col("id") % 20_000).cast("string")).alias("sha256"),
        (F.col("id") % 9).alias("year"), F.when(F.col("id") % 2 == 0, "emulator").otherwise("real_device").alias("data_source"),
    )
    parts = [rows.where("year < 3"), rows.where("year >= 3")]
    state = mergeable.merge_families(*[mergeable.family_state(p) for p in parts])
    exact = mergeable.distinct_samples(parts[0]).union(mergeable.distinct_samples(parts[1]))
    got = {r["family_id"]: r.asDict() for r in mergeable.families_of(state, exact).collect()}
    about = {r["family_id"]: r["unique_samples"] for r in mergeable.families_of(state).collect()}
    want = {r["f"]: r.asDict() for r in rows.groupBy(F.when(F.col("family") == "f", "f").otherwise("benign").alias("f")).agg(F.count("*").alias("n"), F.count_distinct("sha256").alias("u")).collect()}
    assert got.keys() == want.keys() == {"f", "benign"}
    for f in want:
        assert (got[f]["total_samples"], got[f]["unique_samples"], got[f]["year_span"]) == (want[f]["n"], want[f]["u"], 7 if f == "benign" else 6)
        assert about[f] == pytest.approx(want[f]["u"], rel=0.1)
    small = mergeable.family_state(rows.where("id < 100"))
    assert {r["unique_samples"] for r in mergeable.families_of(small).collect()} == {34, 66}


def test_sql_functions(spark):
    names = register_functions(spark, "t_")
    assert names == [f"t_{n}" for n in FUNCTIONS] and register_functions(spark, "t_") == names
    row = run_query(
        spark,
        """select t_clean_value(double('nan')) as a, t_clean_value(null, 2D) as b, t_clean_text(' 5 ') as c, t_clean_text('x', -1D) as d,
                  t_normalized_columns(array(1D, null, double('nan'))) as e, t_coalesce_columns(array(null, 3D), 7D) as f, t_select_features(map('k', 4D), array('k', 'z')) as g,
                  t_sum_features(array(float(1.5), float(2))) as h, t_mean_features(array(float(1), float(2))) as i""",
    ).first()
    assert (row["a"], row["b"], row["c"], row["d"], row["e"], row["f"], row["g"], row["h"], row["i"]) == (0, 2, 5, -1, [1, 0, 0], [7, 3], [4, None], 3.5, 1.5)
    plan = run_query(spark, "select t_clean_value(id) as x from range(5)")._jdf.queryExecution().executedPlan().toString()
    assert "t_clean_value" not in plan and math.isclose(run_query(spark, "select sum(t_clean_value(id)) as x from range(5)").first()["x"], 10.0)
