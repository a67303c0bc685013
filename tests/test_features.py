import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from featmart.functions import text, vectors
from featmart.operators import features, normalize

NAN = float("nan")


@pytest.fixture
def dirty(spark):
    data = [(1, 2.5, "3"), (None, NAN, "x"), (4, None, None), (7, 1.0, " 5 ")]
    return spark.createDataFrame(data, "syscall_1 int, syscall_2 double, syscall_3 string")


def test_cleaning(dirty):
    rows = dirty.select(*features.normalized_columns(dirty, count=3)).collect()
    assert [tuple(r) for r in rows] == [(1, 2.5, 3), (0, 0, 0), (4, 0, 0), (7, 1, 5)]
    assert dict(dirty.select(*features.normalized_columns(dirty, count=3)).dtypes) == {n: "float" for n in features.normalized_names(count=3)}
    safe = dirty.select(*features.safe_columns(dirty, ["syscall_2", "syscall_3"], default=-1.0)).collect()
    assert [tuple(r) for r in safe] == [(2.5, 3), (-1, -1), (-1, -1), (1, 5)]


def test_row_statistics(dirty):
    rows = features.with_row_statistics(dirty, count=3).collect()
    want = np.array([[1, 2.5, 3], [0, 0, 0], [4, 0, 0], [7, 1, 5]])
    assert np.allclose([r["syscall_total"] for r in rows], want.sum(axis=1))
    assert np.allclose([r["syscall_mean"] for r in rows], want.mean(axis=1))
    assert np.allclose([r["syscall_variance"] for r in rows], want.var(axis=1))
    assert [r["is_high_activity"] for r in rows] == [0, 0, 0, 0]
    assert features.select_normalized(features.with_row_statistics(dirty, count=3), count=3).columns == features.normalized_names(count=3)


def test_array_statistics(spark):
    data = [([1.0, 2.0, 4.0],), ([],), ([5.0],), ([1e9 + 1, 1e9 + 2],)]
    df = spark.createDataFrame(data, "a array<double>")
    rows = df.select(vectors.array_mean("a").alias("m"), vectors.array_variance("a").alias("v")).collect()
    assert rows[0]["m"] == pytest.approx(7 / 3) and rows[0]["v"] == pytest.approx(np.var([1, 2, 4]))
    assert rows[1]["m"] is None and rows[1]["v"] is None
    assert rows[2]["v"] == 0 and rows[3]["v"] == pytest.approx(0.25)


def test_on_demand_scores(spark):
    data = [(600, None, 500, 3, 1, None), (None, None, None, None, None, None)]
    df = spark.createDataFrame(data, "read long, write long, socket long, sendto long, camera long, send_sms long")
    first, second = features.with_on_demand_scores(df).collect()
    assert (first["syscall_activity_score"], first["is_high_syscall_activity"]) == (1100.0, 1)
    assert (first["network_activity_score"], first["permission_risk_score"]) == (503.0, 1.0)
    assert second["syscall_activity_score"] == 0.0 and second["is_high_syscall_activity"] == 0
    bare = features.with_on_demand_scores(spark.range(1)).first()
    assert [bare[c] for c in ("syscall_activity_score", "is_high_syscall_activity", "network_activity_score", "permission_risk_score")] == [0, 0, 0, 0]


def test_activity_flag_is_strict(spark):
    df = spark.createDataFrame([(1000,), (1001,)], "read long")
    assert [r["is_high_syscall_activity"] for r in features.with_on_demand_scores(df).collect()] == [0, 1]


def test_feature_choice(spark):
    df = spark.createDataFrame([(1, 2, "x", 1.0, 5)], "b int, a long, c string, label double, sample_id int")
    assert features.choose_features(df, ["a", "zzz"]) == ["a"]
    assert features.choose_features(df, ["zzz"]) == ["a", "b"]
    assert features.choose_features(df, limit=1) == ["a"]
    assert features.first_numeric(df, 2) == ["b", "a"]


def test_map_and_chain_and_user_function(spark):
    df = spark.createDataFrame([(1, 2), (3, 4)], "a long, b long")
    mapped = df.select(features.feature_map(["a", "b"]).alias("m"))
    assert mapped.first()["m"] == {"a": 1.0, "b": 2.0}
    assert mapped.select(features.map_value("m", "a"), features.map_value("m", "zz")).first()[:] == (1.0, None)
    chained = features.chain(df, lambda d: d.withColumn("c", F.col("a") + 1), lambda d: d.filter("c > 2"))
    assert [tuple(r) for r in chained.collect()] == [(3, 4, 4)]

    def ratio(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"ratio": batch["a"] / batch["b"], "total": batch["a"] + batch["b"]})

    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("ratio", T.DoubleType()), T.StructField("total", T.LongType())])
    assert [tuple(r) for r in features.with_user_features(df, ratio, ["a", "b"], schema).collect()] == [(1, 2, 0.5, 3), (3, 4, 0.75, 7)]


def test_normalizer(spark, dirty):
    names = ["syscall_1", "syscall_2", "syscall_3"]
    fit = normalize.fit_normalizer(dirty, names)
    data = np.array([[1, 2.5, 3], [0, 0, 0], [4, 0, 0], [7, 1, 5]])
    assert np.allclose(fit.mean, data.mean(axis=0)) and np.allclose(fit.std, data.std(axis=0) + 1e-8)
    got = normalize.apply_normalizer(dirty, fit).collect()
    assert np.allclose([tuple(r) for r in got], (data - data.mean(axis=0)) / (data.std(axis=0) + 1e-8))
    assert normalize.Normalizer.from_frame(fit.to_frame(spark)) == fit
    stats = {r["feature"]: (r["mean"], r["std"]) for r in normalize.column_statistics(dirty, names).collect()}
    assert np.allclose([stats[n] for n in names], list(zip(fit.mean, fit.std)))
    assert normalize.normalizer_for(dirty, names, fit) is fit
    assert normalize.normalizer_for(dirty, names) == fit


def test_constant_column(spark):
    df = spark.createDataFrame([(5.0, 1.0)] * 3, "a double, b double")
    fit = normalize.fit_normalizer(df, ["a"])
    assert fit.std[0] == pytest.approx(1e-8)
    assert [r["a"] for r in normalize.apply_normalizer(df, fit).collect()] == [0, 0, 0]
    assert [r["a"] for r in normalize.zscore(df, ["a"]).collect()] == [None] * 3


def test_zscore(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (6.0,), (None,), (NAN,)], "a double")
    got = [r["a"] for r in normalize.zscore(df, ["a", "absent"]).collect()]
    want = (np.array([1, 2, 6]) - 3) / np.std([1, 2, 6], ddof=1)
    assert np.allclose(got[:3], want) and got[3:] == [None, None]
    assert normalize.zscore(df, ["absent"]).columns == ["a"]


def test_fit_on_nothing(spark):
    with pytest.raises(ValueError):
        normalize.fit_normalizer(spark.createDataFrame([], "a double"), ["a"])


def test_no_column_is_left_out_by_default(spark):
    df = spark.createDataFrame([tuple(range(60))], ", ".join(f"c{i:02} int" for i in range(60)))
    assert len(features.choose_features(df)) == 60 and normalize.describe(df).count() == 60


def test_describe(spark):
    df = spark.createDataFrame([(1, "x", 2.0), (3, "y", None)], "a int, s string, b double")
    rows = {r["column_name"]: r for r in normalize.describe(df).collect()}
    assert set(rows) == {"a", "b"}
    assert (rows["a"]["count"], rows["a"]["mean"], rows["a"]["min"], rows["a"]["max"]) == (2, 2.0, 1.0, 3.0)
    assert rows["a"]["std"] == pytest.approx(math.sqrt(2)) and rows["b"]["count"] == 1 and rows["b"]["std"] is None


def test_text(spark):
    df = spark.createDataFrame([("/a/b/Kro No-2021.X.CSV", "abcdef", 7, 1704067261)], "p string, t string, n int, s long")
    row = df.select(
        text.table_name("p"), text.file_name("p"), text.shorten("t", 6), text.shorten("t", 5), text.padded_id("n"), text.epoch_text("s")
    ).first()
    assert tuple(row) == ("kro_no_2021.x", "Kro No-2021.X.CSV", "abcdef", "abcde...", "sample_0007", "2024-01-01 00:01:01")


def test_epoch_text_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert spark.range(1).select(text.epoch_text(F.lit(0))).first()[0] == "1970-01-01 00:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_wide_tables_take_the_other_way(spark):
    n = normalize.DIRECT_COLUMNS + 5
    data = np.random.default_rng(0).normal(size=(50, n))
    data[3, 2] = NAN
    names = [f"c {i}" for i in range(n)]
    df = spark.createDataFrame(pd.DataFrame(data, columns=names))
    clean = np.nan_to_num(data, nan=0.0).astype(np.float32).astype(float)
    fit = normalize.fit_normalizer(df, names)
    assert np.allclose(fit.mean, clean.mean(axis=0)) and np.allclose(fit.std, clean.std(axis=0) + 1e-8)
    want = (clean - clean.mean(axis=0)) / (clean.std(axis=0) + 1e-8)
    assert np.allclose([tuple(r) for r in normalize.apply_normalizer(df, fit).collect()], want)
    assert np.allclose([r[0] for r in df.select(normalize.normalized_vector(df, fit)).collect()], want)
    assert np.allclose([r[0] for r in df.select(features.feature_vector(df, names)).collect()], clean)
    scores = np.array([tuple(r) for r in normalize.zscore(df, names).collect()], dtype=float)
    missing = np.isnan(data)
    plain = (data - np.nanmean(data, axis=0)) / np.nanstd(data, axis=0, ddof=1)
    assert np.array_equal(np.isnan(scores), missing) and np.allclose(scores[~missing], plain[~missing])


def test_describe_of_all_numeric_types(spark):
    df = spark.createDataFrame([(1, 2, 3.0, "1.50"), (3, None, 5.0, "2.50")], "a byte, b short, c float, d string").withColumn("d", F.col("d").cast("decimal(10,2)"))
    rows = {r["column_name"]: tuple(r)[1:] for r in normalize.describe(df).collect()}
    assert set(rows) == {"a", "b", "c", "d"} and rows["d"][:2] == (2, 2.0) and rows["b"] == (1, 2.0, None, 2.0, 2.0)
    assert {tuple(r) for r in normalize.describe(df.limit(0)).collect()} == {(c, 0, None, None, None, None) for c in "abcd"}
    assert normalize.describe(df.select(F.lit("x").alias("s"))).collect() == []
