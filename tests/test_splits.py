import hashlib
import math

import pytest
from pyspark.sql import functions as F

from featmart.operators import splits
from featmart.operators.latest import latest_per_key


def bucket(key):
    return int(hashlib.md5(str(key).encode()).hexdigest()[:8], 16) % 100


def test_hash_split_depends_on_the_key_alone(spark):
    rows = splits.hash_split(spark.range(500).withColumn("sample_id", F.col("id").cast("string")).repartition(5), "sample_id").collect()
    for r in rows:
        b = bucket(r["id"])
        assert r["dataset_split"] == ("train" if b < 70 else "validation" if b < 85 else "test")
    assert "_fm_bucket" not in rows[0]


def test_split_bounds():
    assert splits.split_bounds(0.7, 0.15, 0.15) == (70, 85)
    with pytest.raises(ValueError):
        splits.split_bounds(0.7, 0.2, 0.2)


@pytest.mark.parametrize("digits", [1, 4])
def test_stratified_split_is_exact(spark, digits):
    sizes = {"big": 997, "small": 13, "one": 1, None: 40}
    data = [(f"{name}-{i}", name) for name, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(data, "k string, s string").repartition(4)
    shares = {"train": 0.8, "val": 0.1, "test": 0.1}
    rows = splits.stratified_split(df, "k", "s", shares, seed=7, version="v1", prefix_digits=digits).collect()
    got = {r["entity_key"]: r["split"] for r in rows}
    assert len(rows) == len(data)
    assert {(r["split_version"], r["split_seed"]) for r in rows} == {("v1", 7)}
    for name, n in sizes.items():
        keys = sorted((k for k, s in data if s == name), key=lambda k: hashlib.md5(f"7|{k}".encode()).hexdigest())
        ends = math.floor(n * 80 / 100), math.floor(n * 90 / 100)
        want = {k: "train" if i < ends[0] else "val" if i < ends[1] else "test" for i, k in enumerate(keys)}
        assert {k: got[k] for k in keys} == want


def test_copies_of_a_key_share_a_split(spark):
    data = [("hot", "s")] * 300 + [(f"k{i}", "s") for i in range(600)]
    rows = splits.stratified_split(spark.createDataFrame(data, "k string, s string"), "k", "s", {"train": 0.5, "test": 0.5}, 1, "v").collect()
    assert len(rows) == 900
    assert len({r["split"] for r in rows if r["entity_key"] == "hot"}) == 1


@pytest.mark.parametrize("finish_rows", [5, 10_000])
def test_head_per_split(spark, finish_rows):
    df = splits.hash_split(spark.range(2000), "id").repartition(6)
    got = splits.head_per_split(df, 120, "id", finish_rows=finish_rows).collect()
    want = {}
    for i in range(2000):
        b = bucket(i)
        want.setdefault("train" if b < 70 else "validation" if b < 85 else "test", []).append(i)
    for name, ids in want.items():
        assert sorted(r["id"] for r in got if r["dataset_split"] == name) == ids[:120]
    assert splits.head_per_split(df, 0, "id").count() == 2000
    assert splits.head_per_split(df, 10**6, "id").count() == 2000


def test_split_index(spark):
    features = spark.range(10).withColumn("x", F.col("id") * 2)
    index = spark.createDataFrame([("1", "train", "v1"), ("2", "val", "v1"), ("3", "train", "v2")], "entity_key string, split string, split_version string")
    assert [r["id"] for r in splits.select_split(features, index, "id", "train", "v1").collect()] == [1]
    rows = {r["id"]: r["split"] for r in splits.join_split_index(features, index, "id", "v1").collect()}
    assert rows == {1: "train", 2: "val"}


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, 1, "x"), ("a", 2, 1, "y"), ("a", 2, 2, "z"), ("b", 1, 1, "w"), ("a", 9, 1, "out")], "k string, t int, s int, v string")
    rows = latest_per_key(df, ["k"], "t", ["s"], start=F.lit(1), end=F.lit(9)).collect()
    assert {r["k"]: r["v"] for r in rows} == {"a": "z", "b": "w"}
    assert rows[0].asDict().keys() == {"k", "t", "s", "v"}
    assert {r["k"]: r["v"] for r in latest_per_key(df, ["k"], "t", ["s"], start=F.lit(2)).collect()} == {"a": "out"}
