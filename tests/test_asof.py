import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from featmart.operators import asof
from featmart.operators.asof import FeatureRows, asof_join
from featmart.sinks.tables import write_bucketed
from tests.plans import nodes_above, plan_of

T0 = datetime(2024, 1, 1)
SECOND = timedelta(seconds=1)


def entity_rows(spark, rows):
    return spark.createDataFrame(rows, "id long, k string, at timestamp_ntz")


def feature_rows(spark, rows, **options):
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, seq long, x double")
    return FeatureRows(df, "ts", ["x"], tie=["seq"], **options)


def joined(entities, view, **options):
    return {r["id"]: r["x"] for r in asof_join(entities, ["k"], "at", [view], **options).collect()}


@pytest.mark.parametrize("hot_rows", [1, 1000])
def test_edges(spark, hot_rows):
    ttl = timedelta(hours=6)
    features = [
        ("same", T0, 1, 1.0),
        ("after", T0 + timedelta(microseconds=1), 1, 2.0),
        ("edge", T0 - ttl, 1, 3.0),
        ("past", T0 - ttl - timedelta(microseconds=1), 1, 4.0),
        ("tie", T0, 1, 5.0),
        ("tie", T0, 2, 6.0),
        (None, T0, 1, 7.0),
    ]
    keys = ["same", "after", "edge", "past", "tie", "unknown", None]
    entities = entity_rows(spark, [*[(i, k, T0) for i, k in enumerate(keys)], (7, "same", None)])
    got = joined(entities, feature_rows(spark, features, ttl="6 hours"), hot_rows=hot_rows)
    assert got == {0: 1.0, 1: None, 2: 3.0, 3: None, 4: 6.0, 5: None, 6: None, 7: None}
    without_ttl = joined(entities, feature_rows(spark, features), hot_rows=hot_rows)
    assert without_ttl[3] == 4.0


def brute_force(entities, features, ttl):
    result = {}
    for i, k, at in entities:
        known = [(ts, seq, x) for fk, ts, seq, x in features if fk == k and ts <= at and (ttl is None or ts >= at - ttl)]
        result[i] = max(known)[2] if known else None
    return result


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("hot_rows", [20, 10**6])
def test_random_against_brute_force(spark, seed, hot_rows):
    """One key holds a third of all rows; times collide often."""
    rng = random.Random(seed)

    def key():
        return "hot" if rng.random() < 0.35 else f"k{rng.randrange(30)}"

    features = [(key(), T0 + rng.randrange(300) * SECOND, i, float(i)) for i in range(700)]
    entities = [(i, key(), T0 + rng.randrange(320) * SECOND) for i in range(500)]
    for text, ttl in ((None, None), ("40 seconds", 40 * SECOND)):
        view = feature_rows(spark, features, ttl=text)
        got = joined(entity_rows(spark, entities).repartition(3), view, hot_rows=hot_rows)
        assert got == brute_force(entities, features, ttl)


def test_never_looks_ahead_and_keeps_every_entity_row(spark):
    rng = random.Random(9)
    features = [(f"k{rng.randrange(5)}", T0 + rng.randrange(1000) * SECOND, i, float(i)) for i in range(300)]
    entities = entity_rows(spark, [(i % 50, f"k{rng.randrange(6)}", T0 + rng.randrange(1000) * SECOND) for i in range(200)])
    view = feature_rows(spark, features, timestamp_name="seen")
    rows = asof_join(entities, ["k"], "at", [view]).collect()
    assert len(rows) == 200
    assert all(r["seen"] is None or r["seen"] <= r["at"] for r in rows)


@pytest.mark.parametrize("hot_rows", [10, 1000])
def test_two_views_and_two_keys(spark, hot_rows):
    entities = spark.range(60).select(
        F.col("id"), (F.col("id") % 2).alias("a"), (F.col("id") % 3).alias("b"), F.timestamp_seconds("id").alias("at")
    )
    f = spark.range(60).select((F.col("id") % 2).alias("a"), (F.col("id") % 3).alias("b"), F.timestamp_seconds("id").alias("ts"), F.col("id").alias("x"))
    views = [FeatureRows(f, "ts", ["x"]), FeatureRows(f, "ts", ["x"], ttl="0 seconds", names=["y"])]
    rows = asof_join(entities, ["a", "b"], "at", views, hot_rows=hot_rows).collect()
    assert len(rows) == 60 and all(r["x"] == r["y"] == r["id"] for r in rows)


def test_no_entities_and_no_features(spark):
    view = feature_rows(spark, [("a", T0, 1, 1.0)])
    assert joined(entity_rows(spark, []), view) == {}
    assert joined(entity_rows(spark, [(1, "a", T0)]), feature_rows(spark, [])) == {1: None}


def test_bucketed_features_stay_where_they_are(spark):
    """The plan has no exchange above the bucketed scan, with and without a second view, hot keys or few entities; the rows are the same."""
    spark.sql("create database if not exists asof_buckets")
    rows = spark.range(2000).select((F.col("id") % 40).alias("u"), F.timestamp_add("MINUTE", F.pmod(F.xxhash64("id"), F.lit(5000)), F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts"), F.col("id").alias("x"))
    entities = rows.filter("x % 5 = 0").select("u", F.col("ts").alias("t"), F.col("x").alias("e"))
    assert write_bucketed(rows, "asof_buckets.features", ["u"], ["ts"], 6) == 2000
    stored = FeatureRows(spark.table("asof_buckets.features"), "ts", ["x"], tie=["x"], buckets=6)
    plain = FeatureRows(rows, "ts", ["x"], "2 days", tie=["x"], names=["y"])
    want = asof_join(entities, ["u"], "t", [FeatureRows(rows, "ts", ["x"], tie=["x"]), plain])
    for views in ([stored], [stored, plain]):
        got = asof_join(entities, ["u"], "t", views)
        above = nodes_above(plan_of(got), "Bucketed: true")
        assert above and not any("Exchange" in line for line in above)
        columns = got.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*columns).collect()))
    hot = asof_join(entities, ["u"], "t", [stored], hot_rows=10)
    assert sorted(map(str, hot.collect())) == sorted(map(str, want.drop("y").collect()))
    spark.sql("drop database asof_buckets cascade")


@pytest.mark.parametrize("max_keys", [0, 10])
def test_both_ways_of_narrowing_by_key(spark, monkeypatch, max_keys):
    """Few entity keys are broadcast to narrow the features, many are not; the rows are the same."""
    monkeypatch.setattr(asof, "MAX_KEYS", max_keys)
    rows = spark.range(300).select((F.col("id") % 50).alias("u"), F.timestamp_add("MINUTE", F.col("id"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts"), F.col("id").alias("x"))
    entities = rows.filter("u < 5").select("u", F.col("ts").alias("t"))
    got = asof_join(entities, ["u"], "t", [FeatureRows(rows, "ts", ["x"])])
    assert ("LeftSemi" in plan_of(got)) == (max_keys == 10)
    assert all(r["x"] == (r["t"].hour * 60 + r["t"].minute) for r in got.collect()) and got.count() == 30
