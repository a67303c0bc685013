"""The newest row per key: both ways of fetching, orders of all types, and what the plans do."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from featmart.operators.latest import latest_per_key, newest_of_all, newest_places

SF = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 1)
ROW = "k int, t {time}, n {tie}, pad string"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def brute(rows):
    """The newest row per key; nulls come first."""
    best = {}
    rank = lambda r: [(x is not None, x if x is not None else 0) for x in r[1:3]]
    for row in rows:
        if row[0] not in best or rank(row) > rank(best[row[0]]):
            best[row[0]] = row
    return sorted(best.values(), key=repr)


def times(kind, rng):
    value = rng.randint(-5, 60)
    return {"timestamp": T0 + timedelta(hours=value, microseconds=value), "timestamp_ntz": T0 + timedelta(hours=value, microseconds=value), "date": (T0 + timedelta(days=value)).date()}.get(kind, value)


@pytest.mark.parametrize("time, tie", [("timestamp_ntz", "long"), ("timestamp", "int"), ("date", "short"), ("long", "byte"), ("int", "string"), ("long", "long"), ("timestamp_ntz", "double")])
@pytest.mark.parametrize("max_winners", [1_000_000, 0])
def test_newest_rows_of_all_types(spark, tmp_path, time, tie, max_winners):
    rng = random.Random(1)
    made = {"string": lambda i: f"{i:05d}", "double": float, "byte": lambda i: i % 100}.get(tie, int)
    # Ties are told apart within a time, so the order is total.
    rows = [(rng.choice([None, *range(15)]), None if rng.random() < 0.1 else times(time, rng), made(i), "x" * (i % 7)) for i in range(100)]
    rows += [(20, None, None, "only"), (21, None, made(1), "a"), (21, None, None, "b")]
    frame = spark.createDataFrame(rows, ROW.format(time=time, tie=tie)).repartition(3)
    frame.write.parquet(str(tmp_path / "rows"))
    for df in (spark.read.parquet(str(tmp_path / "rows")), frame):
        got = sorted(map(tuple, latest_per_key(df, ["k"], "t", ["n"], max_winners=max_winners).collect()), key=repr)
        assert got == brute(rows)


def test_hours_that_a_zone_has_twice_keep_their_order(spark, tmp_path):
    """In autumn 02:30 of a zone without offset comes once; a change to UTC would fold it."""
    rows = [(1, datetime(2024, 10, 27, 2, 30), 1, "a"), (1, datetime(2024, 10, 27, 3, 0), 2, "b"), (2, datetime(2, 1, 1), 1, "c"), (2, datetime(9998, 12, 31), 1, "d")]
    spark.createDataFrame(rows, ROW.format(time="timestamp_ntz", tie="int")).write.parquet(str(tmp_path / "rows"))
    got = latest_per_key(spark.read.parquet(str(tmp_path / "rows")), ["k"], "t", ["n"]).collect()
    assert {r["pad"] for r in got} == {"b", "d"}


def test_no_sort_of_rows(spark):
    """Places are found by hash aggregates, rows are fetched by a broadcast, or by a shuffle of the rows that a bitmap lets through."""
    events = spark.read.parquet(f"{SF}/events.parquet")
    plan = plan_of(newest_places(events, ["user_id"], "ts", ["event_id"]))
    assert "HashAggregate" in plan and "Sort" not in plan
    assert "value#" not in plan and "props#" not in plan
    few = plan_of(latest_per_key(events, ["user_id"], "ts", ["event_id"]))
    assert "BroadcastHashJoin" in few and "Sort" not in few and "Exchange hash" not in few
    many = latest_per_key(events, ["user_id"], "ts", ["event_id"], max_winners=0)
    assert "bitmap_construct_agg" in plan_of(many) and many.count() == events.select("user_id").distinct().count()


def test_the_bitmap_drops_most_rows(spark):
    from featmart.operators import latest

    events = spark.read.parquet(f"{SF}/events.parquet")
    places = newest_places(events, ["user_id"], "ts", ["event_id"]).cache()
    located = events.select("*", latest._place().alias(latest._PLACE))
    assert places.count() <= latest._maybe_among(located, places).count() <= places.count() + 5 < events.count()
    places.unpersist()


def test_range_names_and_empty_frames(spark, tmp_path):
    rows = [(1, T0 + timedelta(hours=h), h, "x") for h in range(5)]
    df = spark.createDataFrame(rows, "`a.k` int, t timestamp_ntz, `n n` int, `_metadata` string")
    got = latest_per_key(df, ["a.k"], "t", ["n n"], end=F.lit(T0 + timedelta(hours=3)).cast("timestamp_ntz")).collect()
    assert [tuple(r) for r in got] == [rows[2]]
    assert latest_per_key(df.limit(0), ["a.k"], "t").collect() == []
    assert newest_of_all(df.limit(0), ["t"]).collect() == [] and newest_of_all(df, ["t"]).first()["n n"] == 4
