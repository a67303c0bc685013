"""Exact order statistics per group against sorting."""

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from featmart.operators import group_selection
from featmart.operators.group_selection import group_order_statistics
from featmart.operators.latency import latency_statistics

SHARES = {"low": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "high": 1.0}


def wanted():
    return {name: F.floor(F.lit(share) * (F.col("n") - 1)) for name, share in SHARES.items()}


def brute(rows):
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    order = lambda v: (isinstance(v, float) and math.isnan(v), 0 if isinstance(v, float) and math.isnan(v) else v)
    return {g: [sorted(vs, key=order)[math.floor(s * (len(vs) - 1))] for s in SHARES.values()] for g, vs in groups.items()}


def same(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))


@pytest.mark.parametrize("kind, finish_rows", [("double", 20), ("long", 1), ("decimal(20,2)", 100_000)])
def test_ranks_of_each_group(spark, monkeypatch, kind, finish_rows):
    monkeypatch.setattr(group_selection, "MAX_BROADCAST", 0 if finish_rows == 20 else 1000)
    rng = random.Random(finish_rows)
    make = {"double": lambda: rng.gauss(0, 1), "long": lambda: rng.randint(2**53 - 40, 2**53 + 40), "decimal(20,2)": lambda: Decimal(rng.randint(0, 10**6)) / 100}[kind]
    rows = [("hot", make()) for _ in range(3000)] + [(f"g{rng.randint(0, 30)}", make()) for _ in range(2000)]
    rows += [(None, make()) for _ in range(50)] + [("one", make()), ("none", None), ("hot", None)] + [("same", make())] * 500
    if kind == "double":
        rows += [("nans", float("nan"))] * 300 + [("nans", make()) for _ in range(40)] + [("inf", float("inf")), ("inf", float("-inf")), ("inf", 0.5)]
    frame = spark.createDataFrame(rows, f"g string, v {kind}").repartition(4)
    frame = frame.cache()
    got = {r["g"]: list(r)[1:] for r in group_order_statistics(frame, ["g"], "v", wanted(), finish_rows=finish_rows, sketch_size=64, margin=0.05).collect()}
    want = brute(rows)
    assert got.keys() == want.keys()
    assert all(same(a, b) for g in want for a, b in zip(got[g], want[g]))
    frame.unpersist()


def test_one_group_is_split_over_tasks(spark, monkeypatch):
    """A third of all rows are one model's, nearly all values differ: no task gets more than a sliver of them to sort."""
    rows = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), (F.col("id") % 50).cast("string"))).alias("model"),
        (F.pmod(F.xxhash64("id"), F.lit(10**9)) / 1000.0).alias("latency_ms"),
    )
    seen = []
    read_off = group_selection._read_off
    monkeypatch.setattr(group_selection, "_read_off", lambda rows, keys, ranges, few: seen.append(ranges.agg(F.max("inside")).first()[0]) or read_off(rows, keys, ranges, few))
    stats = {r["model"]: r for r in latency_statistics(rows, finish_rows=4000).collect()}
    assert seen[0] <= 4000 < stats["hot"]["total_samples"]
    values = sorted(r[0] for r in rows.filter("model = 'hot'").select("latency_ms").collect())
    assert [stats["hot"][f"p{p}_latency_ms"] for p in (50, 95, 99)] == [values[math.floor(p / 100 * (len(values) - 1))] for p in (50, 95, 99)]


def test_no_groups_no_rows_and_other_names(spark):
    df = spark.createDataFrame([("a", 1, 2.5), ("a", 1, None)], "`m o` string, n int, v double")
    r = latency_statistics(df, ["m o", "n"], "v").first()
    assert (r["total_samples"], r["p50_latency_ms"], r["throughput_samples_per_sec"]) == (1, 2.5, 400.0)
    assert latency_statistics(df.limit(0), ["m o"], "v").collect() == []
    only_null = latency_statistics(df.filter("v is null"), ["m o"], "v").first()
    assert (only_null["total_samples"], only_null["p50_latency_ms"]) == (0, None)
    one = latency_statistics(df, [], "v").first()
    assert (one["total_samples"], one["p99_latency_ms"]) == (1, 2.5)
