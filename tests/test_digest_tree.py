"""Stored versions compared by their digest trees."""

import pytest
from pyspark.sql import functions as F

from featmart.operators import digest_tree as trees
from featmart.operators.diff import version_diff
from tests.plans import collect_and_count, plan_of, static_plans


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def versions(spark, tmp_path):
    old = spark.range(5000).select("id", (F.col("id") % 7).alias("n"), F.concat(F.lit("t"), "id").alias("text"))
    changed = F.when(F.col("id") == 17, F.lit("other")).otherwise(F.col("text"))
    new = old.filter("id <> 4000").withColumn("text", changed).unionByName(spark.createDataFrame([(9000, 1, "new")], "id long, n long, text string"))
    paths = [str(tmp_path / n) for n in ("old", "new", "copy")]
    for df, path in zip((old, new, old.repartition(5)), paths):
        trees.store_version(df, path, ["id"], buckets=100)
    return old, new, paths


def test_only_buckets_that_differ_are_read(spark, versions):
    old, new, (a, b, copy) = versions
    want = [(17, "changed"), (4000, "removed"), (9000, "added")]
    with static_plans(spark):
        diff = trees.stored_diff(spark, a, b, ["id"], 100)
        found, scanned = collect_and_count(diff)
        assert sorted(tuple(r) for r in found) == rows(version_diff(old, new, ["id"])) == want
        touched = trees.changed_buckets(trees.read_tree(spark, a), trees.read_tree(spark, b), 100)
        assert 1 <= len(touched) <= 3
        inside = sum(trees.read_version(spark, p).filter(F.col("_fm_bucket").isin(touched)).count() for p in (a, b))
        assert scanned == inside < 2 * 5000 * 6 / 100
        assert "PartitionFilters: [_fm_bucket" in plan_of(diff)
        # Rows in another order are the same version: nothing is read.
        same = trees.stored_diff(spark, a, copy, ["id"], 100)
        assert collect_and_count(same) == ([], 0)


def test_only_differing_nodes_are_compared(spark, versions, monkeypatch):
    _, _, (a, b, _) = versions
    tree = trees.read_tree(spark, a)
    levels = {r["level"]: (r["nodes"], r["rows"]) for r in tree.groupBy("level").agg(F.count(F.lit(1)).alias("nodes"), F.sum("rows").alias("rows")).collect()}
    assert levels == {0: (1, 5000), 1: (7, 5000), 2: (100, 5000)} and trees.depth(100) == 2 and trees.depth(4096) == 3 and trees.depth(16) == 1
    compared = []
    cut = trees.cut
    monkeypatch.setattr(trees, "cut", lambda df, label: compared.append(df.count()) or cut(df, label))
    trees.changed_buckets(tree, trees.read_tree(spark, b), 100)
    assert compared[0] == 1 and all(n <= 3 for n in compared)


def test_other_columns_empty_versions_and_copies_of_keys(spark, versions, tmp_path):
    old, new, (a, b, _) = versions
    wider, empty, twice = (str(tmp_path / n) for n in ("wider", "empty", "twice"))
    trees.store_version(old.withColumn("x", F.lit(1)), wider, ["id"], 100)
    assert trees.stored_diff(spark, a, wider, ["id"], 100).filter("change = 'changed'").count() == 5000
    trees.store_version(old.limit(0), empty, ["id"], 100)
    assert trees.stored_diff(spark, a, empty, ["id"], 100).filter("change = 'removed'").count() == 5000
    assert trees.stored_diff(spark, empty, empty, ["id"], 100).count() == 0
    trees.store_version(old.unionByName(old.filter("id = 3")), twice, ["id"], 100)
    with pytest.raises(Exception, match="twice"):
        trees.stored_diff(spark, a, twice, ["id"], 100).collect()


def test_whole_numbers_beside_doubles(spark):
    big = 2**53
    whole = spark.createDataFrame([(1, big + 1), (2, big), (3, 5), (4, None), (5, -(2**63)), (6, 2**63 - 1)], "k int, x long")
    double = spark.createDataFrame([(1, float(big)), (2, float(big)), (3, 5.5), (4, None), (5, -(2.0**63)), (6, 2.0**63)], "k int, x double")
    assert rows(version_diff(whole, double, ["k"])) == [(1, "changed"), (3, "changed"), (6, "changed")]
    decimals = spark.createDataFrame([(1, "0.1"), (2, "0.25"), (3, "12345678901234567.1"), (4, None)], "k int, x string").withColumn("x", F.col("x").cast("decimal(38,18)"))
    floats = spark.createDataFrame([(1, 0.1), (2, 0.5), (3, 12345678901234567.1), (4, None)], "k int, x double")
    assert rows(version_diff(decimals, floats, ["k"])) == [(2, "changed"), (3, "changed")]
