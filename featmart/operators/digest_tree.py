"""Changed rows between stored versions, reading only what differs: a tree of digests beside each version.

A stored version holds its rows by bucket, a hash of the key, and a tree of digests: the leaves are the buckets, every other node stands
for up to `FAN_OUT` nodes below it. A leaf's digest adds up two hashes of its rows, so their order does not matter; a node's digest
is a hash of its children's. Two versions are compared from the root down: where digests are equal, nothing below is looked at,
and only buckets whose leaves differ are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import quoted, row_hashes, schema_hash
from ..sinks.tables import write_parquet
from ..workdir import cut
from .diff import version_diff

FAN_OUT = 16
BUCKETS = 4096
_BUCKET = "_fm_bucket"
_WIDE = "decimal(38,0)"


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """Keys of equal text share a bucket, whatever their types in two versions. At most `buckets` partitions."""
    return F.pmod(F.xxhash64(*[F.col(quoted(k)).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def store_version(df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> int:
    """Write a version and its tree, and return the number of rows. `buckets` must be the same for all versions of a table."""
    df.limit(0).write.parquet(f"{path}/columns")
    rows = write_parquet(df.withColumn(_BUCKET, key_bucket(keys, buckets)), f"{path}/rows", partition_by=[_BUCKET])
    # The rows as stored decide, not a second run of the plan that made them.
    digest_tree(read_version(df.sparkSession, path), df.columns, buckets).write.partitionBy("level").parquet(f"{path}/tree")
    return rows


def read_version(spark: SparkSession, path: str) -> DataFrame:
    """A version's rows with their bucket. Its columns are stored apart, since a version may have no rows."""
    schema = spark.read.parquet(f"{path}/columns").schema.add(_BUCKET, T.IntegerType())
    return spark.read.schema(schema).parquet(f"{path}/rows")


def digest_tree(stored: DataFrame, columns: Sequence[str], buckets: int) -> DataFrame:
    """(level, node, digest, rows): level 0 is the root, the last level the buckets. As many rows as there are nodes; buckets without rows have none."""
    d, e = row_hashes(stored, columns)
    leaves = stored.groupBy(F.col(_BUCKET).cast("long").alias("node")).agg(
        F.xxhash64(F.sum(d.cast(_WIDE)), F.sum(e.cast(_WIDE)), F.count(F.lit(1))).alias("digest"), F.count(F.lit(1)).alias("rows")
    )
    last = depth(buckets)
    nodes = cut(leaves, "tree-leaves")
    tree = nodes.select(F.lit(last).alias("level"), "node", "digest", "rows")
    for level in range(last - 1, -1, -1):
        below = F.array_sort(F.collect_list(F.struct("node", "digest")))
        nodes = nodes.groupBy(F.floor(F.col("node") / FAN_OUT).cast("long").alias("node")).agg(F.xxhash64(F.to_json(below)).alias("digest"), F.sum("rows").alias("rows"))
        tree = tree.unionByName(nodes.select(F.lit(level).alias("level"), "node", "digest", "rows"))
    return tree


def depth(buckets: int) -> int:
    """Levels below the root."""
    levels, nodes = 1, FAN_OUT
    while nodes < buckets:
        levels, nodes = levels + 1, nodes * FAN_OUT
    return levels


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("node long, digest long, rows long, level int").parquet(f"{path}/tree")


def changed_buckets(old: DataFrame, new: DataFrame, buckets: int) -> list[int]:
    """Buckets whose rows differ, found from the root down.

    Below the root only children of nodes that differ are compared. The list is at most as long as there are buckets.
    """
    last = depth(buckets)

    def differing(level: int, within: DataFrame | None) -> DataFrame:
        sides = [tree.filter(F.col("level") == level).select("node", F.col("digest").alias(name)) for tree, name in ((old, "a"), (new, "b"))]
        if within is not None:
            sides = [side.join(F.broadcast(within), F.floor(F.col("node") / FAN_OUT).cast("long") == F.col("parent"), "left_semi") for side in sides]
        both = sides[0].join(sides[1], "node", "full")
        return cut(both.filter(~F.col("a").eqNullSafe(F.col("b"))).select(F.col("node").alias("parent")), "tree-level")

    differs = differing(0, None)
    if differs.isEmpty():
        return []
    for level in range(1, last + 1):
        differs = differing(level, differs)
    return sorted(r["parent"] for r in differs.collect())


def stored_diff(spark: SparkSession, old_path: str, new_path: str, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """`version_diff` of two stored versions: `(keys, change)`. Buckets of equal digest are not read."""
    old, new = read_version(spark, old_path), read_version(spark, new_path)
    if schema_hash(old.drop(_BUCKET).schema) != schema_hash(new.drop(_BUCKET).schema):
        return version_diff(old.drop(_BUCKET), new.drop(_BUCKET), keys)
    changed = changed_buckets(read_tree(spark, old_path), read_tree(spark, new_path), buckets)
    return version_diff(*[side.filter(F.col(_BUCKET).isin(changed)).drop(_BUCKET) for side in (old, new)], keys)
