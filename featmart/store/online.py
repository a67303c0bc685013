"""The online table: newest feature row per key, in files that find a key without reading the rest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import quoted
from ..operators.latest import latest_per_key
from ..sinks.tables import observed
from ..sources.files import path_exists
from ..workdir import append_entry, cut, make_folder

BUCKETS = 64
ROW_GROUP_BYTES, PAGE_ROWS = 8 << 20, 250
PUSHED_KEYS, KEYS_PER_FILTER = 1000, 10  # Parquet skips by lists of at most 10 values
_NEW = "_fm_new"


class OnlineTable:
    """A key-value table with one row per key: Parquet partitions by a hash of the key, rows sorted by key inside them.

    Files have Bloom filters on the keys, small row groups and small pages, so a lookup of a few keys reads the pages that may hold
    them. An upsert merges new rows into the buckets they fall in and replaces these; of one key the newest row stays, and of one
    time the row that came last. So a repeated upsert changes nothing, and there is no log of batches. Each upsert costs
    what its buckets hold: give a table that gets small batches more buckets, or its streams longer batches.

    The merged rows are written to the work folder before buckets are replaced. Writers of one table must take turns.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], timestamp: str, tie: Sequence[str] = (), buckets: int = BUCKETS):
        self.spark = spark
        self.path = path
        self.keys = list(keys)
        self.timestamp = timestamp
        self.tie = list(tie)
        self.buckets = buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def last_end(self) -> str | None:
        """The end of the last materialized range."""
        ends = self.spark.read.schema("until string").json(make_folder(self.spark, f"{self.path}/ends"))
        return ends.agg(F.max("until").alias("until")).first()["until"]

    def upsert(self, rows: DataFrame, until: str | None = None) -> int:
        """Merge rows, and return how many there were. `until` is remembered as the end of a materialized range."""
        counted, watch = observed(rows.withColumn("bucket", self._bucket()).withColumn(_NEW, F.lit(True)))
        new = cut(counted, "online-new")
        n = watch.get["rows"]
        if n:
            touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]
            have = self._stored()
            if have is not None:
                new = new.unionByName(have.filter(F.col("bucket").isin(touched)).withColumn(_NEW, F.lit(False)), allowMissingColumns=True)
            merged = cut(latest_per_key(new, ["bucket", *self.keys], self.timestamp, [*self.tie, _NEW]).drop(_NEW), "online-merged")
            self._replace(merged)
        if until is not None:
            append_entry(self.spark, make_folder(self.spark, f"{self.path}/ends"), {"until": F.lit(until)}, "append")
        return n

    def _replace(self, merged: DataFrame) -> None:
        ordered = merged.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", *[F.col(quoted(k)) for k in self.keys])
        writer = ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket")
        writer = writer.option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.row.count.limit", PAGE_ROWS)
        for k in self.keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true").option(f"parquet.bloom.filter.adaptive.enabled#{k}", "true")
        writer.parquet(f"{self.path}/data")

    def _stored(self) -> DataFrame | None:
        return self.spark.read.parquet(f"{self.path}/data") if path_exists(self.spark, f"{self.path}/data") else None

    def read(self) -> DataFrame:
        """The table."""
        return self._rows().drop("bucket")

    def _rows(self) -> DataFrame:
        stored = self._stored()
        if stored is None:
            raise ValueError(f"nothing was written to {self.path}")
        return stored

    def lookup(self, keys: DataFrame | Sequence[Mapping], columns: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
        """Left join of the keys with columns of the table, under other names if these are given. A list of keys goes to the files' indexes."""
        rows = self._rows()
        if not isinstance(keys, DataFrame):
            # A list in the driver's memory, so broadcasting it is safe.
            keys = self.spark.createDataFrame([tuple(k[c] for c in self.keys) for k in keys], rows.select(*self.keys).schema)
            touched = [r["b"] for r in keys.select(self._bucket().alias("b")).distinct().collect()]
            rows = rows.filter(F.col("bucket").isin(touched)).filter(self._among(keys)).join(F.broadcast(keys), self.keys, "left_semi")
        found = rows.select(*self.keys, *[F.col(quoted(c)).alias(n) for c, n in zip(columns, names or columns)])
        return keys.join(found, self.keys, "left")

    def _among(self, keys: DataFrame) -> Column:
        """Whether each key column has one of the looked-up values, in a form that the files' indexes understand."""
        listed = keys.distinct().limit(PUSHED_KEYS + 1).collect()
        if not 0 < len(listed) <= PUSHED_KEYS:
            return F.lit(True)
        parts = []
        for k in self.keys:
            values = list(dict.fromkeys(r[k] for r in listed if r[k] is not None))
            some = [F.col(quoted(k)).isin(values[i : i + KEYS_PER_FILTER]) for i in range(0, len(values), KEYS_PER_FILTER)]
            parts.append(reduce(lambda a, b: a | b, some, F.lit(False)) if some else F.lit(False))
        return reduce(lambda a, b: a & b, parts)
