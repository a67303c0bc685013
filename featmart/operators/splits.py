"""Dataset splits: by key hash, stratified, from an index, first rows per split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import as_column, digest, md5_bucket
from ..workdir import cut, small_side
from .selection import order_statistics

SPLIT = "dataset_split"

# Split names and the default shares of 70 / 15 / 15 percent.
SPLITS = ("train", "validation", "test")
TRAIN_END, VALIDATION_END = 70, 85


def split_label(bucket: Column, train_end: int = TRAIN_END, validation_end: int = VALIDATION_END) -> Column:
    train, validation, test = SPLITS
    return F.when(bucket < train_end, train).when(bucket < validation_end, validation).otherwise(test)


def split_bounds(train: float, validation: float, test: float) -> tuple[int, int]:
    """Bucket bounds in percent for shares that add up to 1."""
    if abs(train + validation + test - 1.0) > 1e-9:
        raise ValueError("split shares must add up to 1")
    return round(train * 100), round((train + validation) * 100)


def hash_split(df: DataFrame, key: str, train_end: int = TRAIN_END, validation_end: int = VALIDATION_END) -> DataFrame:
    """Assign a split as a function of the key alone."""
    bucketed = df.withColumn("_fm_bucket", md5_bucket(key))
    return bucketed.withColumn(SPLIT, split_label(F.col("_fm_bucket"), train_end, validation_end)).drop("_fm_bucket")


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(SPLIT).agg(F.count(F.lit(1)).alias("rows"))


def head_per_split(df: DataFrame, limit: int, order_by: str, splits: Sequence[str] = SPLITS, **options) -> DataFrame:
    """The first `limit` rows of each split by a unique numeric column; 0 keeps all rows.

    The largest kept value of each split is found by counting, then one filter keeps the rows: nothing is sorted and no
    split is gathered in one task.
    """
    if limit <= 0:
        return df
    key = F.col(order_by)
    sizes = {r[SPLIT]: r["rows"] for r in split_counts(df.filter(F.col(SPLIT).isin(*splits))).collect()}
    wanted = {s: (F.col(SPLIT) == s, limit - 1) for s, n in sizes.items() if n > limit}
    ends = order_statistics(df.select(SPLIT, order_by), key, wanted, **options) if wanted else {}
    keep = F.lit(False)
    for s in sizes:
        keep = keep | ((F.col(SPLIT) == s) & (key <= ends[s] if s in ends else F.lit(True)))
    return df.filter(keep)


def stratified_split(
    df: DataFrame,
    key: str,
    stratum: str,
    shares: Mapping[str, float],
    seed: int,
    version: str,
    event_timestamp: Column | None = None,
    prefix_digits: int = 4,
) -> DataFrame:
    """A split index `(entity_key, event_timestamp, split, split_version, split_seed)`, exact within each stratum.

    Keys are ordered by the md5 of seed and key; the first `floor(n * share)` of a stratum go to the first split and so
    on. Digests are uniform, so the digest where a split ends is found from counts per digest prefix (at most
    16^prefix_digits per stratum) and then from the digests of that one prefix. The data itself is only compared with
    those bounds. Repeated keys have one digest and share a split.
    """
    names = list(shares)
    if abs(sum(shares.values()) - 1.0) > 1e-9:
        raise ValueError("split shares must add up to 1")
    tagged = df.withColumn("_fm_digest", digest(F.lit(seed), key)).withColumn("_fm_stratum", as_column(stratum))
    tagged = tagged.withColumn("_fm_prefix", F.substring("_fm_digest", 1, prefix_digits))

    # A null stratum is a stratum too, hence the null-safe joins below.
    per_prefix = tagged.groupBy("_fm_stratum", "_fm_prefix").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("_fm_stratum").orderBy("_fm_prefix").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("_fm_stratum")
    running = per_prefix.withColumns({"upto": F.sum("n").over(upto), "total": F.sum("n").over(whole)})
    share, ends = 0.0, []
    for name in names[:-1]:
        share += shares[name]
        end = F.floor(F.col("total") * F.lit(Decimal(str(round(share, 12))))).cast("long")
        ends.append(F.struct(F.lit(name).alias("split"), end.alias("end")))
    first = F.col("upto") - F.col("n")
    wanted = running.withColumn("e", F.explode(F.array(*ends))).filter(
        (F.col("e.end") > 0) & (F.col("e.end") <= F.col("upto")) & (F.col("e.end") > first)
    )
    wanted = cut(
        wanted.select(
            F.col("_fm_stratum").alias("_fm_s"),
            F.col("_fm_prefix").alias("_fm_p"),
            F.col("e.split").alias("_fm_split"),
            (F.col("e.end") - first).alias("_fm_take"),
        ),
        "split-prefixes",
    )

    # Digests of the few prefixes in which a split ends; copies of a key collapse in the partial aggregate.
    inside = tagged.select("_fm_stratum", "_fm_prefix", "_fm_digest").join(
        small_side(wanted), F.col("_fm_stratum").eqNullSafe(F.col("_fm_s")) & (F.col("_fm_prefix") == F.col("_fm_p"))
    )
    digests = inside.groupBy("_fm_s", "_fm_split", "_fm_take", "_fm_digest").agg(F.count(F.lit(1)).alias("n"))
    within = Window.partitionBy("_fm_s", "_fm_split").orderBy("_fm_digest").rowsBetween(Window.unboundedPreceding, 0)
    hits = digests.withColumn("upto", F.sum("n").over(within)).filter(
        (F.col("_fm_take") <= F.col("upto")) & (F.col("_fm_take") > F.col("upto") - F.col("n"))
    )
    bounds = hits.groupBy("_fm_s").agg(
        *[F.max(F.when(F.col("_fm_split") == name, F.col("_fm_digest"))).alias(f"_fm_end_{i}") for i, name in enumerate(names[:-1])]
    )

    label = F.lit(names[-1])
    for i, name in reversed(list(enumerate(names[:-1]))):
        label = F.when(F.col("_fm_digest") <= F.col(f"_fm_end_{i}"), F.lit(name)).otherwise(label)
    joined = tagged.join(small_side(cut(bounds, "split-bounds")), F.col("_fm_stratum").eqNullSafe(F.col("_fm_s")), "left")
    return joined.select(
        F.col(key).cast("string").alias("entity_key"),
        (F.lit(None).cast("timestamp_ntz") if event_timestamp is None else event_timestamp).alias("event_timestamp"),
        label.alias("split"),
        F.lit(version).alias("split_version"),
        F.lit(seed).alias("split_seed"),
    )


def select_split(features: DataFrame, index: DataFrame, key: str, split: str, version: str) -> DataFrame:
    """Feature rows of one split of one version. The index is filtered first; Spark measures it and picks the join."""
    keys = index.filter((F.col("split") == split) & (F.col("split_version") == version)).select("entity_key")
    return features.join(keys, F.col(key).cast("string") == F.col("entity_key"), "left_semi")


def join_split_index(features: DataFrame, index: DataFrame, key: str, version: str) -> DataFrame:
    """Feature rows with the split a version gives them."""
    index = index.filter(F.col("split_version") == version).select("entity_key", "split")
    return features.join(index, F.col(key).cast("string") == F.col("entity_key")).drop("entity_key")
