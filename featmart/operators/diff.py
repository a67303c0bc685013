"""Rows that differ between two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import quoted, row_hashes, schema_hash


def version_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that were added, removed or changed, as `(keys, change)`. Keys must be unique within a version.

    Both versions are reduced to key and two 64-bit row hashes and grouped by key: one shuffle of narrow rows, folded by
    hash aggregation, and no join that a repeated or null key could blow up. A key found twice in one version is an error
    when the result is computed.
    """
    columns = sorted(set(old.columns) | set(new.columns))

    def narrow(df: DataFrame, other: DataFrame, side: int) -> DataFrame:
        # Both sides in one form that holds either's values, so that only equal values have equal hashes.
        padded = df.select(*[_comparable(df, other, c).alias(c) for c in columns])
        d, e = row_hashes(padded, columns)
        return padded.select(*keys, d.alias("_fm_d"), e.alias("_fm_e"), F.lit(side).alias("_fm_side"))

    both = narrow(old, new, 0).unionByName(narrow(new, old, 1))

    def side(value: int, aggregate, column: str) -> Column:
        return aggregate(F.when(F.col("_fm_side") == value, F.col(column)))

    grouped = both.groupBy(*keys).agg(
        *[side(i, F.max, c).alias(f"{c}_{n}") for i, n in enumerate(("old", "new")) for c in ("_fm_d", "_fm_e")],
        side(0, F.count, "_fm_d").alias("_fm_n_old"),
        side(1, F.count, "_fm_d").alias("_fm_n_new"),
    )
    change = (
        F.when((F.col("_fm_n_old") > 1) | (F.col("_fm_n_new") > 1), F.raise_error(F.lit("a key occurs twice in one version")))
        .when(F.col("_fm_n_old") == 0, "added")
        .when(F.col("_fm_n_new") == 0, "removed")
        .when((F.col("_fm_d_old") != F.col("_fm_d_new")) | (F.col("_fm_e_old") != F.col("_fm_e_new")), "changed")
    )
    return grouped.select(*keys, change.alias("change")).filter(F.col("change").isNotNull())


def _comparable(df: DataFrame, other: DataFrame, column: str) -> Column:
    """A column of one version in a form in which it equals the other version's where the values are equal.

    That is the type a union of both has, or text where one side is text. Whole numbers and decimals beside floating-point numbers
    have no such type without loss: they are compared as doubles, together with the text of those that are no double.
    """
    if column not in df.columns:
        return F.lit(None).cast(other.schema[column].dataType)
    x, kind = F.col(quoted(column)), df.schema[column].dataType
    if column not in other.columns or kind == (other_kind := other.schema[column].dataType):
        return x
    if isinstance(kind, T.StringType) or isinstance(other_kind, T.StringType):
        return x.cast("string")
    if _is_exact(kind) and _is_floating(other_kind) or _is_floating(kind) and _is_exact(other_kind):
        if _is_floating(kind):
            return F.struct(x.cast("double").alias("d"), F.lit(None).cast("string").alias("rest"))
        own = kind.simpleString() if isinstance(kind, T.DecimalType) else "long"
        # 2^63 as a double would be taken for the largest whole number.
        fits = F.lit(True) if isinstance(kind, T.DecimalType) else x.cast("double") < F.lit(2.0**63)
        is_double = F.coalesce(fits & (x.cast("double").try_cast(own) == x.cast(own)), F.lit(False))
        return F.when(x.isNotNull(), F.struct(x.cast("double").alias("d"), F.when(~is_double, x.cast("string")).alias("rest"))).otherwise(
            F.struct(F.lit(None).cast("double").alias("d"), F.lit(None).cast("string").alias("rest"))
        )
    return x.cast(df.select(quoted(column)).union(other.select(quoted(column))).schema.fields[0].dataType)


def _is_exact(kind: T.DataType) -> bool:
    return isinstance(kind, (T.IntegralType, T.DecimalType))


def _is_floating(kind: T.DataType) -> bool:
    return isinstance(kind, (T.FloatType, T.DoubleType))


def bag_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Without a key: rows whose number of copies differs, with that difference (new minus old).

    Copies are counted before the shuffle, so a row with very many copies is one row per task.
    """
    signed = old.withColumn("_fm_n", F.lit(-1)).unionByName(new.withColumn("_fm_n", F.lit(1)), allowMissingColumns=True)
    columns = [c for c in signed.columns if c != "_fm_n"]
    return signed.groupBy(*columns).agg(F.sum("_fm_n").alias("copies")).filter(F.col("copies") != 0)


def is_changed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> bool:
    """Whether rows, columns or types differ. A new column is a change even where it is null in all rows."""
    return schema_hash(old.schema) != schema_hash(new.schema) or not version_diff(old, new, keys).isEmpty()
