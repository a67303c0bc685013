"""Newest row per key, found on narrow rows and fetched by its place in the files."""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import quoted
from ..workdir import cut

_PLACE, _ORDER = "_fm_place", "_fm_order"
MAX_WINNERS = 1_000_000
FILTER_BITS, _MAP_SHIFT = 26, 15  # Spark's bitmaps have 2^15 bits

# How many values a type has, null included; times are those of the years 1 to 9999 in microseconds.
_VALUES = {
    T.TimestampType: 320 * 10**15, T.TimestampNTZType: 320 * 10**15, T.DateType: 4 * 10**6,
    T.LongType: 2**64 + 1, T.IntegerType: 2**32 + 1, T.ShortType: 2**16 + 1, T.ByteType: 2**8 + 1, T.BooleanType: 3,
}
_LARGEST = 10**38


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    timestamp: str,
    tie: Sequence[str] = (),
    start: Column | None = None,
    end: Column | None = None,
    max_winners: int = MAX_WINNERS,
) -> DataFrame:
    """The newest row of each key with `start <= timestamp < end`.

    The first pass reads keys, time and ties only: a hash aggregate keeps per key the place (file and row number) of its
    newest row, so a key that holds most rows costs no more than any other and nothing is sorted. The second pass fetches
    the rows at these places. Up to `max_winners` places, of 16 bytes each, are broadcast. More of them are matched by a shuffle, for
    which a bitmap of fixed size first drops rows that are no key's newest. `tie` columns decide between rows of one time;
    name enough of them to make the order total. Null times and ties come before all others.

    Frames that are no plain scan of Parquet files are written out first.
    """
    if start is not None:
        df = df.filter(F.col(timestamp) >= start)
    if end is not None:
        df = df.filter(F.col(timestamp) < end)
    if "_metadata" in df.columns:
        # Spark's own column of that name holds the places.
        renamed = latest_per_key(df.withColumnRenamed("_metadata", "_fm_metadata"), keys, timestamp, tie, max_winners=max_winners)
        return renamed.withColumnRenamed("_fm_metadata", "_metadata")
    if not _has_places(df):
        df = cut(df, "latest-input")
    winners = cut(newest_places(df, keys, timestamp, tie), "newest-places")
    columns = [F.col(quoted(c)) for c in df.columns]
    located = df.select(*columns, _place().alias(_PLACE))
    if winners.count() <= max_winners:
        found = located.join(F.broadcast(winners), _PLACE, "left_semi")
    else:
        # An inner join, since a semi join would be moved below the filter; places are unique.
        found = _maybe_among(located, winners).join(winners, _PLACE)
    return found.select(*columns)


def newest_places(df: DataFrame, keys: Sequence[str], timestamp: str, tie: Sequence[str] = ()) -> DataFrame:
    """The place of each key's newest row in a scan of Parquet files.

    Times and whole numbers that together fit 38 digits become one number, which aggregates by hash. Other orders, such as text,
    are compared as they are, on narrow rows.
    """
    order = _as_number(df, [timestamp, *tie])
    if order is None:
        order = F.struct(*[F.col(quoted(c)) for c in (timestamp, *tie)])
    narrow = df.select(*[F.col(quoted(k)) for k in keys], order.alias(_ORDER), _place().alias(_PLACE))
    newest = narrow.groupBy(*[F.col(quoted(k)) for k in keys]).agg(F.max_by(_PLACE, _ORDER).alias(_PLACE))
    return newest.select(_PLACE).filter(F.col(_PLACE).isNotNull())


def _has_places(df: DataFrame) -> bool:
    try:
        return "row_index" in df.select("_metadata").schema["_metadata"].dataType.names
    except AnalysisException:
        return False


def _place() -> Column:
    """File and row number as one number: the file's path by a 64-bit hash, the row below 10^13."""
    file = F.xxhash64("_metadata.file_path").cast("decimal(20,0)") + F.lit(Decimal(2**63))
    return (file * F.lit(Decimal(10**13)) + F.col("_metadata.row_index").cast("decimal(13,0)")).cast("decimal(38,0)")


def _as_number(df: DataFrame, columns: Sequence[str]) -> Column | None:
    """One number in the order of the columns, or None where it would be too large or a type has no such number."""
    kinds = [df.schema[c].dataType for c in columns]
    values = [next((n for kind, n in _VALUES.items() if isinstance(k, kind)), None) for k in kinds]
    if None in values or math.prod(values) >= _LARGEST:
        return None
    total = F.lit(Decimal(0)).cast("decimal(38,0)")
    for i, (c, kind) in enumerate(zip(columns, kinds)):
        weight = math.prod(values[i + 1 :])
        weighted = _whole(F.col(quoted(c)), kind).cast("decimal(20,0)") * F.lit(Decimal(weight))
        total = (total + F.coalesce(weighted.cast("decimal(38,0)"), F.lit(Decimal(0)))).cast("decimal(38,0)")
    return total


def _whole(x: Column, kind: T.DataType) -> Column:
    """A value as a positive whole number; 0 is left for null."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(x) + F.lit(62_200_000_000_000_000)
    if isinstance(kind, T.TimestampNTZType):
        # Parts, since a change to another zone would fold an hour in autumn.
        seconds = (F.unix_date(x.cast("date")) * F.lit(86_400).cast("long")) + F.hour(x) * 3600 + F.minute(x) * 60
        return (seconds * F.lit(1_000_000)) + (F.extract(F.lit("SECOND"), x) * 1_000_000).cast("long") + F.lit(62_200_000_000_000_000)
    if isinstance(kind, T.DateType):
        return F.unix_date(x) + F.lit(800_000)
    if isinstance(kind, T.BooleanType):
        return x.cast("int") + 1
    bits = {T.LongType: 63, T.IntegerType: 31, T.ShortType: 15, T.ByteType: 7}[type(kind)]
    return x.cast("decimal(20,0)") + F.lit(Decimal(2**bits + 1))


def _maybe_among(located: DataFrame, winners: DataFrame) -> DataFrame:
    """Rows whose place may be one of the winners': all of these, and few others while winners are fewer than 2^26."""

    def slot(place: Column) -> Column:
        return F.pmod(F.xxhash64(place), F.lit(1 << FILTER_BITS))

    at = slot(F.col(_PLACE))
    maps = winners.groupBy(F.shiftright(at, _MAP_SHIFT).alias("_fm_part")).agg(
        F.bitmap_construct_agg(at.bitwiseAND(F.lit((1 << _MAP_SHIFT) - 1))).alias("_fm_bits")
    )
    # At most 2^11 maps of 2^12 bytes.
    marked = located.withColumn("_fm_slot", at).join(F.broadcast(maps), F.shiftright("_fm_slot", _MAP_SHIFT) == F.col("_fm_part"))
    bit = F.col("_fm_slot").bitwiseAND(F.lit((1 << _MAP_SHIFT) - 1))
    byte = F.conv(F.hex(F.substring(F.col("_fm_bits"), (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    chosen = F.expr("shiftright(_fm_byte, cast(_fm_bit & 7 as int)) & 1") == 1
    return marked.withColumns({"_fm_byte": byte, "_fm_bit": bit}).filter(chosen).drop("_fm_part", "_fm_bits", "_fm_slot", "_fm_byte", "_fm_bit")


def newest_of_all(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The one newest row; without rows there is none."""
    return latest_per_key(df, [], order[0], order[1:])
