"""Hash functions whose values are the same in every engine that has md5."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def digest(*cols: Column | str) -> Column:
    """md5 over the columns' text, joined by `|`."""
    return F.md5(F.concat_ws("|", *[as_column(c).cast("string") for c in cols]))


def digest_number(text: Column, hex_digits: int = 8, offset: int = 1) -> Column:
    """The number spelled by `hex_digits` (15 at most) digits of an md5 text."""
    return F.conv(F.substring(text, offset, hex_digits), 16, 10).cast("long")


def md5_bucket(*cols: Column | str, buckets: int = 100) -> Column:
    """A bucket in `[0, buckets)` that depends on the key only, never on partitioning or engine."""
    return F.pmod(digest_number(digest(*cols)), F.lit(buckets).cast("long"))


def quoted(name: str) -> str:
    """A column name for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def row_hashes(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a row, computed in generated code. Null flags are hashed too, because a hash
    skips nulls; nested values are hashed as JSON for the same reason. Written as SQL text, since tables can be wide."""
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    parts, flags = [], []
    for name in sorted(df.columns if columns is None else columns):
        col = quoted(name)
        parts.append(f"to_json(struct({col}))" if isinstance(df.schema[name].dataType, nested) else col)
        flags.append(f"isnull({col})")
    text = ", ".join([*parts, *flags])
    return F.expr(f"xxhash64({text})"), F.expr(f"xxhash64(1, {text})")


def row_digest(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """A uniform text of 32 hex digits that depends on a row's content only."""
    return F.concat(*[F.lpad(F.lower(F.hex(h)), 16, "0") for h in row_hashes(df, columns)])


def schema_hash(schema: T.StructType) -> str:
    """A hash of the column names and types, independent of column order."""
    text = ",".join(sorted(f"{f.name}:{f.dataType.simpleString()}" for f in schema.fields))
    return hashlib.sha256(text.encode()).hexdigest()
