"""Data quality checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(RuntimeError):
    """A table failed its checks."""


@dataclass(frozen=True)
class Checks:
    """What a table must satisfy."""

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    accepted: Mapping[str, Sequence] = field(default_factory=dict)

    def columns(self) -> list[str]:
        return [*self.not_null, *self.unique, *self.accepted]


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; nulls do not count. Copies collapse before the shuffle."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("occurrences"))
    return counts.filter(F.col("occurrences") > 1)


def _require(df: DataFrame, checks: Checks) -> None:
    absent = sorted({c for c in checks.columns() if c not in df.columns})
    if absent:
        raise QualityError(f"checked columns are absent: {', '.join(absent)}")


def report(df: DataFrame, checks: Checks) -> DataFrame:
    """One row per check: `(check, column_name, failures)`.

    All not-null and accepted-value checks are one aggregate over one scan; each unique check is one more.
    """
    _require(df, checks)

    def entry(check: str, column: str, failures: Column) -> Column:
        return F.struct(F.lit(check).alias("check"), F.lit(column).alias("column_name"), failures.alias("failures"))

    entries = [entry("not_null", c, F.count_if(F.col(c).isNull())) for c in checks.not_null]
    # A null is left to not_null.
    entries += [
        entry("accepted_values", c, F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*values))) for c, values in checks.accepted.items()
    ]
    parts = []
    if entries:
        row = df.agg(*[e.alias(f"e_{i}") for i, e in enumerate(entries)])
        parts.append(row.select(F.explode(F.array(*row.columns)).alias("e")).select("e.*"))
    for c in checks.unique:
        parts.append(duplicates(df, c).agg(entry("unique", c, F.count(F.lit(1))).alias("e")).select("e.*"))
    if not parts:
        raise ValueError("no checks given")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def require(df: DataFrame, checks: Checks, table: str = "table") -> None:
    """Raise when a check fails; the report has one row per check."""
    failed = [r for r in report(df, checks).collect() if r["failures"]]
    if failed:
        text = "; ".join(f"{r['check']}({r['column_name']}): {r['failures']}" for r in failed)
        raise QualityError(f"{table}: {text}")
