"""Feature columns: choice, cleaning, row statistics, on-demand scores."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import quoted
from ..functions.vectors import array_variance, clean_number

Transform = Callable[[DataFrame], DataFrame]

# Columns that are never features.
NOT_FEATURES = (
    "sample_id", "dataset_split", "data_source", "event_timestamp", "feature_timestamp", "_dbt_loaded_at", "_source_file",
    "_ingestion_timestamp", "label", "malware_family", "first_seen_year", "hash_value",
)

# Columns of the three on-demand scores and the limit of the activity flag.
ACTIVITY_COLUMNS = ("read", "write", "open", "close", "clone", "socket", "connect")
NETWORK_COLUMNS = ("socket", "connect", "sendto", "recvfrom", "bind")
PERMISSION_COLUMNS = ("send_sms", "record_audio", "camera", "read_phone_state")
HIGH_ACTIVITY = 1000
HIGH_SYSCALL_TOTAL = 100


def choose_features(
    df: DataFrame, requested: Sequence[str] = (), exclude: Sequence[str] = NOT_FEATURES, limit: int | None = None
) -> list[str]:
    """The requested columns that exist; if none does, all numeric columns by name, or the first `limit` of them."""
    present = [c for c in requested if c in df.columns]
    if present:
        return present
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]
    return sorted(numeric)[:limit]


def first_numeric(df: DataFrame, limit: int | None = 5) -> list[str]:
    """The first double, float, int and bigint columns in table order; all with a limit of None."""
    kinds = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)][:limit]


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def number_text(value: float) -> str:
    """A double as SQL text."""
    return f"({value!r}D)" if math.isfinite(value) else f"cast('{value}' as double)"


def cleaned_text(df: DataFrame, name: str, default: float = 0.0) -> str:
    """`cleaned` as SQL text: tables have hundreds of features, and one parsed text is far cheaper than many calls."""
    convert = "try_cast" if is_text(df, name) else "cast"
    fallback = f"cast({number_text(default)} as float)"
    return f"coalesce(nanvl({convert}({quoted(name)} as float), {fallback}), {fallback})"


def cleaned(df: DataFrame, name: str, default: float = 0.0) -> Column:
    """A column as float32 with null and NaN, and for text columns anything unreadable, as the default."""
    return F.expr(cleaned_text(df, name, default))


def normalized_names(prefix: str = "syscall", count: int = 20, suffix: str = "_normalized") -> list[str]:
    return [f"{prefix}_{i}{suffix}" for i in range(1, count + 1)]


def normalized_columns(df: DataFrame, prefix: str = "syscall", count: int = 20, suffix: str = "_normalized") -> list[Column]:
    """`prefix_i` cleaned, as `prefix_i_normalized`."""
    names = normalized_names(prefix, count, suffix)
    return [cleaned(df, f"{prefix}_{i}").alias(n) for i, n in enumerate(names, start=1)]


def safe_columns(df: DataFrame, columns: Sequence[str], default: float = 0.0) -> list[Column]:
    return [cleaned(df, c, default).alias(f"{c}_safe") for c in columns]


def select_normalized(df: DataFrame, prefix: str = "syscall", count: int = 20, suffix: str = "_normalized") -> DataFrame:
    return df.select(*normalized_names(prefix, count, suffix))


def row_sum(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c).cast("double") for c in columns])


def row_mean(columns: Sequence[str]) -> Column:
    return row_sum(columns) / F.lit(float(len(columns)))


def row_variance(columns: Sequence[str], mean: Column | None = None) -> Column:
    """Population variance over the columns of a row; give the mean's column where there is one."""
    if mean is None:
        return array_variance(F.array(*[F.col(c).cast("double") for c in columns]))
    squares = [(F.col(c).cast("double") - mean) * (F.col(c).cast("double") - mean) for c in columns]
    return reduce(lambda a, b: a + b, squares) / F.lit(float(len(columns)))


def with_row_statistics(df: DataFrame, prefix: str = "syscall", count: int = 20) -> DataFrame:
    """Normalized columns with their total, mean, variance and activity flag."""
    names = normalized_names(prefix, count)
    others = [c for c in df.columns if c not in names]
    base = df.select(*others, *normalized_columns(df, prefix, count))
    summed = base.withColumn(f"{prefix}_total", row_sum(names))
    averaged = summed.withColumn(f"{prefix}_mean", F.col(f"{prefix}_total") / F.lit(float(count)))
    return averaged.withColumns(
        {
            f"{prefix}_variance": row_variance(names, F.col(f"{prefix}_mean")),
            "is_high_activity": (F.col(f"{prefix}_total") > HIGH_SYSCALL_TOTAL).cast("int"),
        }
    )


def score(df: DataFrame, columns: Sequence[str]) -> Column:
    """Sum of those of the columns that exist, nulls as 0; 0 when none exists."""
    present = [clean_number(c, text=is_text(df, c)) for c in columns if c in df.columns]
    return reduce(lambda a, b: a + b, present, F.lit(0.0))


def with_on_demand_scores(df: DataFrame) -> DataFrame:
    """The activity, network and permission scores that are computed when features are read."""
    activity = score(df, ACTIVITY_COLUMNS)
    return df.withColumns(
        {
            "syscall_activity_score": activity,
            "is_high_syscall_activity": (activity > HIGH_ACTIVITY).cast("long"),
            "network_activity_score": score(df, NETWORK_COLUMNS),
            "permission_risk_score": score(df, PERMISSION_COLUMNS),
        }
    )


def feature_map(columns: Sequence[str]) -> Column:
    """Features of a row as a map from name to double."""
    return F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*[F.col(c).cast("double") for c in columns]))


def map_value(features: Column | str, name: str) -> Column:
    return F.try_element_at(F.col(features) if isinstance(features, str) else features, F.lit(name))


def feature_vector(df: DataFrame, columns: Sequence[str]) -> Column:
    """Features of a row as cleaned `array<float>`."""
    return F.expr(f"array({', '.join(cleaned_text(df, c) for c in columns)})")


def chain(df: DataFrame, *transforms: Transform) -> DataFrame:
    """Apply frame functions one after the other."""
    return reduce(lambda frame, step: frame.transform(step), transforms, df)


def with_user_features(df: DataFrame, function, inputs: Sequence[str], schema: T.StructType) -> DataFrame:
    """Append columns from a user function that maps a pandas frame of `inputs` to one of `schema`, batch by batch."""

    @F.pandas_udf(schema)
    def apply(batch: pd.DataFrame) -> pd.DataFrame:
        return function(batch)

    # A struct argument reaches the function as a pandas frame.
    made = df.withColumn("_fm_user", apply(F.struct(*inputs)))
    return made.select(*df.columns, "_fm_user.*")
