"""The feature macros as SQL functions, for users who only write SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

FUNCTIONS = {
    "clean_value": (
        "x DOUBLE, fallback DOUBLE DEFAULT 0D", "FLOAT", "coalesce(nanvl(cast(x as float), cast(fallback as float)), cast(fallback as float))",
        "A value as float32, null and NaN as the fallback.",
    ),
    "clean_text": (
        "x STRING, fallback DOUBLE DEFAULT 0D", "FLOAT", "coalesce(nanvl(try_cast(x as float), cast(fallback as float)), cast(fallback as float))",
        "Text as float32, what is no number as the fallback.",
    ),
    "normalized_columns": (
        "xs ARRAY<DOUBLE>", "ARRAY<FLOAT>", "transform(xs, x -> coalesce(nanvl(cast(x as float), cast(0 as float)), cast(0 as float)))",
        "Columns as float32, null and NaN as 0.",
    ),
    "coalesce_columns": (
        "xs ARRAY<DOUBLE>, fallback DOUBLE", "ARRAY<FLOAT>", "transform(xs, x -> coalesce(nanvl(cast(x as float), cast(fallback as float)), cast(fallback as float)))",
        "Columns as float32, null and NaN as the fallback.",
    ),
    "select_features": (
        "features MAP<STRING, DOUBLE>, names ARRAY<STRING>", "ARRAY<DOUBLE>", "transform(names, name -> features[name])", "Features of a map by name, in order; null where there is none.",
    ),
    "sum_features": ("xs ARRAY<FLOAT>", "DOUBLE", "aggregate(xs, 0D, (total, x) -> total + x)", "The sum over the features of a row."),
    "mean_features": ("xs ARRAY<FLOAT>", "DOUBLE", "aggregate(xs, 0D, (total, x) -> total + x, total -> total / size(xs))", "The mean over the features of a row."),
}


def register_functions(spark: SparkSession, prefix: str = "") -> list[str]:
    """Create the functions in the session, as temporary ones, and return their names. They are inlined: plans have the expressions, no call."""
    for name, (parameters, returns, body, comment) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS {returns} COMMENT '{comment}' RETURN {body}")
    return [prefix + name for name in FUNCTIONS]
