"""What a catalog holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.normalize import describe
from ..sources.files import first_rows


def namespaces(spark: SparkSession, catalog: str | None = None) -> DataFrame:
    return spark.sql(f"SHOW NAMESPACES{f' IN {catalog}' if catalog else ''}")


def tables(spark: SparkSession, namespace: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {namespace}").filter(~F.col("isTemporary")).select("namespace", "tableName")


def table_counts(spark: SparkSession, namespace: str) -> list[tuple[str, int]]:
    """Rows of every table of a namespace; one count per table, from file footers where there are any."""
    return [(r["tableName"], spark.table(f"{namespace}.{r['tableName']}").count()) for r in tables(spark, namespace).collect()]


def explore(spark: SparkSession, name: str, rows: int = 10) -> dict[str, object]:
    """Schema, row count, first rows and column statistics of a table."""
    df = spark.table(name)
    return {"schema": df.schema, "rows": df.count(), "sample": first_rows(df, rows, df.columns), "statistics": describe(df)}
