"""Stand-in inputs as frames and as SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import digest
from ..functions.vectors import doubles
from ..operators.staging import add_sample_ids, tag_source, union_by_name
from ..sinks.tables import ensure_databases
from ..sources.files import INGESTION_TIME, timestamp_literal
from ..workdir import new_path

RUN_TS = "2024-02-01 00:00:00"
EMULATOR_TS = "2024-01-01 00:00:00"
REAL_TS = "2024-01-02 00:00:00"


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_database(spark: SparkSession) -> str:
    """A new database in the work folder."""
    name = f"featmart_{uuid.uuid4().hex}"
    ensure_databases(spark, [name], location=new_path(spark, "database"))
    return name


def rounded(col: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(col) if isinstance(col, str) else col, digits)


# Two sources: customers have a family, suppliers have none; one ingestion time per source.

def emulator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("sample_key"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("family"),
        timestamp_literal(EMULATOR_TS).alias(INGESTION_TIME),
    )


def real_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("sample_key"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").alias("balance"),
        timestamp_literal(REAL_TS).alias(INGESTION_TIME),
    )


def tagged_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [tag_source(emulator(spark, sf_dir), "emulator", RUN_TS), tag_source(real_device(spark, sf_dir), "real_device", RUN_TS)]


def combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_by_name(tagged_sources(spark, sf_dir))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_sample_ids(combined(spark, sf_dir), tie=digest("data_source", "sample_key"))


TAGGED_EMULATOR_SQL = f"""
select c_custkey as sample_key, c_name as name, c_nationkey as nation, c_acctbal as balance, c_mktsegment as family,
       timestamp '{EMULATOR_TS}' as _ingestion_timestamp, 'emulator' as data_source, timestamp '{RUN_TS}' as _dbt_loaded_at
from customer"""
TAGGED_REAL_SQL = f"""
select s_suppkey as sample_key, s_name as name, s_nationkey as nation, s_acctbal as balance, cast(null as varchar) as family,
       timestamp '{REAL_TS}' as _ingestion_timestamp, 'real_device' as data_source, timestamp '{RUN_TS}' as _dbt_loaded_at
from supplier"""
COMBINED_SQL = f"{TAGGED_EMULATOR_SQL} union all {TAGGED_REAL_SQL}"
SAMPLES_SQL = f"""
select *, row_number() over (order by data_source, _ingestion_timestamp, md5(data_source || '|' || cast(sample_key as varchar))) as sample_id
from ({COMBINED_SQL})"""


def split_sql(key: str) -> str:
    """The split of a key, in SQL."""
    bucket = f"cast('0x' || substr(md5(cast({key} as varchar)), 1, 8) as bigint) % 100"
    return f"case when {bucket} < 70 then 'train' when {bucket} < 85 then 'validation' else 'test' end"


# Features: one row per order, counts and sums of its lines.

_COUNTS = {
    "read": "l_returnflag = 'A'",
    "write": "l_returnflag = 'N'",
    "open": "l_returnflag = 'R'",
    "close": "l_linestatus = 'O'",
    "socket": "l_linestatus = 'F'",
    "sendto": "l_tax > 0.04",
    "camera": "l_discount > 0.05",
    "send_sms": "l_quantity > 25",
}
_SUMS = {"clone": "cast(sum(l_quantity) as bigint)", "bind": "cast(sum(l_quantity * l_linenumber) as bigint)"}
FEATURES = [*_COUNTS, *_SUMS]
FEAT_SQL = (
    "select l_orderkey as sample_id, "
    + ", ".join(f"cast(sum(case when {cond} then 1 else 0 end) as bigint) as {name}" for name, cond in _COUNTS.items())
    + ", "
    + ", ".join(f"{expr} as {name}" for name, expr in _SUMS.items())
    + " from lineitem group by l_orderkey"
)
GAPS_SQL = "select sample_id, " + ", ".join(f"nullif({f}, 0) as {f}" for f in FEATURES) + f" from ({FEAT_SQL})"


def feat(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    counts = [F.count_if(F.expr(cond)).alias(name) for name, cond in _COUNTS.items()]
    sums = [F.expr(expr).alias(name) for name, expr in _SUMS.items()]
    return lines.groupBy(F.col("l_orderkey").alias("sample_id")).agg(*counts, *sums)


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features with nulls for zeros."""
    return feat(spark, sf_dir).select("sample_id", *[F.nullif(F.col(f), F.lit(0)).alias(f) for f in FEATURES])


# Two result sets: the second is rounded, lacks the samples of one label and has short vectors for another.

def results_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("sample_id"), doubles(F.col("embedding")).alias("outputs"))


def results_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    coarse = F.transform(doubles(F.col("embedding")), lambda x: F.round(x, 2))
    coarser = F.transform(doubles(F.col("embedding")), lambda x: F.round(x, 1))
    values = F.when(F.col("label") == 8, coarser).otherwise(coarse)
    rows = table(spark, sf_dir, "embeddings").filter(F.col("label") != 3)
    return rows.select(
        F.col("vec_id").alias("sample_id"), F.when(F.col("label") == 5, F.slice(values, 1, 60)).otherwise(values).alias("outputs")
    )


A_SQL = "select vec_id as sample_id, cast(embedding as double[]) as outputs from embeddings"
B_SQL = f"""
select vec_id as sample_id, case when label = 5 then list_slice(v, 1, 60) else v end as outputs
from (select vec_id, label,
             case when label = 8 then [round(x, 1) for x in cast(embedding as double[])]
                  else [round(x, 2) for x in cast(embedding as double[])] end as v
      from embeddings where label <> 3)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features and their reconstruction: both result sets side by side."""
    a = results_a(spark, sf_dir).withColumnRenamed("outputs", "features")
    return a.join(results_b(spark, sf_dir).withColumnRenamed("outputs", "reconstructed"), "sample_id")


SCORED_SQL = f"""
select sample_id, a.outputs as features, b.outputs as reconstructed
from ({A_SQL}) a join ({B_SQL}) b using (sample_id) where len(a.outputs) = len(b.outputs)"""
DIFFS_SQL = f"""
select sample_id, [abs(features[i] - reconstructed[i]) for i in range(1, len(features) + 1)] as d from ({SCORED_SQL})"""


# Latencies: milliseconds with fractions per event type.

def latencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("model"),
        F.col("event_id").cast("string").alias("sample_id"),
        F.col("value").alias("latency_ms"),
        F.array(F.col("value").cast("float")).alias("outputs"),
    )


LAT_SQL = "select event_type as model, cast(event_id as varchar) as sample_id, value as latency_ms, value from events"


# Two versions of the orders: each lacks some orders of the other, and some prices changed.

def version_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(~((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "F")))


def version_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").filter(~((F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "O")))
    raised = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
    return orders.withColumn("o_totalprice", F.when(raised, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))


V1_SQL = "select * from orders where not (o_orderpriority = '5-LOW' and o_orderstatus = 'F')"
V2_SQL = """
select * replace (case when o_orderpriority = '1-URGENT' and o_orderstatus = 'P' then o_totalprice + 1 else o_totalprice end as o_totalprice)
from orders where not (o_orderpriority = '4-NOT SPECIFIED' and o_orderstatus = 'O')"""
