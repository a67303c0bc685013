"""Whole calls of the library: retrieval through the store, evaluation, gates, ledgers, tables written and read back."""

from __future__ import annotations

import uuid
from datetime import datetime

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import features as ops
from ..operators import marts, model, quality
from ..operators.splits import hash_split
from ..plans import catalog
from ..plans.evaluate import evaluate
from ..plans.lineage import RunLog, find_model, newest_values
from ..session import substitute
from ..sinks import tables
from ..sources.files import INGESTION_TIME, SOURCE_FILE, read_table, run_query
from ..store.definitions import on_demand_scores
from ..store.feature_store import FeatureStore
from ..store.registry import Entity, FeatureView, Registry
from ..workdir import new_path
from .base import COMBINED_SQL, FEATURES, GAPS_SQL, RUN_TS, Query, combined, feat, gaps, rounded, scratch_database, split_sql, table
from .comparing import net_sql

_N = len(FEATURES)

# Retrieval


def _order_store(spark, sf_dir) -> FeatureStore:
    """Features of orders, known from the day their last line was shipped and valid for 1,000 days."""
    shipped = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("sample_id")).agg(F.max("l_shipdate").alias("shipped"))
    view = FeatureView("order_features", ("order",), tuple((f, T.LongType()) for f in FEATURES), "shipped", "orders_wide", "1000 days")
    registry = Registry([Entity("order", ("sample_id",), T.LongType())], [view], [on_demand_scores(view)])
    return FeatureStore(spark, registry, new_path(spark, "store"), {"orders_wide": feat(spark, sf_dir).join(shipped, "sample_id")}, buckets=8)


def store_history(spark, sf_dir):
    """Stored and derived features of every order 90 days after it was placed."""
    when = (F.col("o_orderdate") + F.expr("interval 90 days")).alias("event_timestamp")
    entities = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sample_id"), when)
    return _order_store(spark, sf_dir).get_historical_features(entities, ["order_features:read", "order_features:clone", "malware_derived_features:*"])


_WIDE_SQL = f"""
select f.*, shipped from (select sample_id, {', '.join(f'coalesce({f}, 0) as {f}' for f in FEATURES)} from ({GAPS_SQL})) f
join (select l_orderkey, max(l_shipdate) as shipped from lineitem group by l_orderkey) on l_orderkey = sample_id"""
_SCORES = """cast(coalesce(read + write + open + close + clone + socket, 0) as double) as syscall_activity_score,
       cast(coalesce(read + write + open + close + clone + socket > 1000, false) as bigint) as is_high_syscall_activity,
       cast(coalesce(socket + sendto + bind, 0) as double) as network_activity_score,
       cast(coalesce(send_sms + camera, 0) as double) as permission_risk_score"""
_HISTORY_SQL = f"""
select o_orderkey as sample_id, o_orderdate + interval 90 day as event_timestamp, read, clone, {_SCORES}
from orders left join ({_WIDE_SQL}) f
on sample_id = o_orderkey and shipped <= o_orderdate + interval 90 day and shipped >= o_orderdate + interval 90 day - interval 1000 day"""


def store_online(spark, sf_dir):
    """Derived features of orders shipped in a year, from the online table."""
    store = _order_store(spark, sf_dir)
    store.materialize("order_features", "1996-01-01 00:00:00", "2000-01-01 00:00:00")
    keys = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sample_id"))
    return store.get_online_features(["order_features:bind", "malware_derived_features:network_activity_score"], keys)


_ONLINE_SQL = f"""
select o_orderkey as sample_id, bind, cast(coalesce(socket + sendto + bind, 0) as double) as network_activity_score
from orders left join ({_WIDE_SQL}) f
on sample_id = o_orderkey and shipped >= timestamp '1996-01-01 00:00:00' and shipped < timestamp '2000-01-01 00:00:00'"""


def store_batch_view(spark, sf_dir):
    return _order_store(spark, sf_dir).get_batch_view("order_features")


# Evaluation

_POSITIONS = 64
_SMALL_NET = model.Autoencoder.random(_POSITIONS, 2, (3,), seed=7)
_FIGURES = ("eval_samples", "test_loss", "test_mse", "test_mae", "test_mse_min", "test_mse_max", "test_max_feature_error", "test_min_feature_error")


def _evaluation(spark, sf_dir):
    """A model without a saved normalizer on the test split."""
    columns = [F.col("embedding")[i].alias(f"e_{i}") for i in range(_POSITIONS)]
    rows = hash_split(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("sample_id"), *columns), "sample_id")
    return evaluate(rows, [f"e_{i}" for i in range(_POSITIONS)], _SMALL_NET)


def evaluate_report(spark, sf_dir):
    """Figures, errors per feature and errors per sample as (kind, name, value)."""
    result = _evaluation(spark, sf_dir)
    figures = result.summary.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value")) for n in _FIGURES])).alias("f"))
    parts = [
        figures.select(F.lit("figure").alias("kind"), "f.name", "f.value"),
        result.features.select(F.lit("feature").alias("kind"), "feature_name", "mean_squared_error"),
        result.samples.select(F.lit("sample").alias("kind"), F.col("sample_id").cast("string"), "mse"),
    ]
    return parts[0].union(parts[1]).union(parts[2]).withColumn("value", rounded("value", 7))


def evaluate_export(spark, sf_dir):
    """The errors per sample and per feature, exported as CSV and read again."""
    path = new_path(spark, "export")
    _evaluation(spark, sf_dir).export(path)
    read = spark.read.option("header", True)
    samples = read.schema("sample_id string, value double").csv(f"{path}/error_distribution", enforceSchema=True)
    features = read.schema("feature_name string, value double").csv(f"{path}/feature_errors", enforceSchema=True)
    return samples.toDF("name", "value").union(features).withColumn("value", rounded("value", 7))


def _evaluate_sql() -> str:
    columns = [f"e_{i}" for i in range(_POSITIONS)]
    values = ", ".join(f"cast(embedding[{i + 1}] as double) as {c}" for i, c in enumerate(columns))
    fit = ", ".join(f"avg({c}) as m_{c}, stddev_pop({c}) + 1e-8 as s_{c}" for c in columns)
    normal = ", ".join(f"({c} - m_{c}) / s_{c}" for c in columns)
    vectors = f"select sample_id, [{normal}] as x0 from rows, fit"
    last = len(_SMALL_NET.encoder) + len(_SMALL_NET.decoder)
    figures = {
        "eval_samples": "select count(*) from errors", "test_loss": "select avg(mse) from errors", "test_mse": "select avg(mse) from errors",
        "test_mae": "select avg(mae) from errors", "test_mse_min": "select min(mse) from errors", "test_mse_max": "select max(mse) from errors",
        "test_max_feature_error": "select max(v) from by_feature", "test_min_feature_error": "select min(v) from by_feature",
    }
    return f"""
with rows as (select vec_id as sample_id, {values} from embeddings where {split_sql('vec_id')} = 'test'),
     fit as (select {fit} from rows),
     diffs as (select sample_id, [abs(x0[i] - x{last}[i]) for i in range(1, {_POSITIONS + 1})] as d from ({net_sql(_SMALL_NET, vectors)})),
     errors as (select sample_id, list_avg([x * x for x in d]) as mse, list_avg(d) as mae from diffs),
     by_feature as (select 'e_' || cast(pos as varchar) as name, avg(x * x) as v
                    from (select unnest(range({_POSITIONS})) as pos, unnest(d) as x from diffs) group by pos)
select 'sample' as kind, cast(sample_id as varchar) as name, round(mse, 7) as value from errors
union all select 'feature', name, round(v, 7) from by_feature
""" + "".join(f"union all select 'figure', '{n}', round(cast(({q}) as double), 7)\n" for n, q in figures.items())


# Gates and ledgers


def build_gate(spark, sf_dir):
    """A gate that holds passes; one that does not stops the run and says which checks failed how often."""
    orders = table(spark, sf_dir, "orders")
    quality.require(orders, quality.Checks(not_null=["o_orderkey"], unique=["o_orderkey"]), "orders")
    try:
        quality.require(orders, quality.Checks(not_null=["o_orderkey"], unique=["o_custkey"], accepted={"o_orderstatus": ["F", "O"]}), "orders")
    except quality.QualityError as error:
        return spark.range(1).select(F.lit(str(error)).alias("stopped_by"))
    raise AssertionError("the gate let failing rows pass")


_GATE_SQL = """
select 'orders: accepted_values(o_orderstatus): ' || (select count(*) from orders where o_orderstatus not in ('F', 'O'))
       || '; unique(o_custkey): ' || (select count(*) from (select o_custkey from orders group by 1 having count(*) > 1)) as stopped_by"""
_RUN_FEATURES = ("o_totalprice", "o_custkey")


def run_log(spark, sf_dir):
    """What a run was trained on and what it reached; a value that is logged again replaces the first one."""
    rows = hash_split(table(spark, sf_dir, "orders"), "o_orderkey")
    counts = {r["dataset_split"]: r["count"] for r in rows.groupBy("dataset_split").count().collect()}
    log = RunLog(spark, new_path(spark, "runs"))
    log.log_dataset("run-1", rows, counts, _RUN_FEATURES, "c1", datetime(2024, 1, 1))
    log.log_metrics("run-1", {"loss": 0.5}, datetime(2024, 1, 1))
    log.log_metrics("run-1", {"loss": 0.25}, datetime(2024, 1, 2))
    log.set_tags("run-1", {"stage": substitute("run of ${NAME}", {"NAME": "orders"})}, datetime(2024, 1, 1))
    return newest_values(log.entries())


_RUN_LOG_SQL = f"""
select 'run-1' as run_id, 'data/' || dataset_split || '_samples' as key, cast(count(*) as varchar) as value
from (select {split_sql('o_orderkey')} as dataset_split from orders) group by dataset_split
union all select 'run-1', 'data/commit', 'c1'
union all select 'run-1', 'data/feature_names', '["o_totalprice", "o_custkey"]'
union all select 'run-1', 'data/feature_schema_hash', sha256('o_custkey:bigint,o_totalprice:double')
union all select 'run-1', 'loss', '0.25'
union all select 'run-1', 'stage', 'run of orders'"""
_MODEL_BRANDS = ("Brand#3", "Brand#8", "Brand#13")


def model_find(spark, sf_dir):
    """The newest version in production of some models, and one version by number."""
    part = table(spark, sf_dir, "part")
    stage = F.when(F.col("p_type") == "PROMO", "Production").otherwise("Staging").alias("stage")
    models = part.groupBy(F.col("p_brand").alias("model"), F.col("p_size").cast("string").alias("version"), stage)
    models = models.agg(F.min("p_partkey").cast("string").alias("run_id"))
    found = find_model(models, _MODEL_BRANDS[0], "7")
    for brand in _MODEL_BRANDS:
        found = found.unionByName(find_model(models, brand, "production"))
    return found


_FIND_SQL = f"""
with m as (select p_brand as model, p_size, case when p_type = 'PROMO' then 'Production' else 'Staging' end as stage, min(p_partkey) as run
           from part group by all)
select model, cast(p_size as varchar) as version, stage, cast(run as varchar) as run_id from
(select * from m where model = '{_MODEL_BRANDS[0]}' and p_size = 7
 union all
 select * from (select * from m where stage = 'Production' and model in ({', '.join(f"'{b}'" for b in _MODEL_BRANDS)})
                qualify row_number() over (partition by model order by p_size desc) = 1))"""


def dim_sources_plain(spark, sf_dir):
    """Sources without ingestion times: the year is that of the run."""
    return marts.source_dimension(combined(spark, sf_dir).drop(INGESTION_TIME), RUN_TS)


_PLAIN_SQL = f"""
select data_source as family_id, data_source as family_name, true as is_data_source, count(*) as total_samples, count(*) as unique_samples,
       count(*) filter (data_source = 'emulator') as emulator_count, count(*) filter (data_source = 'real_device') as real_device_count,
       cast(year(timestamp '{RUN_TS}') as integer) as earliest_year, cast(year(timestamp '{RUN_TS}') as integer) as latest_year,
       1 as year_span, timestamp '{RUN_TS}' as _dbt_loaded_at
from ({COMBINED_SQL}) group by data_source"""


# User functions


def user_features(spark, sf_dir):
    """Frame functions in a chain, then a user's pandas function on their columns."""
    numbered = gaps(spark, sf_dir).select("sample_id", *[F.col(f).alias(f"syscall_{i}") for i, f in enumerate(FEATURES, 1)])
    normalized = ops.chain(
        numbered,
        lambda df: df.select("sample_id", *ops.normalized_columns(df, "syscall", _N)),
        lambda df: df.withColumn("syscall_1_normalized", F.col("syscall_1_normalized") + 1),
    )
    first, last = "syscall_1_normalized", f"syscall_{_N}_normalized"

    def ratio(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"share": batch[first] / (batch[first] + batch[last]), "larger": batch[[first, last]].max(axis=1)})

    names = ops.select_normalized(normalized, "syscall", _N).columns
    made = ops.with_user_features(normalized.select("sample_id", *[F.col(n).cast("double").alias(n) for n in names]), ratio, [first, last], "share double, larger double")
    return made.withColumn("share", rounded("share"))


_USER_SQL = f"""
select *, round(syscall_1_normalized / (syscall_1_normalized + syscall_{_N}_normalized), 6) as share,
       greatest(syscall_1_normalized, syscall_{_N}_normalized) as larger
from (select sample_id, {', '.join(f"cast(coalesce({f}, 0) as double){' + 1' if i == 1 else ''} as syscall_{i}_normalized" for i, f in enumerate(FEATURES, 1))}
      from ({GAPS_SQL}))"""


# Tables


def table_roundtrip(spark, sf_dir):
    """Orders written as a partitioned table, then appended to, with the rows that each write reported."""
    name = f"{scratch_database(spark)}.orders"
    orders = table(spark, sf_dir, "orders")
    first = tables.write_table(orders.filter(F.col("o_orderstatus") != "P"), name, partition_by=["o_orderstatus"])
    second = tables.write_table(orders.filter(F.col("o_orderstatus") == "P"), name, mode="append", partition_by=["o_orderstatus"])
    return read_table(spark, name).withColumns({"first_rows": F.lit(first), "second_rows": F.lit(second)})


_ROUNDTRIP_SQL = """
select *, (select count(*) from orders where o_orderstatus <> 'P') as first_rows, (select count(*) from orders where o_orderstatus = 'P') as second_rows
from orders"""
_LAYER = ("orders", "customer", "lineitem")


def catalog_counts(spark, sf_dir):
    """A layer published as tables, and what the catalog then lists."""
    database = scratch_database(spark)
    tables.publish_layer({n: table(spark, sf_dir, n) for n in _LAYER}, as_views=False, database=database)
    return spark.createDataFrame(catalog.table_counts(spark, database), "table_name string, rows long")


def view_query(spark, sf_dir):
    """A layer published as views, and a query on it with a named parameter."""
    name = f"orders_{uuid.uuid4().hex}"
    tables.publish_layer({name: table(spark, sf_dir, "orders")}, as_views=True)
    return run_query(spark, f"select o_custkey, count(*) as n_orders from {name} where o_totalprice >= :least group by o_custkey", least=1000.0)


_CSV_TABLES = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey"}


def _csv_folders(spark, sf_dir) -> str:
    """Three tables as folders of CSV parts."""
    source = new_path(spark, "csv")
    for name in _CSV_TABLES:
        tables.write_csv(table(spark, sf_dir, name).repartition(3), f"{source}/{name}")
    return source


def _side_by_side(spark, target):
    """All columns of the three tables below each other, as (table, key, row)."""
    rows = [spark.read.parquet(f"{target}/{name}").select(F.lit(name).alias("table_name"), F.col(key).cast("long").alias("key"), "*") for name, key in _CSV_TABLES.items()]
    return rows[0].unionByName(rows[1], allowMissingColumns=True).unionByName(rows[2], allowMissingColumns=True)


def csv_parquet(spark, sf_dir):
    """CSV parts of three tables as Parquet tables."""
    target = new_path(spark, "parquet")
    tables.csv_to_parquet(spark, _csv_folders(spark, sf_dir), target)
    return _side_by_side(spark, target)


def raw_load(spark, sf_dir):
    """CSV parts of three tables, loaded as raw tables with provenance; the parts' own names differ from run to run."""
    target = new_path(spark, "raw")
    tables.load_raw(spark, _csv_folders(spark, sf_dir), target, RUN_TS)
    rows = _side_by_side(spark, target)
    return rows.withColumn(SOURCE_FILE, F.regexp_extract(SOURCE_FILE, "^(part)-.*(csv)$", 1))


_CSV_SQL = " union all by name ".join(f"select '{name}' as table_name, {key} as key, * from {name}" for name, key in _CSV_TABLES.items())


QUERIES = [
    Query("store_history", store_history, _HISTORY_SQL),
    Query("store_online", store_online, _ONLINE_SQL),
    Query("store_batch_view", store_batch_view, _WIDE_SQL),
    Query("evaluate_report", evaluate_report, _evaluate_sql()),
    Query("evaluate_export", evaluate_export, f"select name, value from ({_evaluate_sql()}) where kind <> 'figure'"),
    Query("build_gate", build_gate, _GATE_SQL),
    Query("run_log", run_log, _RUN_LOG_SQL),
    Query("model_find", model_find, _FIND_SQL),
    Query("dim_sources_plain", dim_sources_plain, _PLAIN_SQL),
    Query("user_features", user_features, _USER_SQL),
    Query("table_roundtrip", table_roundtrip, _ROUNDTRIP_SQL),
    Query("catalog_counts", catalog_counts, "\nunion all ".join(f"select '{n}' as table_name, count(*) as rows from {n}" for n in _LAYER)),
    Query("view_query", view_query, "select o_custkey, count(*) as n_orders from orders where o_totalprice >= 1000 group by o_custkey"),
    Query("csv_parquet", csv_parquet, _CSV_SQL),
    Query("raw_load", raw_load, f"select *, 'part' as _source_file, timestamp '{RUN_TS}' as _ingestion_timestamp from ({_CSV_SQL})"),
]
