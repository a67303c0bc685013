"""Sources, staging, marts, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import epoch_text, file_name, shorten, table_name
from ..operators import marts, mergeable, quality, splits
from ..operators.staging import union_by_position
from ..sources import files
from ..workdir import cut
from .base import (
    COMBINED_SQL, RUN_TS, SAMPLES_SQL, TAGGED_EMULATOR_SQL, TAGGED_REAL_SQL, Query, combined, samples, split_sql, table,
    tagged_sources,
)

def _two_files(spark, sf_dir):
    customer = files.read_files(spark, sf_dir, "parquet", pattern="customer.parquet")
    supplier = files.read_files(spark, sf_dir, "parquet", pattern="supplier.parquet")
    return customer, supplier


def src_scan(spark, sf_dir):
    return files.read_files(spark, sf_dir, "parquet", pattern="customer.parquet")


def src_table_name(spark, sf_dir):
    customer, supplier = _two_files(spark, sf_dir)
    name = table_name(F.col("_metadata.file_path")).alias("table_name")
    both = customer.select("c_custkey", name).withColumnRenamed("c_custkey", "key").unionByName(
        supplier.select("s_suppkey", name).withColumnRenamed("s_suppkey", "key")
    )
    return both.groupBy("table_name").agg(F.count(F.lit(1)).alias("rows"))


def src_provenance(spark, sf_dir):
    customer, _ = _two_files(spark, sf_dir)
    return files.with_provenance(customer, RUN_TS)


def src_limit(spark, sf_dir):
    return files.first_rows(table(spark, sf_dir, "customer"), 100, ["c_custkey"])


def src_raw_fallback(spark, sf_dir):
    # No JSON lines lie in the folder, so the table's Parquet files are read.
    return files.read_raw(spark, sf_dir, pattern="orders*")


def stg_tagged(spark, sf_dir):
    return tagged_sources(spark, sf_dir)[0]


def stg_combined(spark, sf_dir):
    return combined(spark, sf_dir)


def stg_union_all(spark, sf_dir):
    emu, real = tagged_sources(spark, sf_dir)
    real = real.withColumn("family", F.lit(None).cast("string")).select(*emu.columns)
    return union_by_position([emu, real])


def sample_ids(spark, sf_dir):
    return samples(spark, sf_dir)


def fct_samples(spark, sf_dir):
    return marts.fact_samples(samples(spark, sf_dir), RUN_TS)


_FACT_SQL = f"""
select * replace (cast(sample_id as varchar) as sample_id),
       coalesce(_ingestion_timestamp, timestamp '{RUN_TS}') as event_timestamp, _dbt_loaded_at as feature_timestamp
from ({SAMPLES_SQL})"""


def _split_orders(spark, sf_dir):
    return splits.hash_split(table(spark, sf_dir, "orders"), "o_orderkey")


_SPLIT_ORDERS_SQL = f"select *, {split_sql('o_orderkey')} as dataset_split from orders"


def trn_split(spark, sf_dir):
    return splits.hash_split(fct_samples(spark, sf_dir), "sample_id")


def split_counts(spark, sf_dir):
    return splits.split_counts(_split_orders(spark, sf_dir))


def split_filter(spark, sf_dir):
    return _split_orders(spark, sf_dir).filter(F.col("dataset_split") == "test")


def head_per_split(spark, sf_dir):
    # The split is a projection: the passes that look for the ends scan the key alone, and nothing is copied.
    return splits.head_per_split(_split_orders(spark, sf_dir), 1000, "o_orderkey")


def dim_sources(spark, sf_dir):
    return marts.source_dimension(combined(spark, sf_dir), RUN_TS)


def dim_families(spark, sf_dir):
    rows = combined(spark, sf_dir)
    return marts.family_dimension(rows, RUN_TS, sample="sample_key", year=F.col("nation"))


def dim_families_merged(spark, sf_dir):
    """Families from the states of two parts: the sketches' distinct samples, and beside them the exact ones."""
    rows = combined(spark, sf_dir)
    parts = [rows.where(F.col("sample_key") % 2 == i) for i in range(2)]
    state = mergeable.merge_families(*[cut(mergeable.family_state(p, sample="sample_key", year=F.col("nation")), "families") for p in parts])
    exact = mergeable.distinct_samples(parts[0], sample="sample_key").union(mergeable.distinct_samples(parts[1], sample="sample_key"))
    sketched, counted = mergeable.families_of(state), mergeable.families_of(state, exact)
    return counted.join(sketched.select("family_id", F.col("unique_samples").alias("estimated_samples")), "family_id")


def contract_align(spark, sf_dir):
    return marts.align_contract(combined(spark, sf_dir).withColumnRenamed("nation", "year"))


def split_stratified(spark, sf_dir):
    return splits.stratified_split(
        table(spark, sf_dir, "labels"), "doc_id", "quality", {"train": 0.8, "val": 0.1, "test": 0.1}, 42, "v1_stratified_80_10_10"
    ).drop("event_timestamp")


_STRATIFIED_SQL = """
select cast(doc_id as varchar) as entity_key,
       case when r <= floor(n * 0.8) then 'train' when r <= floor(n * 0.9) then 'val' else 'test' end as split,
       'v1_stratified_80_10_10' as split_version, 42 as split_seed
from (select doc_id, count(*) over (partition by quality) as n,
             row_number() over (partition by quality order by md5('42|' || cast(doc_id as varchar))) as r
      from labels)"""


def split_index_join(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return splits.join_split_index(documents, split_stratified(spark, sf_dir), "doc_id", "v1_stratified_80_10_10")


def text_shorten(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", shorten("text", 50).alias("short_text"), shorten(F.md5("text"), 12).alias("short_id"))


def epoch_format(spark, sf_dir):
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    return table(spark, sf_dir, "events").select("event_id", epoch_text(seconds).alias("time_text"))


_LINE_CHECKS = quality.Checks(
    not_null=["l_orderkey", "l_shipdate"], unique=["l_orderkey"], accepted={"l_returnflag": ["A", "N"], "l_linestatus": ["O", "F"]}
)


def dq_report(spark, sf_dir):
    return quality.report(table(spark, sf_dir, "lineitem"), _LINE_CHECKS)


def dq_duplicates(spark, sf_dir):
    return quality.duplicates(table(spark, sf_dir, "lineitem"), "l_orderkey")


_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark",
    "labels", "conversations",
]


def inventory(spark, sf_dir):
    return files.inventory(spark, sf_dir, "*.parquet").select("table_name", (F.col("length") > 0).alias("has_content"))


def inventory_summary(spark, sf_dir):
    return files.inventory_summary(spark, sf_dir, "*.parquet").select("objects", (F.col("bytes") > 0).alias("has_content"))


def snapshot_files(spark, sf_dir):
    return files.data_files(table(spark, sf_dir, "lineitem")).select(
        file_name("file_path").alias("file_name"), "file_format", "record_count"
    )


QUERIES = [
    Query("src_scan", src_scan, "select * from customer"),
    Query("src_table_name", src_table_name, "select 'customer' as table_name, count(*) as rows from customer union all select 'supplier', count(*) from supplier"),
    Query("src_provenance", src_provenance, f"select *, 'customer.parquet' as _source_file, timestamp '{RUN_TS}' as _ingestion_timestamp from customer"),
    Query("src_limit", src_limit, "select * from customer order by c_custkey limit 100"),
    Query("src_raw_fallback", src_raw_fallback, "select * from orders"),
    Query("stg_tagged", stg_tagged, TAGGED_EMULATOR_SQL),
    Query("stg_combined", stg_combined, COMBINED_SQL),
    Query("stg_union_all", stg_union_all, f"{TAGGED_EMULATOR_SQL} union all {TAGGED_REAL_SQL}"),
    Query("sample_ids", sample_ids, SAMPLES_SQL),
    Query("fct_samples", fct_samples, _FACT_SQL),
    Query("trn_split", trn_split, f"select *, {split_sql('sample_id')} as dataset_split from ({_FACT_SQL})"),
    Query("split_counts", split_counts, f"select dataset_split, count(*) as rows from ({_SPLIT_ORDERS_SQL}) group by 1"),
    Query("split_filter", split_filter, f"select * from ({_SPLIT_ORDERS_SQL}) where dataset_split = 'test'"),
    Query(
        "head_per_split",
        head_per_split,
        f"select * from ({_SPLIT_ORDERS_SQL}) qualify row_number() over (partition by dataset_split order by o_orderkey) <= 1000",
    ),
    Query(
        "dim_sources",
        dim_sources,
        f"""
select data_source as family_id, data_source as family_name, true as is_data_source, count(*) as total_samples, count(*) as unique_samples,
       sum(case when data_source = 'emulator' then 1 else 0 end)::bigint as emulator_count,
       sum(case when data_source = 'real_device' then 1 else 0 end)::bigint as real_device_count,
       cast(year(min(_ingestion_timestamp)) as integer) as earliest_year, cast(year(max(_ingestion_timestamp)) as integer) as latest_year,
       1 as year_span, timestamp '{RUN_TS}' as _dbt_loaded_at
from ({COMBINED_SQL}) group by data_source""",
    ),
    Query(
        "dim_families_merged",
        dim_families_merged,
        f"""
select coalesce(family, 'benign') as family_id, family is not null as is_malware_family, count(*) as total_samples, count(distinct sample_key) as unique_samples,
       count(*) filter (data_source = 'emulator') as emulator_count, count(*) filter (data_source = 'real_device') as real_device_count,
       min(nation) as earliest_year, max(nation) as latest_year, max(nation) - min(nation) as year_span, count(distinct sample_key) as estimated_samples
from ({COMBINED_SQL}) group by family""",
    ),
    Query(
        "dim_families",
        dim_families,
        f"""
select f as family_id, f as family_name, f <> 'benign' as is_malware_family, count(*) as total_samples,
       count(distinct sample_key) as unique_samples,
       sum(case when data_source = 'emulator' then 1 else 0 end)::bigint as emulator_count,
       sum(case when data_source = 'real_device' then 1 else 0 end)::bigint as real_device_count,
       min(nation) as earliest_year, max(nation) as latest_year, max(nation) - min(nation) as year_span,
       timestamp '{RUN_TS}' as _dbt_loaded_at
from (select *, coalesce(family, 'benign') as f from ({COMBINED_SQL})) group by f""",
    ),
    Query(
        "contract_align",
        contract_align,
        f"""
select sample_key, name, cast(nation as bigint) as first_seen_year, balance, family as malware_family, _ingestion_timestamp, data_source,
       _dbt_loaded_at
from ({COMBINED_SQL})""",
    ),
    Query("split_stratified", split_stratified, _STRATIFIED_SQL),
    Query(
        "split_index_join",
        split_index_join,
        f"select doc_id, lang, source, n_chars, split from documents join ({_STRATIFIED_SQL}) on cast(doc_id as varchar) = entity_key",
    ),
    Query(
        "text_shorten",
        text_shorten,
        """
select doc_id, case when length(text) > 50 then substr(text, 1, 50) || '...' else text end as short_text,
       substr(md5(text), 1, 12) || '...' as short_id
from documents""",
    ),
    Query("epoch_format", epoch_format, "select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as time_text from events"),
    Query(
        "dq_report",
        dq_report,
        """
select 'not_null' as "check", 'l_orderkey' as column_name, count(*) filter (l_orderkey is null) as failures from lineitem union all
select 'not_null', 'l_shipdate', count(*) filter (l_shipdate is null) from lineitem union all
select 'accepted_values', 'l_returnflag', count(*) filter (l_returnflag not in ('A', 'N')) from lineitem union all
select 'accepted_values', 'l_linestatus', count(*) filter (l_linestatus not in ('O', 'F')) from lineitem union all
select 'unique', 'l_orderkey', count(*) from (select l_orderkey from lineitem group by 1 having count(*) > 1)""",
    ),
    Query("dq_duplicates", dq_duplicates, "select l_orderkey, count(*) as occurrences from lineitem group by 1 having count(*) > 1"),
    Query("inventory", inventory, f"select unnest({_TABLES}) as table_name, true as has_content"),
    Query("inventory_summary", inventory_summary, f"select cast(len({_TABLES}) as bigint) as objects, true as has_content"),
    Query("snapshot_files", snapshot_files, "select 'lineitem.parquet' as file_name, 'PARQUET' as file_format, count(*) as record_count from lineitem"),
]
