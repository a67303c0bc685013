"""Sources, staging, marts, quality, sinks, and the whole transform."""

import gzip
import json
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from featmart.functions.hashing import row_digest, schema_hash
from featmart.operators import marts, quality
from featmart.operators.diff import bag_diff, is_changed, version_diff
from featmart.operators.splits import SPLITS
from featmart.operators.staging import tag_source, union_by_name, union_by_position
from featmart.plans import catalog
from featmart.plans.transform import DIM_FAMILIES, FCT_SAMPLES, FCT_TRAINING, STG_COMBINED, TransformConfig, run_transform, stage
from featmart.plans.versions import VersionLog
from featmart.session import substitute
from featmart.sinks import tables
from featmart.sources import files
from featmart.workdir import work_dir

RUN_TS = datetime(2024, 3, 1, 12)


def data(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def raw_dir(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "Real-Device 2021.csv").write_text("k,v\n1,a\n2,b\n")
    (tmp_path / "sub" / "emu.csv").write_text("k,w\n3,1.5\n")
    spark.range(2).coalesce(1).write.parquet(str(tmp_path / "p"))
    parquet = next((tmp_path / "p").glob("*.parquet"))
    (tmp_path / "Numbers.parquet").write_bytes(parquet.read_bytes())
    return tmp_path


def test_tables_by_file(spark, raw_dir):
    found = files.tables_by_file(spark, str(raw_dir), formats=("csv",))
    assert list(found) == ["real_device_2021", "emu"]
    assert data(found["emu"]) == [(3, 1.5)]
    row = files.with_provenance(found["real_device_2021"], RUN_TS).first()
    assert (row["_source_file"], row["_ingestion_timestamp"]) == ("Real-Device%202021.csv", RUN_TS) or row["_source_file"] == "Real-Device 2021.csv"
    (raw_dir / "sub" / "real_device-2021.csv").write_text("k\n1\n")
    with pytest.raises(ValueError):
        files.tables_by_file(spark, str(raw_dir), formats=("csv",))


def test_load_and_convert(spark, raw_dir, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a b.csv").write_text("k\n1\n2\n")
    for _ in range(2):
        assert tables.load_raw(spark, str(tmp_path / "in"), str(tmp_path / "raw"), RUN_TS) == {"a_b": 2}
    assert spark.read.parquet(str(tmp_path / "raw/a_b")).columns == ["k", "_source_file", "_ingestion_timestamp"]
    assert tables.csv_to_parquet(spark, str(tmp_path / "in"), str(tmp_path / "out")) == {"a_b": 2}
    assert data(spark.read.parquet(str(tmp_path / "out/a_b"))) == [(1,), (2,)]


def test_raw_prefers_json_lines(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert files.read_raw(spark, str(tmp_path / "t")).count() == 3
    with gzip.open(tmp_path / "t" / "x.jsonl.gz", "wt") as f:
        f.write(json.dumps({"id": 7}) + "\n")
    assert data(files.read_raw(spark, str(tmp_path / "t"))) == [(7,)]
    with pytest.raises(AnalysisException):
        files.read_raw(spark, str(tmp_path / "absent"))


def test_limit_is_repeatable(spark):
    df = spark.range(100).repartition(7)
    assert data(files.first_rows(df, 3, ["id"])) == [(0,), (1,), (2,)]
    assert files.first_rows(df, 0, ["id"]) is df


def test_inventory(spark, raw_dir):
    rows = {r["table_name"]: r["length"] for r in files.inventory(spark, str(raw_dir), "*.csv").collect()}
    assert rows == {"real_device_2021": 12, "emu": 10}
    assert files.inventory(spark, str(raw_dir), "*.csv", max_objects=1).count() == 1
    assert sum(r["objects"] for r in files.inventory_summary(spark, str(raw_dir), "*.csv").collect()) == 2


def test_unions(spark):
    a = spark.createDataFrame([(1, "x")], "k long, f string")
    b = spark.createDataFrame([(2,)], "k long")
    assert data(union_by_name([a, b, a])) == [(1, "x"), (1, "x"), (2, None)]
    assert data(union_by_position([a, a.select(F.col("k").alias("z"), "f")])) == [(1, "x"), (1, "x")]
    with pytest.raises(AnalysisException):
        union_by_position([a, b])


def test_facts_without_ingestion_time(spark):
    staged = tag_source(spark.range(1), "emulator", "2024-01-05 00:00:00").withColumn("sample_id", F.lit(9))
    row = marts.fact_samples(staged, RUN_TS).first().asDict()
    assert row == {
        "sample_id": "9", "id": 0, "data_source": "emulator", "_dbt_loaded_at": datetime(2024, 1, 5), "event_timestamp": RUN_TS,
        "feature_timestamp": datetime(2024, 1, 5),
    }
    assert list(row)[0] == "sample_id"
    dim = marts.source_dimension(staged, RUN_TS).first()
    assert (dim["earliest_year"], dim["latest_year"], dim["emulator_count"], dim["real_device_count"]) == (2024, 2024, 1, 0)


def test_event_time_falls_back(spark):
    staged = tag_source(spark.range(2), "emulator", RUN_TS).withColumn("sample_id", F.col("id"))
    staged = staged.withColumn("_ingestion_timestamp", F.when(F.col("id") == 0, files.timestamp_literal("2020-01-01 00:00:00")))
    assert [r["event_timestamp"] for r in marts.fact_samples(staged, RUN_TS).orderBy("id").collect()] == [datetime(2020, 1, 1), RUN_TS]


def test_family_dimension(spark):
    rows = [("a", "s1", 2019, "emulator"), ("a", "s1", 2021, "real_device"), ("a", "s2", 2020, "emulator"), (None, "s3", 2018, "emulator"), (" ", "s4", 2018, "emulator")]
    df = spark.createDataFrame(rows, "family string, sha256 string, year int, data_source string")
    got = {r["family_id"]: r for r in marts.family_dimension(df, RUN_TS).collect()}
    a, benign = got["a"], got["benign"]
    assert (a["total_samples"], a["unique_samples"], a["emulator_count"], a["real_device_count"], a["year_span"]) == (3, 2, 2, 1, 2)
    assert a["is_malware_family"] and not benign["is_malware_family"] and benign["total_samples"] == 2


def test_contract(spark):
    df = spark.createDataFrame([("f", 2020, 1)], "family string, year int, label int")
    assert marts.align_contract(df).dtypes == [("malware_family", "string"), ("first_seen_year", "bigint"), ("label", "int")]


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 9), ("c", 1)], "k string, v int")
    checks = quality.Checks(not_null=["k", "v"], unique=["k", "v"], accepted={"v": [1, 2, 3], "k": ["a"]})
    got = {(r["check"], r["column_name"]): r["failures"] for r in quality.report(df, checks).collect()}
    assert got == {
        ("not_null", "k"): 2, ("not_null", "v"): 0, ("unique", "k"): 1, ("unique", "v"): 1, ("accepted_values", "v"): 1,
        ("accepted_values", "k"): 1,
    }
    assert data(quality.duplicates(df, "k")) == [("a", 2)]
    with pytest.raises(quality.QualityError, match="absent"):
        quality.report(df, quality.Checks(not_null=["zzz"]))
    with pytest.raises(quality.QualityError, match="unique"):
        quality.require(df, checks)
    quality.require(df, quality.Checks(not_null=["v"]))


def test_version_diff(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, None, "y"), (4, "d", "z")], "d long, p string, q string")
    new = spark.createDataFrame([(1, "a", None), (2, "b2", "x"), (3, "y", None), (5, "e", "z")], "d long, p string, q string")
    assert data(version_diff(old, new, ["d"])) == [(2, "changed"), (3, "changed"), (4, "removed"), (5, "added")]
    assert not is_changed(old, old.repartition(3).select("q", "p", "d"), ["d"])
    assert data(version_diff(old, old.withColumn("r", F.lit(1)), ["d"])) == [(i, "changed") for i in (1, 2, 3, 4)]
    assert version_diff(old, old.withColumn("d", F.col("d").cast("int")), ["d"]).count() == 0
    with pytest.raises(Exception, match="twice"):
        version_diff(old.union(old), new, ["d"]).collect()
    assert is_changed(old, old.withColumn("r", F.lit(None).cast("int")), ["d"])
    real = old.select("d", F.lit(1.5).alias("x"))
    assert version_diff(real, real.withColumn("x", F.col("x").cast("int")), ["d"]).count() == old.count()
    assert version_diff(real, real.withColumn("x", F.col("x").cast("string")), ["d"]).count() == 0
    nested = spark.createDataFrame([(1, [None, 1], {"a": 1})], "k long, a array<int>, m map<string,int>")
    assert version_diff(nested, nested.withColumn("a", F.array(F.lit(1), F.lit(None))), ["k"]).count() == 1


def test_bag_diff(spark):
    old = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    new = spark.createDataFrame([(1,), (3,), (3,), (2,)], "k long")
    assert data(bag_diff(old, new)) == [(1, -1), (3, 2)]


def test_hashes(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    one, two = [r[0] for r in df.select(row_digest(df)).collect()]
    assert one != two
    assert schema_hash(df.schema) == schema_hash(df.select("y", "x").schema) != schema_hash(df.select("x").schema)


def test_write_table(spark):
    tables.ensure_databases(spark, ["db_a", "db_a"])
    assert tables.write_table(spark.range(10), "db_a.t") == 10
    assert tables.write_table(spark.range(5), "db_a.t") == 5
    assert tables.write_table(spark.range(5), "db_a.t", mode="append") == 5
    split = spark.range(20).withColumn("part", F.col("id") % 2)
    assert tables.write_table(split, "db_a.split", partition_by=["part"]) == 20
    assert {r["tableName"] for r in catalog.tables(spark, "db_a").collect()} == {"t", "split"}
    assert dict(catalog.table_counts(spark, "db_a")) == {"t": 10, "split": 20}
    assert "db_a" in {r["namespace"] for r in catalog.namespaces(spark).collect()}
    seen = catalog.explore(spark, "db_a.split", rows=3)
    assert seen["rows"] == 20 and seen["sample"].count() == 3 and seen["statistics"].count() == 2
    assert files.read_table(spark, "db_a.t", 2, ["id"]).count() == 2
    assert files.run_query(spark, "select count(*) from db_a.t where id < :n", n=2).first()[0] == 4
    tables.publish_layer({"v": spark.range(3)}, as_views=True)
    assert spark.table("v").count() == 3
    tables.publish_layer({"w": spark.range(3)}, as_views=False, database="db_a")
    assert spark.table("db_a.w").count() == 3


def test_overwrite_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_parquet(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, partition_by=["p"])
    assert tables.overwrite_partitions(spark.createDataFrame([(3, "b")], "v int, p string"), path, ["p"]) == 1
    assert data(spark.read.parquet(path)) == [(1, "a"), (3, "b")]


def test_data_files(spark, tmp_path):
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "t"))
    rows = files.data_files(spark.read.parquet(str(tmp_path / "t"))).collect()
    assert len(rows) == 3 and sum(r["record_count"] for r in rows) == 100
    assert {r["file_format"] for r in rows} == {"PARQUET"} and all(r["file_size_in_bytes"] > 0 for r in rows)


def raw_tables(spark, base, years=(2020, 2021)):
    emu = spark.range(60).select(
        F.col("id").alias("key"), F.lit("fam").alias("family"), files.timestamp_literal("2024-01-01 00:00:00").alias("_ingestion_timestamp")
    )
    real = spark.range(40).select(F.col("id").alias("key"), files.timestamp_literal("2024-01-02 00:00:00").alias("_ingestion_timestamp"))
    emu.repartition(3).write.parquet(f"{base}/emu")
    real.repartition(2).write.parquet(f"{base}/real")


def test_transform(spark, tmp_path):
    raw_tables(spark, tmp_path)
    log = VersionLog(spark, str(tmp_path / "versions"))
    config = TransformConfig(str(tmp_path), {"emulator": "emu", "real_device": "real"}, "run-1", RUN_TS)
    commit = run_transform(spark, log, config)
    assert commit.version == 0 and set(commit.tables) == {STG_COMBINED, FCT_SAMPLES, DIM_FAMILIES, FCT_TRAINING}
    staged, facts, training = (log.read(t) for t in (STG_COMBINED, FCT_SAMPLES, FCT_TRAINING))
    assert sorted(r["sample_id"] for r in staged.collect()) == list(range(1, 101))
    # All tables agree on the numbers, because each is made from the one written before.
    numbers = {(r["data_source"], r["key"]): str(r["sample_id"]) for r in staged.collect()}
    for df in (facts, training):
        assert {(r["data_source"], r["key"]): r["sample_id"] for r in df.collect()} == numbers
    assert {r["dataset_split"] for r in training.collect()} <= set(SPLITS)
    assert training.columns.count("dataset_split") == 1
    dim = {r["family_id"]: r["total_samples"] for r in log.read(DIM_FAMILIES).collect()}
    assert dim == {"emulator": 60, "real_device": 40}
    # Another run over the same files numbers them alike.
    run_transform(spark, log, TransformConfig(str(tmp_path), {"emulator": "emu", "real_device": "real"}, "run-2", RUN_TS))
    assert data(log.read(STG_COMBINED)) == data(staged)
    limited = TransformConfig(str(tmp_path), {"emulator": "emu", "real_device": "real"}, "run-3", RUN_TS, limit=10, limit_order=["key"])
    run_transform(spark, log, limited)
    assert log.read(FCT_TRAINING).count() == 20


def test_source_checks(spark, tmp_path):
    """A source that fails its checks stops the run before anything is written."""
    raw_tables(spark, tmp_path)
    log = VersionLog(spark, str(tmp_path / "versions"))
    names = {"emulator": "emu", "real_device": "real"}
    good = quality.Checks(not_null=["key"], unique=["key"], accepted={"family": ["fam"]})
    with pytest.raises(quality.QualityError, match="emulator: accepted_values"):
        bad = quality.Checks(accepted={"family": ["other"]})
        run_transform(spark, log, TransformConfig(str(tmp_path), names, "run-1", RUN_TS, source_checks={"emulator": bad}))
    with pytest.raises(ValueError, match="unknown sources"):
        run_transform(spark, log, TransformConfig(str(tmp_path), names, "run-2", RUN_TS, source_checks={"phone": good}))
    assert run_transform(spark, log, TransformConfig(str(tmp_path), names, "run-3", RUN_TS, source_checks={"emulator": good})).version == 0


def test_stage(spark):
    df = stage({"emulator": spark.range(2), "real_device": spark.range(1)}, RUN_TS)
    assert data(df.groupBy("data_source").count()) == [("emulator", 2), ("real_device", 1)]


def test_settings(spark):
    assert substitute("a-${X}-${Y}", {"X": "1"}) == "a-1-"
    assert work_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_parts_of_a_folder_are_one_table(spark, tmp_path):
    """Parts with other columns are one table with the columns of all; two folders of one name are an error."""
    (tmp_path / "in" / "orders").mkdir(parents=True)
    spark.createDataFrame([(1, "a")], "k long, v string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / "Lines"))
    spark.createDataFrame([(2, 2.5)], "k long, w double").coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / "Lines"))
    for i in range(3):
        (tmp_path / "in" / "orders" / f"part-{i}.csv").write_text(f"k,v\n{i},x{i}\n")
    assert tables.load_raw(spark, str(tmp_path / "in"), str(tmp_path / "raw"), RUN_TS) == {"lines": 2, "orders": 3}
    lines = spark.read.parquet(str(tmp_path / "raw/lines"))
    assert {(r["k"], r["v"], r["w"]) for r in lines.collect()} == {(1, "a", None), (2, None, 2.5)}
    assert data(spark.read.parquet(str(tmp_path / "raw/orders")).select("k", "v")) == [(0, "x0"), (1, "x1"), (2, "x2")]
    (tmp_path / "in" / "more" / "orders").mkdir(parents=True)
    (tmp_path / "in" / "more" / "orders" / "part-0.csv").write_text("k\n1\n")
    with pytest.raises(ValueError, match="orders"):
        files.tables_by_file(spark, str(tmp_path / "in"), formats=("csv",))
