from datetime import datetime

import pytest
from pyspark.sql import functions as F

from featmart.operators.quality import Checks, QualityError
from featmart.plans import lineage, versions
from featmart.plans.versions import ConflictError, VersionLog

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)


@pytest.fixture
def log(spark, tmp_path):
    return VersionLog(spark, str(tmp_path / "log"))


def test_commits_and_time_travel(spark, log):
    assert log.head() is None and log.commits().count() == 0 and log.resolve("main") == "unknown"
    first = log.commit_table("main", "t", spark.range(3), ["id"], "one", T1, "r1")
    assert log.commit_table("main", "t", spark.range(3), ["id"], "same", T2, "r2") is None
    second = log.commit_table("main", "t", spark.range(5), ["id"], "two", T3, "r3", metadata={"k": "v"})
    assert (first.version, second.version) == (0, 1)
    assert [log.read("t", ref).count() for ref in ("main", first.commit_id, second.commit_id)] == [5, 3, 5]
    assert log.read_version("t", 0).count() == 3 and log.read_at("t", T2).count() == 3 and log.read_at("t", T3).count() == 5
    rows = {r["version"]: r for r in log.commits().collect()}
    assert rows[1]["parent"] == first.commit_id and rows[1]["metadata"] == {"k": "v"} and rows[0]["committed_at"] == T1
    assert sum(r["record_count"] for r in log.files("t").collect()) == 5
    for bad in (lambda: log.read("x"), lambda: log.read("t", "zz"), lambda: log.read_version("t", 9), lambda: log.read_at("t", datetime(2020, 1, 1))):
        with pytest.raises(ValueError):
            bad()


def test_runs_are_isolated_and_second_publish_is_refused(spark, log):
    log.commit_table("main", "t", spark.range(3), ["id"], "one", T1, "r0")
    a, b = log.begin("run-a"), log.begin("run-b")
    a.write("t", spark.range(10))
    b.write("u", spark.range(20))
    assert log.read("t").count() == 3
    done = a.publish("a", T2)
    assert log.read("t").count() == 10 and done.version == 1
    with pytest.raises(ConflictError):
        b.publish("b", T2)
    assert "u" not in log.head().tables
    again = log.begin("run-c")
    again.write("u", spark.range(2))
    assert set(again.publish("c", T3).tables) == {"t", "u"}
    assert log.begin("run-d").publish("nothing", T3) is None
    row = log.commits().filter("version = 1").first()
    assert row["operation"] == "merge" and row["metadata"]["run_id"] == "run-a"


def test_version_number_is_taken_once(spark, log):
    log.commit("main", {"t": "x"}, "one", T1)
    with pytest.raises(ConflictError):
        log._append(None, "main", {"t": "y"}, "late", T2)


def test_bad_rows_stop_the_publish(spark, log):
    run = log.begin("run")
    with pytest.raises(QualityError):
        run.write("t", spark.createDataFrame([(1,), (1,)], "k int"), Checks(unique=["k"]))
    assert run.publish("x", T1) is None and log.head() is None


def test_tags(spark, log):
    first = log.commit("main", {"t": "x"}, "one", T1)
    second = log.commit("main", {"t": "y"}, "two", T2)
    assert log.tag_model_data("m", 3, first.commit_id) == "model-m-v3-data"
    assert log.tag_model_data("m", 3, first.commit_id) == "model-m-v3-data"
    assert log.tag_model_data("m", 3, second.commit_id) is None
    assert log.tag_model_data("m", 4, "unknown") is None
    assert log.resolve("model-m-v3-data") == first.commit_id and log.resolve("main") == second.commit_id
    assert log.resolve(first.commit_id) == first.commit_id and log.resolve("zz") == "unknown"
    assert log.tags().count() == 1


def test_ledger_tables(spark):
    tags = spark.createDataFrame([("a", "1")], "tag string, commit_id string")
    new = spark.createDataFrame([("a", "9"), ("b", "2"), ("b", "2"), ("c", "unknown"), ("d", None), ("e", "")], "tag string, commit_id string")
    assert sorted(tuple(r) for r in versions.add_tags(tags, new).collect()) == [("a", "1"), ("b", "2")]
    trained = spark.createDataFrame([("x", 1), ("y", 1), ("z", 1)], "m string, version long")
    now = spark.createDataFrame([("x", 1), ("y", 2)], "m string, version long")
    assert {r["m"]: r["drifted"] for r in versions.version_drift(trained, now, ["m"]).collect()} == {"x": False, "y": True, "z": True}
    assert versions.latest_snapshot(spark.createDataFrame([], "branch string, version int, committed_at timestamp")).count() == 0


def test_lineage(spark, tmp_path):
    log = lineage.RunLog(spark, str(tmp_path / "runs"))
    assert log.entries().count() == 0 and log.models().count() == 0
    df = spark.createDataFrame([(1, 2.0)], "a int, b double")
    log.log_dataset("r1", df, {"train": 7, "test": 3}, ["a", "b"], "c1", T1)
    log.log_params("r1", {"model/latent_dim": 16}, T1)
    log.log_params("r1", {"model/latent_dim": 8}, T2)
    log.log_metrics("r1", {"test_loss": 0.5}, T1)
    log.set_tags("r1", {"team": "x"}, T1)
    log.log_metrics("r2", {}, T1)
    params = log.params("r1")
    assert params["data/commit"] == "c1" and params["data/train_samples"] == "7" and params["model/latent_dim"] == "8"
    assert params["data/feature_names"] == '["a", "b"]' and len(params["data/feature_schema_hash"]) == 64
    row = lineage.run_table(log.entries(), {"test_loss": "loss", "model/latent_dim": "dim", "zz": "missing"}).first()
    assert (row["run_id"], row["loss"], row["dim"], row["missing"]) == ("r1", "0.5", "8", None)
    assert [log.register_model("m", "r1"), log.register_model("m", "r2", "Production"), log.register_model("n", "r3")] == [1, 2, 1]
    assert log.run_of_model("m", "1") == "r1" and log.run_of_model("m", "production") == "r2"
    with pytest.raises(ValueError):
        log.run_of_model("m", "9")
    with pytest.raises(ValueError):
        log.run_of_model("m", "staging")


def test_latest_version_is_numeric(spark):
    df = spark.createDataFrame([("m", "9"), ("m", "10"), ("m", "x"), ("n", "x")], "model string, version string")
    assert [tuple(r) for r in lineage.latest_versions(df).collect()] == [("m", 10)]
    stages = df.withColumns({"stage": F.lit("Staging"), "run_id": F.col("version")})
    assert lineage.find_model(stages, "m", "staging").first()["version"] == "10"


def test_runs_without_the_keys_stay(spark):
    entries = spark.createDataFrame([("a", "x", 1.0, 1), ("b", "y", 2.0, 1)], "run_id string, key string, value double, logged_at int")
    assert {tuple(r) for r in lineage.run_table(entries, {"x": "x_value"}).collect()} == {("a", 1.0), ("b", None)}
