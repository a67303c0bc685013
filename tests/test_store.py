"""Registry, feature store, online table, streams."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featmart.operators.features import with_on_demand_scores
from featmart.store.definitions import SCORE_FIELDS, sample_registry
from featmart.store.feature_store import FeatureStore, backfill, write_daily
from featmart.store.online import OnlineTable
from featmart.store.registry import Entity, FeatureView, OnDemandView, Registry, RegistryError
from featmart.streaming import streams
from tests.plans import collect_and_count, static_plans

T0 = datetime(2024, 1, 1)
HOUR = timedelta(hours=1)
USER = Entity("user", ("user_id",))
VIEW = FeatureView("spend", ("user",), (("amount", T.DoubleType()), ("n", T.LongType())), "ts", "spend_table", ttl="2 hours", tie=("seq",), online=True)
OTHER = FeatureView("visits", ("user",), (("n", T.LongType()),), "ts", "visit_table")


@pytest.fixture
def store(spark, tmp_path):
    spend = spark.createDataFrame(
        [("a", T0, 1, 1.0, 1), ("a", T0 + HOUR, 1, 2.0, 2), ("a", T0 + HOUR, 2, 3.0, 3), ("b", T0 + 5 * HOUR, 1, 9.0, 9)],
        "user_id string, ts timestamp_ntz, seq int, amount double, n long",
    )
    visits = spark.createDataFrame([("a", T0, 70), ("b", T0, 80)], "user_id string, ts timestamp_ntz, n long")
    return FeatureStore(spark, Registry([USER], [VIEW, OTHER]), str(tmp_path / "store"), {"spend_table": spend, "visit_table": visits}, buckets=4)


def test_registry_names():
    registry = sample_registry()
    assert registry.list_views() == ["malware_batch_features", "malware_family_features", "malware_sample_features"]
    assert registry.list_entities() == ["device", "family_statistics", "malware_family", "malware_sample", "user"]
    view = registry.view("malware_sample_features")
    assert registry.join_keys(view) == ["sample_id"] and len(view.fields) == 33 and view.ttl == "365 days"
    assert registry.resolve(["malware_sample_features:read", "malware_batch_features:*"]) == {
        "malware_sample_features": ["read"],
        "malware_batch_features": ["malware", "nr_syscalls", "nr_permissions", "detection_ratio"],
    }
    for bad in ("malware_sample_features:syscall_total", "nothing:read", "read"):
        with pytest.raises(RegistryError):
            registry.resolve([bad])
    with pytest.raises(RegistryError):
        Registry([], [VIEW])


def test_sources_are_checked(spark):
    registry = Registry([USER], [VIEW])
    good = "user_id string, ts timestamp, seq int, amount double, n long"
    registry.check_source(VIEW, spark.createDataFrame([], good))
    for bad in (good.replace("seq int", "x int"), good.replace("ts timestamp", "ts string"), good.replace("amount double", "amount string")):
        with pytest.raises(RegistryError):
            registry.check_source(VIEW, spark.createDataFrame([], bad))


def test_historical_features(spark, store):
    entities = spark.createDataFrame([("a", T0 + HOUR), ("a", T0 + 3 * HOUR), ("a", T0 + 4 * HOUR), ("b", T0), ("c", T0)], "user_id string, event_timestamp timestamp_ntz")
    rows = store.get_historical_features(entities, ["spend:amount", "spend:n"]).collect()
    got = {(r["user_id"], r["event_timestamp"]): (r["amount"], r["n"]) for r in rows}
    assert got == {
        ("a", T0 + HOUR): (3.0, 3), ("a", T0 + 3 * HOUR): (3.0, 3), ("a", T0 + 4 * HOUR): (None, None), ("b", T0): (None, None), ("c", T0): (None, None),
    }
    with pytest.raises(ValueError, match="full_names"):
        store.get_historical_features(entities, ["spend:n", "visits:n"])
    both = store.get_historical_features(entities, ["spend:n", "visits:n"], full_names=True)
    assert {(r["user_id"], r["spend__n"], r["visits__n"]) for r in both.collect()} == {("a", 3, 70), ("a", None, 70), ("b", None, 80), ("c", None, None)}


def test_materialize_and_lookup(spark, store):
    assert store.materialize("spend", T0, T0 + HOUR) == 1
    assert store.online("spend").last_end() == "2024-01-01 01:00:00.000000"
    keys = [{"user_id": "a"}, {"user_id": "zz"}]
    got = {r["user_id"]: r["amount"] for r in store.get_online_features(["spend:amount"], keys).collect()}
    assert got == {"a": 1.0, "zz": None}
    assert store.materialize_incremental("spend", T0 + 10 * HOUR) == 2
    assert store.materialize_incremental("spend", T0 + 10 * HOUR) == 0
    frame = spark.createDataFrame([("a",), ("b",), ("b",)], "user_id string")
    assert sorted((r["user_id"], r["amount"]) for r in store.get_online_features(["spend:*"], frame).collect()) == [("a", 3.0), ("b", 9.0), ("b", 9.0)]
    with pytest.raises(ValueError):
        store.materialize_incremental("visits", T0)
    assert store.materialize_recent("visits", T0 + HOUR) == 2
    both = store.get_online_features(["spend:amount", "visits:n"], keys[:1]).first()
    assert (both["amount"], both["n"]) == (3.0, 70)


def test_end_is_exclusive_and_start_inclusive(store):
    assert store.materialize("spend", T0 + HOUR, T0 + 5 * HOUR) == 1
    assert [(r["user_id"], r["amount"]) for r in store.online("spend").read().collect()] == [("a", 3.0)]


def test_push(spark, store):
    schema = "user_id string, ts timestamp_ntz, seq int, amount double, n long"
    store.push("spend", spark.createDataFrame([("a", T0 + 9 * HOUR, 1, 5.0, 5), ("a", T0, 1, 4.0, 4)], schema))
    second = spark.createDataFrame([("a", T0, 1, 6.0, 6), ("b", T0, 1, 7.0, 7)], schema)
    online = store.online("spend")

    def now():
        return {r["user_id"]: r["amount"] for r in online.read().collect()}

    for _ in range(2):
        # A repeated push changes nothing.
        assert store.push("spend", second) == 2
        assert now() == {"a": 5.0, "b": 7.0}
    # Of one time and tie the row that comes last stays.
    store.push("spend", spark.createDataFrame([("b", T0, 1, 8.0, 8), ("c", T0, 1, 2.0, 2)], schema))
    assert now() == {"a": 5.0, "b": 8.0, "c": 2.0}
    assert store.push("spend", second.limit(0)) == 0 and now() == {"a": 5.0, "b": 8.0, "c": 2.0}
    with pytest.raises(RegistryError):
        store.push("spend", spark.range(1))


def test_views_and_on_demand(spark, store):
    assert store.get_batch_view("spend").columns == ["user_id", "ts", "seq", "amount", "n"]
    df = spark.createDataFrame([(2000,)], "read long")
    assert store.with_on_demand(df).first()["is_high_syscall_activity"] == 1
    assert store.with_on_demand(df, with_on_demand_scores).columns == with_on_demand_scores(df).columns
    with pytest.raises(ValueError):
        OnlineTable(spark, store.path + "/none", ["k"], "t").read()


def test_upserts_touch_their_buckets_only(spark, tmp_path):
    online = OnlineTable(spark, str(tmp_path / "online"), ["k"], "t", buckets=16)
    online.upsert(spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("t")))
    before = set(spark.read.parquet(f"{online.path}/data").inputFiles())
    OnlineTable(spark, online.path, ["k"], "t", buckets=16).upsert(spark.createDataFrame([(7, 2)], "k long, t int"))
    after = set(spark.read.parquet(f"{online.path}/data").inputFiles())
    assert len({f.split("/")[-2] for f in before ^ after}) == 1
    assert online.read().filter("t = 2").first()["k"] == 7 and online.read().count() == 100


def test_lookups_read_the_pages_of_their_keys(spark, tmp_path):
    """Ten keys of 200,000: sorted pages and Bloom filters leave a sliver of the rows to read."""
    online = OnlineTable(spark, str(tmp_path / "online"), ["user", "part"], "t", buckets=4)
    pad = F.concat(*[F.md5(F.concat(F.col("id"), F.lit(i))) for i in range(4)]).alias("pad")
    online.upsert(spark.range(200_000).select((F.col("id") * 2).alias("user"), (F.col("id") % 3).cast("string").alias("part"), F.lit(1).alias("t"), pad))
    keys = [{"user": 2 * i, "part": str(i % 3)} for i in range(0, 200_000, 22_222)] + [{"user": 1, "part": "0"}, {"user": 4, "part": "0"}]
    with static_plans(spark):
        rows, scanned = collect_and_count(online.lookup(keys, ["pad"]))
    assert len(rows) == 12 and sum(r["pad"] is None for r in rows) == 2
    assert len(keys) - 2 <= scanned <= 20_000


def test_online_retrieval_of_one_name_in_two_views(spark, store):
    store.materialize("spend", T0, T0 + 9 * HOUR)
    store.materialize("visits", T0, T0 + 9 * HOUR)
    for keys in ([{"user_id": "a"}], spark.createDataFrame([("a",)], "user_id string")):
        with pytest.raises(ValueError, match="full_names"):
            store.get_online_features(["spend:n", "visits:n"], keys)
        both = store.get_online_features(["spend:n", "visits:n"], keys, full_names=True)
        assert both.columns == ["user_id", "spend__n", "visits__n"] and [tuple(r) for r in both.collect()] == [("a", 3, 70)]


def test_fields_have_their_registered_types(spark, tmp_path):
    """A field of type long stays one where the table has int."""
    source = spark.createDataFrame([("a", T0, 1, 2.5, 3)], "user_id string, ts timestamp_ntz, seq int, amount float, n int")
    store = FeatureStore(spark, Registry([USER], [VIEW]), str(tmp_path / "store"), {"spend_table": source}, buckets=2)
    entities = spark.createDataFrame([("a", T0)], "user_id string, event_timestamp timestamp_ntz")
    store.materialize("spend", T0, T0 + HOUR)
    for frame in (store.get_batch_view("spend"), store.get_historical_features(entities, ["spend:*"]), store.get_online_features(["spend:*"], [{"user_id": "a"}])):
        kinds = dict(frame.dtypes)
        assert (kinds["amount"], kinds["n"]) == ("double", "bigint") and (frame.first()["amount"], frame.first()["n"]) == (2.5, 3)


def test_ends_with_an_offset_are_utc(store):
    assert store.materialize("spend", "2024-01-01T01:00:00+01:00", "2024-01-01T02:30:00+02:00") == 1
    assert store.online("spend").last_end() == "2024-01-01 00:30:00.000000"
    assert store.materialize_incremental("spend", "2024-01-01T03:01:00+02:00") == 1


def test_incremental_ends_are_compared_as_times(store):
    assert store.materialize("spend", "2023-12-31", "2024-01-01T00:30:00") == 1
    assert store.online("spend").last_end() == "2024-01-01 00:30:00.000000"
    assert store.materialize_incremental("spend", "2024-01-01 20:00:00") == 2
    assert store.materialize_incremental("spend", "2024-01-01T19:00:00") == 0


def test_backfill_replaces_only_its_days(spark, tmp_path):
    events = spark.range(96).select((F.timestamp_add("HOUR", F.col("id"), F.lit("2024-01-01").cast("timestamp_ntz"))).alias("ts"))

    def daily(factor):
        return lambda d: d.groupBy(F.col("ts").cast("date").alias("day")).agg((F.count(F.lit(1)) * factor).alias("n"))

    path = str(tmp_path / "daily")
    write_daily(events, daily(1), path)
    backfill(events, daily(10), path, "ts", "2024-01-02", "2024-01-04")
    assert [r["n"] for r in spark.read.parquet(path).orderBy("day").collect()] == [24, 240, 240, 24]


def test_backfill_of_a_part_of_a_day_and_of_emptied_days(spark, tmp_path):
    """From noon to noon both days are recomputed whole; a day whose rows are gone at the source loses its partition."""
    events = spark.range(96).select((F.timestamp_add("HOUR", F.col("id"), F.lit("2024-01-01").cast("timestamp_ntz"))).alias("ts"))

    def daily(d):
        return d.groupBy(F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))

    def table():
        return {str(r["day"]): r["n"] for r in spark.read.parquet(path).collect()}

    path = str(tmp_path / "daily")
    write_daily(events, daily, path)
    backfill(events, daily, path, "ts", "2024-01-02 12:00:00", "2024-01-03 12:00:00")
    assert table() == {"2024-01-01": 24, "2024-01-02": 24, "2024-01-03": 24, "2024-01-04": 24}
    left = events.filter("ts < '2024-01-02' or ts >= '2024-01-03 20:00:00'")
    assert backfill(left, daily, path, "ts", "2024-01-02 12:00:00", "2024-01-03 00:00:01") == 1
    assert table() == {"2024-01-01": 24, "2024-01-03": 4, "2024-01-04": 24}
    assert backfill(left, daily, path, "ts", F.lit("2024-01-01"), F.lit("2024-01-01")) == 0
    assert backfill(events.limit(0), daily, path, "ts", "2024-01-01", "2024-01-02") == 0 and "2024-01-01" not in table()


# Streams

EVENT = "event_id long, user_id string, ts timestamp, value double"


def write_files(spark, directory, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(f"{directory}/{i}")


def read_stream(spark, directory):
    schema = T._parse_datatype_string(EVENT)
    return streams.file_stream(spark, f"{directory}/*", schema, max_files=1)


BATCHES = [
    [(1, "a", T0, 1.0), (1, "a", T0, 1.0), (2, "a", T0 + HOUR, 2.0)],
    [(2, "a", T0 + HOUR, 2.0), (3, "b", T0 + 2 * HOUR, 3.0), (4, "a", T0 + 30 * HOUR, 4.0)],
    [(5, "a", T0 + 3 * HOUR, 5.0), (6, "b", T0 + 31 * HOUR, 6.0)],
]


@pytest.mark.parametrize("fold", [True, False])
def test_stream_deduplicates(spark, tmp_path, fold):
    write_files(spark, tmp_path / "in", BATCHES)
    kept = streams.deduplicated(read_stream(spark, tmp_path / "in"), ["event_id"], "ts", "40 hours", fold)
    streams.run_to_end(streams.append_files(kept, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert sorted(r["event_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3, 4, 5, 6]


def test_copies_are_folded_before_the_shuffle(spark):
    """Big ids stay exact, null ids are one key, and the newest copy stays."""
    big = 2**60
    rows = [(big, "a", T0, 1.0), (big + 1, "b", T0, 2.0), (big, "a", T0 + HOUR, 3.0), (None, "n", T0, 4.0), (None, "n", None, 5.0)]
    df = spark.createDataFrame(rows, EVENT).coalesce(1)
    assert sorted(r["value"] for r in streams._fold_copies(df, ["event_id"], "ts").collect()) == [2.0, 3.0, 4.0]
    assert streams._fold_copies(df.filter("value > 9"), ["event_id"], "ts").count() == 0


def test_stream_upsert_resumes(spark, tmp_path):
    write_files(spark, tmp_path / "in", BATCHES[:2])
    online = OnlineTable(spark, str(tmp_path / "online"), ["user_id"], "ts", ["event_id"], buckets=2)
    streams.run_to_end(streams.push_upsert(read_stream(spark, tmp_path / "in"), online, str(tmp_path / "cp")))
    assert {r["user_id"]: r["event_id"] for r in online.read().collect()} == {"a": 4, "b": 3}
    spark.createDataFrame(BATCHES[2], EVENT).coalesce(1).write.parquet(str(tmp_path / "in" / "2"))
    streams.run_to_end(streams.push_upsert(read_stream(spark, tmp_path / "in"), online, str(tmp_path / "cp")))
    assert {r["user_id"]: r["event_id"] for r in online.read().collect()} == {"a": 4, "b": 6}


def test_stream_daily_drops_late_rows(spark, tmp_path):
    """The second file moves the watermark past the first day. It filters from the batch after the next one on, so the
    last file's row of that day is late."""
    batches = [*BATCHES[:2], [(7, "b", T0 + 32 * HOUR, 1.0)], BATCHES[2]]
    write_files(spark, tmp_path / "in", batches)
    online = OnlineTable(spark, str(tmp_path / "online"), ["user_id", "day"], "n_events", buckets=2)
    streams.run_to_end(streams.daily_upsert(read_stream(spark, tmp_path / "in"), online, str(tmp_path / "cp"), delay="1 hour"))
    got = {(r["user_id"], r["day"]): (r["n_events"], r["total_value"], r["max_value"]) for r in online.read().collect()}
    batch = streams.daily_user_features(spark.createDataFrame(sum(batches, []), EVENT)).collect()
    want = {(r["user_id"], r["day"]): (r["n_events"], r["total_value"], r["max_value"]) for r in batch}
    late = ("a", T0)
    assert got.keys() == want.keys() and {k: v for k, v in got.items() if k != late} == {k: v for k, v in want.items() if k != late}
    assert want[late] == (5, 11.0, 5.0) and got[late] == (4, 6.0, 2.0)


def test_streams_share_an_online_table(spark, tmp_path):
    """Two streams, and one that starts over with a new checkpoint, keep each other's rows."""
    online = OnlineTable(spark, str(tmp_path / "online"), ["user_id"], "ts", ["event_id"], buckets=2)
    for i, user in enumerate(("a", "b", "c")):
        write_files(spark, tmp_path / user, [[(i, user, T0 + i * HOUR, 1.0)]])
        streams.run_to_end(streams.push_upsert(read_stream(spark, tmp_path / user), online, str(tmp_path / f"cp-{user}")))
    assert {r["user_id"] for r in online.read().collect()} == {"a", "b", "c"}


def test_daily_features_start_over(spark, tmp_path):
    """A new checkpoint counts its batches from 0 again; the fullest state of a day stays."""
    write_files(spark, tmp_path / "in", BATCHES)
    online = OnlineTable(spark, str(tmp_path / "online"), ["user_id", "day"], "n_events", buckets=2)
    for checkpoint in ("cp-1", "cp-2"):
        stream = read_stream(spark, tmp_path / "in")
        streams.run_to_end(streams.daily_upsert(stream, online, str(tmp_path / checkpoint), delay="40 hours"))
    got = {(r["user_id"], r["day"]): r["n_events"] for r in online.read().collect()}
    batch = streams.daily_user_features(spark.createDataFrame(sum(BATCHES, []), EVENT))
    assert got == {(r["user_id"], r["day"]): r["n_events"] for r in batch.collect()}
    with pytest.raises(ValueError, match="n_events"):
        streams.daily_upsert(stream, OnlineTable(spark, str(tmp_path / "other"), ["user_id"], "ts"), str(tmp_path / "cp-3"))


def test_on_demand_references(spark, store):
    """Derived fields by reference: their inputs are retrieved, and dropped again unless asked for."""
    double = OnDemandView(
        "doubled", ("spend:amount", "spend:n"), (("twice", T.DoubleType()), ("both", T.LongType())),
        lambda df: df.withColumns({"twice": F.col("amount") * 2, "both": F.col("amount") + F.col("n")}),
    )
    store.registry.add_on_demand(double)
    entities = spark.createDataFrame([("a", T0 + HOUR), ("z", T0)], "user_id string, event_timestamp timestamp_ntz")
    found = store.get_historical_features(entities, ["doubled:*"])
    assert found.columns == ["user_id", "event_timestamp", "twice", "both"]
    assert {r["user_id"]: (r["twice"], r["both"]) for r in found.collect()} == {"a": (6.0, 6), "z": (None, None)}
    assert dict(found.dtypes)["both"] == "bigint"
    named = store.get_historical_features(entities, ["doubled:twice", "spend:n", "visits:n"], full_names=True)
    assert named.columns == ["user_id", "event_timestamp", "spend__n", "visits__n", "doubled__twice"]
    store.materialize("spend", T0, T0 + 9 * HOUR)
    keys = [{"user_id": "b"}, {"user_id": "z"}]
    online = store.get_online_features(["spend:n", "doubled:twice"], keys)
    assert sorted(map(tuple, online.collect())) == [("b", 9, 18.0), ("z", None, None)]
    for bad in ("doubled:thrice", "doubled"):
        with pytest.raises(RegistryError):
            store.get_historical_features(entities, [bad])
    with pytest.raises(RegistryError):
        store.registry.add_on_demand(OnDemandView("spend", ("visits:n",), (), lambda df: df))


def test_published_views():
    registry = sample_registry()
    stored, derived = registry.split(["malware_sample_features:read", "malware_derived_features:*"])
    assert stored == ["malware_sample_features:read"] and derived == {"malware_derived_features": list(SCORE_FIELDS)}
    family = registry.view("malware_family_features")
    assert registry.join_keys(family) == ["family_id"] and len(family.fields) == 9


def test_state_of_many_batches_shrinks(spark, tmp_path):
    """One file a batch: ids that the watermark has passed leave the state, and every id is kept once."""
    for day in range(6):
        rows = [(day * 10 + i, T0 + day * 24 * HOUR) for i in range(10)] * 2
        spark.createDataFrame(rows, "id long, t timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = streams.file_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema, max_files=1)
    query = streams.append_files(streams.deduplicated(stream, ["id"], "t", "1 hour"), str(tmp_path / "out"), str(tmp_path / "cp"))
    streams.run_to_end(query)
    state = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    assert len(query.recentProgress) >= 6 and sum(s["numRowsRemoved"] for s in state) >= 40 and max(s["numRowsTotal"] for s in state) <= 30
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(60))
