"""Point-in-time joins, materialization, lookups, backfill."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.asof import FeatureRows, asof_join
from ..operators.latest import latest_per_key
from ..sinks import tables
from ..sources.files import timestamp_literal
from ..store.feature_store import FeatureStore, backfill, write_daily
from ..store.registry import Entity, FeatureView, Registry
from ..workdir import new_path
from .base import Query, scratch_database, table

MID, END = "2024-01-16 00:00:00", "2024-01-31 00:00:00"
START = "2024-01-01 00:00:00"


def _events(spark, sf_dir, kind):
    return table(spark, sf_dir, "events").filter(F.col("event_type") == kind)


def _entities(spark, sf_dir):
    return _events(spark, sf_dir, "purchase").select("event_id", "user_id", F.col("ts").alias("event_timestamp"))


def _view(spark, sf_dir, kind, ttl=None):
    rows = _events(spark, sf_dir, kind).select("user_id", "ts", F.col("event_id").alias(f"{kind}_id"), F.col("value").alias(f"{kind}_value"))
    return FeatureRows(rows, "ts", [f"{kind}_id", f"{kind}_value"], ttl, tie=[f"{kind}_id"])


def pit_join(spark, sf_dir):
    return asof_join(_entities(spark, sf_dir), ["user_id"], "event_timestamp", [_view(spark, sf_dir, "click")])


def pit_join_ttl(spark, sf_dir):
    return asof_join(_entities(spark, sf_dir), ["user_id"], "event_timestamp", [_view(spark, sf_dir, "click", "6 hours")])


def pit_two_views(spark, sf_dir):
    views = [_view(spark, sf_dir, "click"), _view(spark, sf_dir, "error", "1 day")]
    return asof_join(_entities(spark, sf_dir), ["user_id"], "event_timestamp", views)


def pit_hot_keys(spark, sf_dir):
    """The same join with every key above 10 rows taking the way for hot keys."""
    views = [_view(spark, sf_dir, "click"), _view(spark, sf_dir, "error", "1 day")]
    return asof_join(_entities(spark, sf_dir), ["user_id"], "event_timestamp", views, hot_rows=10)


def pit_join_bucketed(spark, sf_dir):
    """The same join with the clicks as a table that is bucketed by user: the entities go to its buckets."""
    name = f"{scratch_database(spark)}.clicks"
    view = _view(spark, sf_dir, "click")
    tables.write_bucketed(view.df, name, ["user_id"], ["ts"], 8)
    return asof_join(_entities(spark, sf_dir), ["user_id"], "event_timestamp", [replace(view, df=spark.table(name), buckets=8)])


def _asof_sql(kind: str, ttl: str | None = None, left: str = "") -> str:
    left = left or "(select event_id, user_id, ts as event_timestamp from events where event_type = 'purchase')"
    valid = f"f.ts >= e.event_timestamp - interval '{ttl}'" if ttl else "true"
    return f"""
select e.*, case when {valid} then f.{kind}_id end as {kind}_id, case when {valid} then f.{kind}_value end as {kind}_value
from {left} e
asof left join (select user_id, ts, event_id as {kind}_id, value as {kind}_value from events where event_type = '{kind}') f
on e.user_id = f.user_id and e.event_timestamp >= f.ts"""


_TWO_SQL = _asof_sql("error", "1 day", f"({_asof_sql('click')})")


def latest_rows(spark, sf_dir):
    return latest_per_key(
        table(spark, sf_dir, "events"), ["user_id"], "ts", ["event_id"], start=timestamp_literal(START), end=timestamp_literal(MID)
    )


def _latest_sql(end: str, columns: str = "*") -> str:
    return f"""
select {columns} from events where ts >= timestamp '{START}' and ts < timestamp '{end}'
qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"""


def _store(spark, sf_dir) -> FeatureStore:
    view = FeatureView(
        "user_events",
        ("user",),
        (("event_type", T.StringType()), ("value", T.DoubleType())),
        timestamp_field="ts",
        source="events",
        tie=("event_id",),
        online=True,
    )
    registry = Registry([Entity("user", ("user_id",), T.LongType())], [view])
    return FeatureStore(spark, registry, new_path(spark, "store"), {"events": table(spark, sf_dir, "events")}, buckets=8)


def online_lookup(spark, sf_dir):
    """Features of every customer that may be a user; most are none and get nulls."""
    store = _store(spark, sf_dir)
    store.materialize("user_events", START, MID)
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return store.get_online_features(["user_events:*"], keys)


def materialize_incr(spark, sf_dir):
    """Two runs, each from where the one before ended; the table then holds the newest row of both."""
    store = _store(spark, sf_dir)
    store.materialize_incremental("user_events", MID, first_start=START)
    store.materialize_incremental("user_events", END)
    return store.online("user_events").read()


def _daily(rows):
    day = F.col("ts").cast("date").alias("day")
    return rows.groupBy("user_id", day).agg(F.count(F.lit(1)).alias("n_events"), F.round(F.sum("value"), 4).alias("total_value"))


def backfill_range(spark, sf_dir):
    """Daily features are written without errors first; a week is then recomputed with them."""
    events = table(spark, sf_dir, "events")
    path = new_path(spark, "daily")
    write_daily(events.filter(F.col("event_type") != "error"), _daily, path)
    backfill(events, _daily, path, "ts", "2024-01-08 00:00:00", "2024-01-15 00:00:00")
    return spark.read.parquet(path)


QUERIES = [
    Query("pit_join", pit_join, _asof_sql("click")),
    Query("pit_join_bucketed", pit_join_bucketed, _asof_sql("click")),
    Query("pit_join_ttl", pit_join_ttl, _asof_sql("click", "6 hours")),
    Query("pit_two_views", pit_two_views, _TWO_SQL),
    Query("pit_hot_keys", pit_hot_keys, _TWO_SQL),
    Query("latest_per_key", latest_rows, _latest_sql(MID)),
    Query(
        "online_lookup",
        online_lookup,
        f"select c_custkey as user_id, event_type, value from customer left join ({_latest_sql(MID)}) on user_id = c_custkey",
    ),
    Query("materialize_incr", materialize_incr, _latest_sql(END, "user_id, ts, event_id, event_type, value")),
    Query(
        "backfill_range",
        backfill_range,
        """
select user_id, cast(ts as date) as day, count(*) as n_events, round(sum(value), 4) as total_value from events
where event_type <> 'error' or (ts >= timestamp '2024-01-08 00:00:00' and ts < timestamp '2024-01-15 00:00:00')
group by all""",
    ),
]
