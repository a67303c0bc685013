"""Streams over the events file, each run to its end; the results must equal what a batch gives."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..store.online import OnlineTable
from ..streaming import streams
from ..workdir import new_path
from .base import Query, table


def _stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return streams.file_stream(spark, sf_dir, schema, "events.parquet")


def stream_latest(spark, sf_dir):
    events = _stream(spark, sf_dir)
    online = OnlineTable(spark, new_path(spark, "stream-online"), ["user_id"], "ts", ["event_id"], buckets=8)
    streams.run_to_end(streams.push_upsert(events, online, new_path(spark, "stream-checkpoint")))
    return online.read()


def stream_dedup(spark, sf_dir):
    """The events stream twice: each event is kept once."""
    events = _stream(spark, sf_dir)
    # Watermarks need timestamps with a zone.
    doubled = events.union(events).withColumn("event_time", _as_utc(F.col("ts")))
    path = new_path(spark, "stream-dedup")
    kept = streams.deduplicated(doubled, ["event_id"], "event_time", "1 hour").drop("event_time")
    streams.run_to_end(streams.append_files(kept, path, new_path(spark, "stream-checkpoint")))
    return spark.read.schema(kept.schema).parquet(path)


def user_daily(spark, sf_dir):
    events = _stream(spark, sf_dir)
    # Windows are cut at UTC midnight, so the zone-free time is read as UTC.
    timed = events.withColumn("ts", _as_utc(F.col("ts")))
    online = OnlineTable(spark, new_path(spark, "stream-daily"), ["user_id", "day"], "n_events", buckets=8)
    streams.run_to_end(streams.daily_upsert(timed, online, new_path(spark, "stream-checkpoint")))
    return online.read().select(
        "user_id", F.date_from_unix_date(F.floor(F.unix_seconds("day") / 86400).cast("int")).alias("day"), "n_events",
        F.round("total_value", 4).alias("total_value"), "max_value",
    )


def _as_utc(ts):
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)
    return F.timestamp_micros(micros)


QUERIES = [
    Query(
        "stream_latest", stream_latest,
        """
select * from events
qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
    ),
    Query("stream_dedup", stream_dedup, "select * from events"),
    Query(
        "user_daily", user_daily,
        """
select user_id, cast(ts as date) as day, count(*) as n_events, round(sum(value), 4) as total_value, max(value) as max_value
from events group by all""",
    ),
]
