"""Streams of feature rows and events."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..store.online import OnlineTable


BATCH_BYTES = 64 << 30


def file_stream(
    spark: SparkSession, directory: str, schema: T.StructType, pattern: str = "*.parquet", max_files: int | None = None, max_bytes: int = BATCH_BYTES
) -> DataFrame:
    """New files of a directory. A micro-batch takes about `max_bytes`, or `max_files` files if that is given: the watermark
    moves between batches, so a long backlog does not become one batch whose state is never dropped."""
    limit = ("maxBytesPerTrigger", str(max_bytes)) if max_files is None else ("maxFilesPerTrigger", max_files)
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).option(*limit).parquet(directory)


def push_upsert(stream: DataFrame, online: OnlineTable, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Keep the newest row per key of a stream in an online table.

    Each micro-batch is merged into the buckets it touches. Merging is idempotent, so a batch that is retried after a failure changes
    nothing. Streams that feed one table must take turns.
    """
    return _upsert_batches(stream.writeStream, online, checkpoint, available_now)


def _upsert_batches(writer: DataStreamWriter, online: OnlineTable, checkpoint: str, available_now: bool) -> StreamingQuery:
    def merge(rows: DataFrame, _: int) -> None:
        online.upsert(rows)

    return _start(writer.foreachBatch(merge), checkpoint, available_now)


def deduplicated(stream: DataFrame, keys: Sequence[str], time: str, delay: str, fold: bool = True) -> DataFrame:
    """Rows whose key was not seen within the watermark; state for older keys is dropped.

    Spark sends every copy of a key to one task. With `fold` each Arrow batch first keeps one row per key, so a key that
    is repeated very often sends a row per batch and not a row per copy.
    """
    folded = _fold_copies(stream, list(keys), time) if fold else stream
    return folded.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def _fold_copies(stream: DataFrame, keys: list[str], time: str) -> DataFrame:
    """The copy with the newest time stays: an older one might be dropped as late."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_time = pc.sort_indices(batch.column(time), null_placement="at_start")
            ordered = pa.table([batch.column(k).take(by_time) for k in keys], names=keys)
            places = ordered.append_column("_fm_place", pa.array(np.arange(batch.num_rows)))
            last = places.group_by(keys).aggregate([("_fm_place", "max")])["_fm_place_max"].combine_chunks()
            yield batch.take(by_time.take(last))

    return stream.mapInArrow(fold, stream.schema)


def append_files(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append a stream to Parquet files, each row once."""
    return _start(stream.writeStream.format("parquet").option("path", path).outputMode("append"), checkpoint, available_now)


def daily_user_features(events: DataFrame, time: str = "ts", user: str = "user_id", value: str = "value") -> DataFrame:
    """Events, total and largest value per user and day. The same plan serves batches and streams.

    Partial sums are merged before the shuffle, so a user with most events costs one row per task.
    """
    day = F.window(F.col(time), "1 day").alias("w")
    return (
        events.groupBy(user, day)
        .agg(F.count(F.lit(1)).alias("n_events"), F.sum(value).alias("total_value"), F.max(value).alias("max_value"))
        .select(user, F.col("w.start").alias("day"), "n_events", "total_value", "max_value")
    )


def daily_upsert(stream: DataFrame, online: OnlineTable, checkpoint: str, time: str = "ts", delay: str = "1 day", available_now: bool = True) -> StreamingQuery:
    """Keep daily user features up to date: every micro-batch replaces the days it changed.

    Update mode emits a day whenever it changes, also the days still open at the end of the input. Rows that come later
    than the watermark allows are dropped.

    The online table's time column must be `n_events`: a day's count only grows, so between batches the fullest state wins,
    also when a query starts over with a new checkpoint.
    """
    if online.timestamp != "n_events":
        raise ValueError("the online table of daily features must be ordered by n_events")
    daily = daily_user_features(stream.withWatermark(time, delay), time)
    return _upsert_batches(daily.writeStream.outputMode("update"), online, checkpoint, available_now)


def _start(writer, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def run_to_end(query: StreamingQuery) -> None:
    """Wait for a query that stops by itself and raise what made it fail."""
    query.awaitTermination()
