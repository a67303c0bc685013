"""Retrieval, materialization and lookup of features."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.asof import FeatureRows, asof_join
from ..operators.features import with_on_demand_scores
from ..operators.latest import latest_per_key
from ..sinks.tables import drop_partitions, overwrite_partitions, write_parquet
from ..sources.files import timestamp_literal
from .online import BUCKETS, OnlineTable
from .registry import FeatureView, Registry

DEFAULT_DAYS = 30


class FeatureStore:
    """Feature views over tables. `tables` maps a view's source name to a frame; other names are read from the catalog."""

    def __init__(
        self, spark: SparkSession, registry: Registry, path: str, tables: Mapping[str, DataFrame] | None = None, buckets: int = BUCKETS
    ):
        self.spark = spark
        self.registry = registry
        self.path = path.rstrip("/")
        self.tables = dict(tables or {})
        self.buckets = buckets

    def source(self, view: FeatureView) -> DataFrame:
        df = self.tables[view.source] if view.source in self.tables else self.spark.table(view.source)
        self.registry.check_source(view, df)
        return df

    def online(self, view_name: str) -> OnlineTable:
        view = self.registry.view(view_name)
        path = f"{self.path}/online/{view.name}"
        return OnlineTable(self.spark, path, self.registry.join_keys(view), view.timestamp_field, view.tie, self.buckets)

    def get_historical_features(
        self, entities: DataFrame, references: Sequence[str], timestamp: str = "event_timestamp", full_names: bool = False, **options
    ) -> DataFrame:
        """Point-in-time features for every entity row. Views with the same keys share one shuffle.

        `full_names` prefixes columns with their view, which is needed when two views have fields of one name. References may
        name on-demand views; what these read is retrieved too, and dropped again unless it was asked for.
        """
        stored, derived = self.registry.split(references)
        wanted = self.registry.resolve([*stored, *self._inputs(derived)])
        by_keys: dict[tuple[str, ...], list[FeatureRows]] = {}
        taken = set(entities.columns)
        for name, columns in wanted.items():
            view = self.registry.view(name)
            names = [f"{name}__{c}" if full_names else c for c in columns]
            clash = taken.intersection(names)
            if clash:
                raise ValueError(f"column names occur twice: {', '.join(sorted(clash))}; use full_names")
            taken.update(names)
            rows = FeatureRows(self._typed_fields(view, self.source(view)), view.timestamp_field, columns, view.ttl, view.tie, names, buckets=view.buckets)
            by_keys.setdefault(tuple(self.registry.join_keys(view)), []).append(rows)
        result = entities
        for keys, views in by_keys.items():
            result = asof_join(result, keys, timestamp, views, **options)
        return self._with_derived(result, entities.columns, stored, derived, full_names)

    def _inputs(self, derived: Mapping[str, Sequence[str]]) -> list[str]:
        return [reference for name in derived for reference in self.registry.on_demand[name].inputs]

    def _with_derived(
        self, found: DataFrame, kept: Sequence[str], stored: Sequence[str], derived: Mapping[str, Sequence[str]], full_names: bool = False
    ) -> DataFrame:
        """Append the asked fields of on-demand views and drop inputs that were not asked for."""

        def label(view: str, column: str) -> str:
            return f"{view}__{column}" if full_names else column

        result = [*kept, *[label(v, c) for v, columns in self.registry.resolve(stored).items() for c in columns]]
        for name, fields in derived.items():
            view = self.registry.on_demand[name]
            # The function sees its inputs under their own names.
            short = {label(v, c): c for v, columns in self.registry.resolve(view.inputs).items() for c in columns}
            made = view.function(found.withColumnsRenamed(short))
            kinds = dict(view.fields)
            new = [F.col(f).cast(kinds[f]).alias(label(name, f)) for f in fields]
            found = made.select(*[F.col(short.get(c, c)).alias(c) for c in found.columns], *new)
            result += [label(name, f) for f in fields]
        return found.select(*result)

    def get_batch_view(self, view_name: str) -> DataFrame:
        """A view's keys, timestamp and fields as a plain frame."""
        view = self.registry.view(view_name)
        return self._typed(view, self.source(view))

    @staticmethod
    def _typed_fields(view: FeatureView, df: DataFrame) -> DataFrame:
        """The frame with the view's fields in their registered types."""
        return df.withColumns({name: F.col(name).cast(kind) for name, kind in view.fields if df.schema[name].dataType != kind})

    def _typed(self, view: FeatureView, df: DataFrame) -> DataFrame:
        """Keys, timestamp, ties and fields, the fields in their registered types."""
        columns = dict.fromkeys([*self.registry.join_keys(view), view.timestamp_field, *view.tie, *view.field_names()])
        return self._typed_fields(view, df).select(*columns)

    def materialize(self, view_name: str, start: str | datetime, end: str | datetime) -> int:
        """Write the newest row per key with `start <= time < end` to the view's online table."""
        view = self.registry.view(view_name)
        newest = latest_per_key(
            self._typed(view, self.source(view)),
            self.registry.join_keys(view),
            view.timestamp_field,
            view.tie,
            start=timestamp_literal(_text(start)),
            end=timestamp_literal(_text(end)),
        )
        return self.online(view_name).upsert(newest, until=_text(end))

    def materialize_recent(self, view_name: str, end: datetime, days: int = DEFAULT_DAYS) -> int:
        return self.materialize(view_name, end - timedelta(days=days), end)

    def materialize_incremental(self, view_name: str, end: str | datetime, first_start: str | datetime | None = None) -> int:
        """Materialize from where the last run ended. The first run needs a start."""
        last = self.online(view_name).last_end()
        start = last if last is not None else first_start
        if start is None:
            raise ValueError(f"view {view_name} was never materialized: give first_start")
        if _text(end) <= _text(start):
            return 0
        return self.materialize(view_name, start, end)

    def get_online_features(self, references: Sequence[str], keys: DataFrame | Sequence[Mapping], full_names: bool = False) -> DataFrame:
        """The online table's features for the given keys; unknown keys have null features. Fields of on-demand views are
        computed from them. `full_names` prefixes columns with their view, as in historical retrieval."""
        stored, derived = self.registry.split(references)
        wanted = self.registry.resolve([*stored, *self._inputs(derived)])
        if not wanted:
            raise ValueError("no feature was asked for")
        result, made = keys, []
        for view, columns in wanted.items():
            names = [f"{view}__{c}" if full_names else c for c in columns]
            given = result.columns if isinstance(result, DataFrame) else self.registry.join_keys(self.registry.view(view))
            clash = set(given).intersection(names)
            if clash:
                raise ValueError(f"column names occur twice: {', '.join(sorted(clash))}; use full_names")
            result = self.online(view).lookup(result, columns, names)
            made += names
        return self._with_derived(result, [c for c in result.columns if c not in made], stored, derived, full_names)

    def with_on_demand(self, df: DataFrame, function: Callable[[DataFrame], DataFrame] = with_on_demand_scores) -> DataFrame:
        """Derived features, computed on what a retrieval returned."""
        return function(df)

    def push(self, view_name: str, rows: DataFrame) -> int:
        """Merge pushed rows into the online table; the newest row per key stays. A push may be repeated."""
        view = self.registry.view(view_name)
        self.registry.check_source(view, rows)
        return self.online(view_name).upsert(self._typed(view, rows))


def _text(moment: str | datetime) -> str:
    """One form for all moments, whose order as text is their order in time; moments with an offset become UTC."""
    parsed = datetime.fromisoformat(moment.strip()) if isinstance(moment, str) else moment
    if parsed.tzinfo is not None:
        parsed = parsed.astimezone(timezone.utc)
    return parsed.strftime("%Y-%m-%d %H:%M:%S.%f")


def backfill(
    source: DataFrame, compute: Callable[[DataFrame], DataFrame], path: str, timestamp: str, start: Column | str, end: Column | str, day: str = "day"
) -> int:
    """Recompute a range of days: filter, compute and replace the partitions of those days.

    A range that begins or ends within a day is widened to whole days, since a day's partition is replaced as a whole. Days of the range that have
    no rows any more lose their partition. `compute` must return a `day` column for the partitions. The filter reaches the scan.
    """
    first, last = _whole_days(source.sparkSession, start, end)
    part = source.filter((F.col(timestamp) >= F.lit(first).cast("timestamp_ntz")) & (F.col(timestamp) < F.lit(last).cast("timestamp_ntz")))
    rows = overwrite_partitions(compute(part), path, [day])
    made = {r[0] for r in compute(part).select(F.col(day).cast("string")).distinct().collect()}
    days = [first + timedelta(days=i) for i in range((last - first).days)]
    drop_partitions(source.sparkSession, path, day, [str(d) for d in days if str(d) not in made])
    return rows


def _whole_days(spark: SparkSession, start: Column | str, end: Column | str) -> tuple[date, date]:
    """The first day of a range and the day after its last one."""
    ends = [timestamp_literal(_text(x)) if isinstance(x, str) else x for x in (start, end)]
    row = spark.range(1).select(*[x.cast("timestamp_ntz").alias(n) for x, n in zip(ends, ("a", "b"))]).first()
    last = row["b"].date()
    return row["a"].date(), last if row["b"] == datetime.combine(last, time()) else last + timedelta(days=1)


def write_daily(source: DataFrame, compute: Callable[[DataFrame], DataFrame], path: str, day: str = "day") -> int:
    return write_parquet(compute(source), path, mode="overwrite", partition_by=[day])
