"""Entities, feature views and their validation."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T


class RegistryError(ValueError):
    """A name or a schema does not fit the registry."""


@dataclass(frozen=True)
class Entity:
    name: str
    join_keys: tuple[str, ...]
    value_type: T.DataType = field(default_factory=T.StringType)
    description: str = ""


@dataclass(frozen=True)
class FeatureView:
    """Typed fields of a table that are keyed by entities and valid for `ttl` (interval text) after their timestamp.

    `buckets` says that the table is bucketed by the join keys; retrieval then leaves it where it is.
    """

    name: str
    entities: tuple[str, ...]
    fields: tuple[tuple[str, T.DataType], ...]
    timestamp_field: str
    source: str
    ttl: str | None = None
    tie: tuple[str, ...] = ()
    online: bool = False
    buckets: int = 0

    def field_names(self) -> list[str]:
        return [name for name, _ in self.fields]


@dataclass(frozen=True)
class OnDemandView:
    """Typed fields that are computed when features are read. `inputs` are references to stored features; `function` appends
    the fields to a frame that has them."""

    name: str
    inputs: tuple[str, ...]
    fields: tuple[tuple[str, T.DataType], ...]
    function: Callable[[DataFrame], DataFrame]

    def field_names(self) -> list[str]:
        return [name for name, _ in self.fields]


class Registry:
    """The known entities and views. Every name is checked when it is used, not when a job has already run."""

    def __init__(self, entities: Sequence[Entity] = (), views: Sequence[FeatureView] = (), on_demand: Sequence[OnDemandView] = ()):
        self.entities: dict[str, Entity] = {}
        self.views: dict[str, FeatureView] = {}
        self.on_demand: dict[str, OnDemandView] = {}
        for entity in entities:
            self.add_entity(entity)
        for view in views:
            self.add_view(view)
        for derived in on_demand:
            self.add_on_demand(derived)

    def add_entity(self, entity: Entity) -> None:
        self.entities[entity.name] = entity

    def add_view(self, view: FeatureView) -> None:
        unknown = [e for e in view.entities if e not in self.entities]
        if unknown:
            raise RegistryError(f"view {view.name} names unknown entities: {', '.join(unknown)}")
        self.views[view.name] = view

    def add_on_demand(self, view: OnDemandView) -> None:
        self.resolve(view.inputs)
        if view.name in self.views:
            raise RegistryError(f"{view.name} is a view of stored features")
        self.on_demand[view.name] = view

    def list_entities(self) -> list[str]:
        return sorted(self.entities)

    def list_views(self) -> list[str]:
        return sorted(self.views)

    def view(self, name: str) -> FeatureView:
        if name not in self.views:
            raise RegistryError(f"unknown feature view {name}")
        return self.views[name]

    def join_keys(self, view: FeatureView) -> list[str]:
        return [k for e in view.entities for k in self.entities[e].join_keys]

    def resolve(self, references: Sequence[str]) -> dict[str, list[str]]:
        """`view:field` references to stored features by view; `view:*` is every field."""
        wanted: dict[str, list[str]] = {}
        for reference in references:
            name, column = self._parts(reference)
            names = self._fields(self.view(name), column)
            wanted.setdefault(name, []).extend(n for n in names if n not in wanted.get(name, []))
        return wanted

    def split(self, references: Sequence[str]) -> tuple[list[str], dict[str, list[str]]]:
        """References to stored features, and the asked fields of each on-demand view."""
        stored, derived = [], {}
        for reference in references:
            name, column = self._parts(reference)
            if name not in self.on_demand:
                stored.append(reference)
                continue
            names = self._fields(self.on_demand[name], column)
            derived.setdefault(name, []).extend(n for n in names if n not in derived.get(name, []))
        return stored, derived

    @staticmethod
    def _parts(reference: str) -> tuple[str, str]:
        name, colon, column = reference.partition(":")
        if not colon:
            raise RegistryError(f"feature reference {reference} is not of the form view:field")
        return name, column

    @staticmethod
    def _fields(view: FeatureView | OnDemandView, column: str) -> list[str]:
        names = view.field_names() if column == "*" else [column]
        unknown = [n for n in names if n not in view.field_names()]
        if unknown:
            raise RegistryError(f"view {view.name} has no field {', '.join(unknown)}")
        return names

    def check_source(self, view: FeatureView, df: DataFrame) -> None:
        """Keys, timestamp and fields must be in the table, and field types must be castable without loss of kind."""
        have = {f.name: f.dataType for f in df.schema.fields}
        needed = [*self.join_keys(view), view.timestamp_field, *view.field_names(), *view.tie]
        absent = sorted({n for n in needed if n not in have})
        if absent:
            raise RegistryError(f"the source of view {view.name} lacks: {', '.join(absent)}")
        if not isinstance(have[view.timestamp_field], (T.TimestampType, T.TimestampNTZType, T.DateType)):
            raise RegistryError(f"{view.timestamp_field} of view {view.name} is not a timestamp")
        for name, kind in view.fields:
            if isinstance(kind, T.NumericType) != isinstance(have[name], T.NumericType):
                raise RegistryError(f"{name} of view {view.name} is {have[name].simpleString()}, not {kind.simpleString()}")
