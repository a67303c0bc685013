"""The registered queries: every operator on stand-in inputs made from the given tables, with its SQL where there is one."""

from __future__ import annotations

from . import comparing, features, staging, storing, streams, versioning, workflows
from .base import Query

_MODULES = (staging, features, storing, comparing, versioning, streams, workflows)


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for module in _MODULES:
        for query in module.QUERIES:
            if query.name in found:
                raise ValueError(f"query {query.name} is registered twice")
            found[query.name] = query
    return found
