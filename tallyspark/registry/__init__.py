"""Named queries over the shared tables, with the same query in SQL."""

from tallyspark.registry.core import REGISTRY, Entry, query
from tallyspark.registry import (  # noqa: F401  (they register their queries)
    aggregates,
    football,
    imaging,
    keyed,
    learning,
    ordering,
    shaping,
    storage,
    streams,
    studies,
    wording,
)

__all__ = ["REGISTRY", "Entry", "query"]
