"""The list of named queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    items: tuple[str, ...]


REGISTRY: dict[str, Entry] = {}


def query(name: str, items: str, sql: str | None = None):
    """Register a query under a name, with the survey items it covers."""

    def add(run):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Entry(run, sql, tuple(items.split()))
        return run

    return add


def half_up(expression: str, digits: int) -> str:
    """SQL text that rounds like ``functions.numeric.rounded``: the decimal text of the double."""
    text = f"CAST(CAST({expression} AS DOUBLE) AS VARCHAR)"
    return f"CAST(round(CAST({text} AS DECIMAL(38, 16)), {digits}) AS DOUBLE)"


# Decimals in which a total in a result is compared; the rows are added unrounded.
TOTAL_DIGITS = 6


def total_sum(expression: str, digits: int = TOTAL_DIGITS) -> str:
    """SQL text of a rounded sum of unrounded doubles (with compensation)."""
    return half_up(f"fsum({expression})", digits)
