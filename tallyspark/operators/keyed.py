"""Changes of a keyed table, as DataFrame jobs that produce the next snapshot.

Write the result to a new folder; never overwrite the folder that is read.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.ranking import top_n


def append_rows(base: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows of the same columns, matched by name."""
    return base.unionByName(rows)


def append_merged(base: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows of other columns; what a side lacks is NULL."""
    return base.unionByName(rows, allowMissingColumns=True)


def unique_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows unchanged; the job fails if a key occurs twice.

    Rows are combined per key before the shuffle, so even a key repeated very
    often cannot overload the task that reports it. The test is a filter, which
    no later step can prune. A key with a NULL equals no other key.
    """
    others = [c for c in df.columns if c not in keys]
    whole = reduce(and_, [F.col(k).isNotNull() for k in keys])
    grouped = df.filter(whole).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), *[F.any_value(c).alias(c) for c in others]
    )
    duplicate = F.concat(F.lit("two rows for one key: "), F.to_json(F.struct(*keys)))
    once = grouped.filter(F.when(F.col("__n") == 1, F.lit(True)).otherwise(F.raise_error(duplicate).cast("boolean")))
    return once.select(*df.columns).unionByName(df.filter(~whole))


def upsert(base: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``updates`` replace the base rows of the same key or are added.

    Duplicate keys in ``updates`` are an error, as in SQL ``MERGE``; rows with a
    NULL key match nothing and are added. The anti join needs the keys only:
    while the updates are small Spark broadcasts them, and the base is then not
    shuffled at all. ``updates`` is read twice; write costly ones to a table first.
    """
    kept = base.join(updates.select(*keys), keys, "left_anti")
    return kept.unionByName(unique_by(updates, keys))


def update_where(df: DataFrame, changes: dict[str, Column], condition: Column | None = None) -> DataFrame:
    """Set columns on matching rows (on all rows without a condition)."""
    new = {}
    for name, value in changes.items():
        new[name] = value if condition is None else F.when(condition, value).otherwise(F.col(name))
    return df.withColumns(new)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Drop matching rows. A NULL condition keeps the row, as SQL ``DELETE`` does."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Newest row per key; ``order`` is newest first and should be total.

    Spark limits each map partition to its first row per key before the
    shuffle, so a key with very many versions does not land in one task.
    """
    return top_n(df, keys, order, 1)
