"""Column profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _plain(name: str, kind: str) -> Column:
    """A value as text, equal for equal values: 0.0 and -0.0 are one."""
    value = F.col(name)
    return (value + F.lit(0).cast(kind) if kind in ("double", "float") else value).cast("string")


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, type, NULL count, distinct non-NULL values.

    Rows become (column, value) pairs that are counted per value before the
    last step, so the shuffle carries each distinct value of a map partition
    once and a frequent value is no hot spot.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), _plain(c, kind).alias("value")) for c, kind in df.dtypes])
    )
    per_value = df.select(pairs.alias("p")).groupBy("p.column_name", "p.value").agg(
        F.count(F.lit(1)).alias("n")
    )
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    return (
        per_value.groupBy("column_name")
        .agg(
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("null_count"),
            F.count("value").alias("distinct_count"),
        )
        .select(
            "column_name",
            F.element_at(types, F.col("column_name")).alias("column_type"),
            "null_count",
            "distinct_count",
        )
    )
