"""Helpers that several of these operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators.ranking import top_n
from tallyspark.session import written
from tallyspark.tables import table

__all__ = ["bounded_keys", "crc_of_id", "first_by_hash", "in_remainder", "table", "with_new_columns", "written"]


def crc_of_id(key: str) -> Column:
    """CRC-32 of an integer key as text; NULL for NULL."""
    return F.crc32(F.col(key).cast("string").cast("binary"))


def in_remainder(key: str, modulus: int, remainder: int) -> Column:
    """Whether the CRC-32 of the key leaves the remainder; never NULL."""
    return F.coalesce(crc_of_id(key) % modulus == remainder, F.lit(False))


PARTS_OF_A_GROUP = 64


def _cut_in_parts(df: DataFrame, groups: list[str], key: str, limit: int) -> DataFrame:
    """Distinct keys, each group cut to the limit in parts by hash, so that a
    group with a third of all rows, or very many partitions, is not left to one task."""
    part = F.pmod(F.xxhash64(key), F.lit(PARTS_OF_A_GROUP))
    keys = df.filter(F.col(key).isNotNull()).select(*groups, key).distinct().withColumn("__part", part)
    return top_n(keys, [*groups, "__part"], _hash_order(key), limit).drop("__part")


def _hash_order(key: str) -> list[Column]:
    """An order of keys that does not depend on partitioning and retries."""
    return [F.xxhash64(key), F.col(key)]


def first_by_hash(df: DataFrame, groups: list[str], key: str, limit: int) -> DataFrame:
    """Distinct keys of each group, at most ``limit`` of them in hash order."""
    return top_n(_cut_in_parts(df, groups, key, limit), groups, _hash_order(key), limit)


def bounded_keys(keys: DataFrame, key: str, limit: int) -> list:
    """At most ``limit`` distinct keys in hash order, as a list on the driver.

    The bound makes the list small whatever the input is.
    """
    cut = _cut_in_parts(keys, [], key, limit)
    return [row[0] for row in cut.orderBy(*_hash_order(key)).limit(limit).collect()]


def with_new_columns(df: DataFrame, *names: str) -> DataFrame:
    """The frame without columns that would clash with new ones of these names."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def rows_for_keys(spark: SparkSession, df: DataFrame, key: str, keys: list) -> DataFrame:
    """Rows whose key is in a bounded list (a broadcast semi join)."""
    listed = spark.createDataFrame([(k,) for k in keys], f"{key} bigint")
    return df.join(F.broadcast(listed), key, "left_semi")
