"""Samples and splits that do not depend on how the data is partitioned."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.ranking import positions, top_n


def sample_by_suffix(df: DataFrame, id_col: str, suffixes: list[str], n: int, mark: str = "_") -> DataFrame:
    """``n`` rows without a mark in the id, plus ``n`` rows per id suffix.

    One scan: each row lists the classes it belongs to. A row that belongs to
    two classes may be sampled for both. Rows are taken in id order.
    """
    ident = F.col(id_col)
    tests = [F.when(~ident.contains(mark), F.lit(""))]
    tests += [F.when(ident.endswith(s), F.lit(s)) for s in suffixes]
    classed = df.withColumn("sample_class", F.explode(F.array_compact(F.array(*tests))))
    return top_n(classed, ["sample_class"], [F.asc(id_col)], n)


def key_hash(key) -> Column:
    """32 bits of the digest of a key, the same on every engine and partitioning."""
    key = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint")


def hash_bucket(key, buckets: int = 100) -> Column:
    """Stable bucket of a key, the same on every engine and partitioning."""
    return F.pmod(key_hash(key), F.lit(buckets)).cast("int")


def part_by_key(key, train_percent: int = 80) -> Column:
    """``train`` or ``test`` by a hash of the key, to mark rows in one scan."""
    return F.when(hash_bucket(key) < train_percent, F.lit("train")).otherwise(F.lit("test"))


def split_by_key(df: DataFrame, key, train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a hash of the key.

    Unlike ``randomSplit`` the split does not change with the partitioning or
    when a lost executor's rows are computed again.
    """
    bucket = hash_bucket(key)
    return df.filter(bucket < train_percent), df.filter(bucket >= train_percent)


# Bits of the key's hash that tell the bins of the histogram apart.
BIN_BITS = 16


def split_exactly(df: DataFrame, key: str, train_percent: int = 80, classes: list[str] | None = None) -> DataFrame:
    """Add ``part``: the share, rounded down, of the rows of each class is ``train``, all others ``test``.

    The rows of a class are taken in the order of the key's hash, then the key, then
    a hash of the row, so the split depends on nothing but the rows. A histogram of
    the hashes, combined before the shuffle, finds the bin in which each class
    reaches its share. Rows below and above that bin need no more than a look at
    it; only those in it are put in order, in ranges, so that a key with very many
    rows is not left to one task. Rows without key come last; NULL is a class.
    """
    classes = [F.col(c) for c in classes or []] or [F.lit(0)]
    names = [f"__c{n}" for n in range(len(classes))]
    last = F.lit(1 << BIN_BITS)
    marked = df.withColumns(
        {
            **dict(zip(names, classes, strict=True)),
            "__hash": key_hash(key),
            "__bin": F.coalesce(F.shiftright(key_hash(key), 32 - BIN_BITS), last).cast("int"),
        }
    )
    counts = marked.groupBy(*names, "__bin").agg(F.count(F.lit(1)).alias("__n"))
    # At most 2^BIN_BITS + 1 rows for each class.
    so_far = F.sum("__n").over(Window.partitionBy(*names).orderBy("__bin"))
    whole = F.sum("__n").over(Window.partitionBy(*names))
    wanted = (whole * F.lit(train_percent) - F.pmod(whole * F.lit(train_percent), F.lit(100))) / F.lit(100)
    reached = counts.select(*names, "__bin", "__n", so_far.alias("__until"), wanted.cast("bigint").alias("__wanted"))
    edges = reached.filter((F.col("__until") > F.col("__wanted")) & (F.col("__until") - F.col("__n") <= F.col("__wanted")))
    edges = edges.select(
        *[F.col(n).alias(f"{n}e") for n in names],
        F.col("__bin").alias("__edge"),
        (F.col("__wanted") - F.col("__until") + F.col("__n")).alias("__left"),
    )
    # A class of which all rows are wanted has no such bin.
    same = reduce(and_, [F.col(n).eqNullSafe(F.col(f"{n}e")) for n in names])
    judged = marked.join(edges, same, "left")
    train, test = F.lit("train"), F.lit("test")
    at_edge = F.coalesce(F.col("__bin") == F.col("__edge"), F.lit(False))
    sure = judged.filter(~at_edge).withColumn(
        "part", F.when(F.coalesce(F.col("__bin") < F.col("__edge"), F.lit(True)), train).otherwise(test)
    )
    order = [F.col("__hash").asc_nulls_last(), F.col(key).asc_nulls_last(), F.xxhash64(*df.columns)]
    close = positions(judged.filter(at_edge).select(*df.columns, *names, "__hash", "__left"), names, order, "__place")
    close = close.withColumn("part", F.when(F.col("__place") <= F.col("__left"), train).otherwise(test))
    return sure.select(*df.columns, "part").unionAll(close.select(*df.columns, "part"))
