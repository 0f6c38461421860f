"""Positions, top rows and shares within groups."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.session import written


def top_n(df: DataFrame, groups: list[str], order: list[Column], n: int, position: str | None = None) -> DataFrame:
    """First ``n`` rows per group.

    The filter on ``row_number`` makes Spark cut every map partition to ``n``
    rows per group before the shuffle (``WindowGroupLimit``): a hot group
    sends at most ``n`` rows per task.
    """
    name = position or "__position"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))
    kept = ranked.filter(F.col(name) <= n)
    return kept if position else kept.drop(name)


def positions(df: DataFrame, groups: list[str], order: list[Column], name: str) -> DataFrame:
    """Position of every row within its group, also in very large groups.

    A window over a whole group would sort a hot group in one task. Instead rows
    are dealt out in ranges of (group, order), a hash of the row breaking ties,
    so neither a large group nor a value with very many rows stays in one task.
    The ranges are written once; rows are numbered within (range, group), and
    the rows of a group in earlier ranges are added from a table with one row
    per range and group.
    """
    ranges = df.repartitionByRange(*[F.col(g) for g in groups], *order, F.xxhash64(*df.columns))
    dealt = written(ranges.withColumn("__range", F.spark_partition_id()), "ranges")
    per_range = dealt.groupBy(*groups, "__range").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy(*groups).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        *[F.col(g).alias(f"__{g}") for g in groups],
        F.col("__range").alias("__of"),
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"),
    )
    within = Window.partitionBy(*groups, "__range").orderBy(*order)
    same = [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in groups]
    return (
        dealt.withColumn("__within", F.row_number().over(within))
        .join(offsets, reduce(and_, same, F.col("__range") == F.col("__of")))
        .withColumn(name, (F.col("__before") + F.col("__within")).cast("int"))
        .select(*df.columns, name)
    )


def share_of_total(
    df: DataFrame, groups: list[str], value: str, name: str, bounded: bool = False
) -> DataFrame:
    """Percent of the group total, two decimals.

    Totals are aggregated with map-side combine and joined back, so no group
    has to fit into one task. Where the rows per group are known to be few
    (``bounded``), one window replaces the aggregation and the join. Rows whose
    group is NULL are a group of their own in both.
    """
    if bounded:
        summed = df.withColumn("__total", F.sum(value).over(Window.partitionBy(*groups)))
    else:
        named = [F.col(g).alias(f"__of_{n}") for n, g in enumerate(groups)]
        totals = df.groupBy(*named).agg(F.sum(value).alias("__total"))
        same = [F.col(g).eqNullSafe(F.col(f"__of_{n}")) for n, g in enumerate(groups)]
        summed = df.join(totals, reduce(and_, same)).select(*df.columns, "__total")
    percent = F.try_divide(F.lit(100) * F.col(value), F.col("__total"))
    return summed.withColumn(name, F.round(percent.cast("decimal(30,8)"), 2).cast("double")).drop("__total")


def top_names(df: DataFrame, groups: list[str], name: str, value: str, n: int, alias: str) -> DataFrame:
    """Per group the ``n`` names with the highest value, as an ordered array.

    Equal values are ordered by name. Only the top ``n`` rows reach the array.
    """
    best = top_n(df, groups, [F.desc(value), F.asc(name)], n)
    pairs = F.sort_array(F.collect_list(F.struct((-F.col(value)).alias("v"), F.col(name).alias("n"))))
    return best.groupBy(*groups).agg(F.transform(pairs, lambda p: p["n"]).alias(alias))
