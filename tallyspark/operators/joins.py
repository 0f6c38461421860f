"""Join operators beyond a plain ``DataFrame.join``.

No broadcast hints: Spark broadcasts a side when its measured size is small,
and adaptive execution splits hot partitions of the sort-merge joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def left_join_filled(left: DataFrame, right: DataFrame, keys: list[str], fill: dict) -> DataFrame:
    """Left equi join; missing values of the named columns get a default."""
    return left.join(right, keys, "left").fillna(fill)


def lookup(df: DataFrame, dimension: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Add columns of a dimension that is unique on the keys; rows that it does not know are left out."""
    return df.join(dimension.select(*keys, *columns), keys)


# Up to this many entries it is faster to look at all of them than to search.
SHORT = 32


def points_per_group(points: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """Per group one array ``points`` of (at, value, total), sorted; the total is that of all values up to there.

    ``at`` must be discrete and bounded within a group (seconds of a match): values
    are added up per moment before a group meets in one task, so its array has one
    entry per moment however many rows it has. Points without a moment are left out.
    """
    summed = points.filter(F.col(at).isNotNull()).groupBy(*keys, at).agg(F.coalesce(F.sum(value), F.lit(0)).alias("__value"))
    until = Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("__value").over(until).cast("bigint").alias("__total")
    pair = F.struct(F.col(at).alias("at"), F.col("__value").cast("bigint").alias("value"), F.col("__total").alias("total"))
    # Window and grouping have the same keys: one shuffle for both.
    return summed.select(*keys, at, "__value", total).groupBy(*keys).agg(F.sort_array(F.collect_list(pair)).alias("points"))


def total_before(points: Column, moment: Column) -> Column:
    """The running total of the last of the sorted points with at < moment, by binary search; 0 before the first."""
    size = F.size(points)
    halvings = F.ceil(F.log2(size + F.lit(1.0))).cast("int")
    whole = F.struct(F.lit(0).alias("low"), size.alias("high"))

    def halve(state: Column, _: Column) -> Column:
        low, high = state["low"], state["high"]
        middle = F.shiftright(low + high, 1)
        before = F.get(points, middle)["at"] < moment
        return F.when(low >= high, state).otherwise(
            F.struct(F.when(before, middle + 1).otherwise(low).alias("low"), F.when(before, high).otherwise(middle).alias("high"))
        )

    earlier = F.aggregate(F.sequence(F.lit(1), halvings), whole, halve, lambda state: state["low"])
    return F.when(earlier > 0, F.get(points, earlier - 1)["total"]).otherwise(F.lit(0).cast("bigint"))


def sum_inside(points: Column, start: Column, end: Column) -> Column:
    """Sum of the values of running points with start <= at < end; 0 if there are none."""
    zero = F.lit(0).cast("bigint")
    few = F.aggregate(F.filter(points, lambda p: (p["at"] >= start) & (p["at"] < end)), zero, lambda s, p: s + p["value"])
    inside = F.when(F.size(points) <= SHORT, few).otherwise(total_before(points, end) - total_before(points, start))
    return F.when((F.size(points) > 0) & (start < end), inside).otherwise(zero)


def sum_in_interval(
    intervals: DataFrame,
    points: DataFrame,
    keys: list[str],
    at: str,
    value: str,
    start: Column,
    end: Column,
    name: str,
) -> DataFrame:
    """Interval join with a sum: points of the same group with start <= at < end.

    Points are first added up per group and moment and gathered to one array of
    running totals per group. The join is then many intervals to one row on the equi
    keys, and an interval is the difference of two totals found by binary search: no
    pairs of intervals and points are produced, and n points and intervals of a group
    cost n log n.
    """
    gathered = points_per_group(points, keys, at, value)
    return (
        intervals.join(gathered, keys, "left")
        .withColumn(name, sum_inside(F.col("points"), start, end))
        .drop("points")
    )
