"""Daily weather by year and country."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.numeric import exact_mean, rounded


def with_year(weather: DataFrame) -> DataFrame:
    return weather.withColumn("year", F.year("date"))


def extremes(weather: DataFrame) -> DataFrame:
    """Lowest and highest temperature of all rows."""
    return weather.agg(
        F.min("temperature_min").alias("temperature_min"),
        F.max("temperature_max").alias("temperature_max"),
    )


def extremes_by_year(weather: DataFrame) -> DataFrame:
    return with_year(weather).groupBy("year").agg(
        F.min("temperature_min").alias("temperature_min"),
        F.max("temperature_max").alias("temperature_max"),
    )


def summary_by_year_and_country(weather: DataFrame) -> DataFrame:
    """Entries, extremes with one decimal, mean snow depth in whole numbers."""
    return with_year(weather).groupBy("year", "country").agg(
        F.count(F.lit(1)).alias("entries"),
        rounded(F.min("temperature_min"), 1).alias("temperature_min"),
        rounded(F.max("temperature_max"), 1).alias("temperature_max"),
        rounded(exact_mean("snow_depth"), 0).cast("int").alias("snow_depth_avg"),
    )


def picked_values(summary: DataFrame, coldest, warmest, spread, snow_year: int) -> DataFrame:
    """Four values of the summary in one row and one pass.

    ``coldest``, ``warmest`` and ``spread`` are (year, country) pairs.
    """

    def at(pair, value):
        year, country = pair
        return F.max(F.when((F.col("year") == year) & (F.col("country") == country), value))

    low, high = F.col("temperature_min"), F.col("temperature_max")
    snow = F.when(F.col("year") == snow_year, F.col("snow_depth_avg"))
    return summary.agg(
        at(coldest, low).alias("coldest"),
        at(warmest, high).alias("warmest"),
        rounded(at(spread, high) - at(spread, low), 1).alias("spread"),
        rounded(F.try_divide(F.sum(snow), F.count(snow)), 0).cast("int").alias("mean_snow_depth"),
    )


def cold_days_by_year(weather: DataFrame, country: str, below: float = -10) -> DataFrame:
    return (
        with_year(weather)
        .filter((F.col("country") == country) & (F.col("temperature_avg") < below))
        .groupBy("year")
        .agg(F.count("date").alias("count"))
    )


def warm_days_with_snow(weather: DataFrame, above: float = 5, snow_above: float = 100) -> DataFrame:
    return (
        weather.filter((F.col("temperature_avg") > above) & (F.col("snow_depth") > snow_above))
        .groupBy("country")
        .agg(F.count("date").alias("count"))
    )


def widest_days(weather: DataFrame, country: str, n: int = 10, tie_break: list[str] | None = None) -> DataFrame:
    """The ``n`` days with the largest temperature range in a country."""
    spread = rounded(F.col("temperature_max") - F.col("temperature_min"), 2)
    ties = tie_break or []
    return (
        weather.filter(F.col("country") == country)
        .select("date", spread.alias("temperature_diff"), *ties)
        .orderBy(F.desc("temperature_diff"), F.asc("date"), *[F.asc(c) for c in ties])
        .limit(n)
    )
