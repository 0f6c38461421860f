"""Hourly energy, its cost, and daily tables, from a sparse power series."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.numeric import exact_mean, exact_sum, floored, rounded
from tallyspark.functions.temporal import hour_of_millis


def hourly_balance(
    series: DataFrame,
    time: str = "Time",
    produced: str = "SolarPower",
    consumed: tuple[str, ...] = ("WaterCooling01Power", "WaterCooling02Power", "VentilationPower"),
    price: str = "ElectricityPrice",
    temperature: str = "Temperature",
) -> DataFrame:
    """Mean temperature, produced and consumed kWh, and the price of each hour.

    ``time`` is epoch milliseconds; hours follow the session time zone. Means
    skip NULL. An hour without any value of a consumer has no consumption. The
    price is the first non-NULL one of the hour. All buffers are numbers, so
    the partial aggregation is a hash aggregation and the shuffle carries one
    row per hour and map task.
    """
    kilo = F.lit(1000)
    used = reduce(add, [exact_mean(c) for c in consumed])
    priced_at = F.when(F.col(price).isNotNull(), F.col(time))
    return series.groupBy(hour_of_millis(time).alias("Time")).agg(
        exact_mean(temperature).alias("AvgTemperature"),
        (exact_mean(produced) / kilo).alias("ProducedEnergy"),
        (used / kilo).alias("ConsumedEnergy"),
        F.min_by(price, priced_at).alias("Price"),
    )


def hourly_cost(hourly: DataFrame, floor_at_zero: bool = False) -> DataFrame:
    """Cost in EUR of the energy bought in the hour, price in EUR per MWh."""
    bought = F.col("ConsumedEnergy") - F.col("ProducedEnergy")
    cost = bought * F.col("Price") / F.lit(1000)
    return hourly.withColumn("HourlyCost", floored(cost) if floor_at_zero else cost)


def daily_table(costs: DataFrame) -> DataFrame:
    """Mean temperature and sums per day, two decimals."""

    def total(c):
        return rounded(exact_sum(c), 2)

    return costs.groupBy(F.to_date("Time").alias("Date")).agg(
        rounded(exact_mean("AvgTemperature"), 2).alias("Temperature"),
        total("ProducedEnergy").alias("ProducedEnergy"),
        total("ConsumedEnergy").alias("ConsumedEnergy"),
        total("HourlyCost").alias("DailyCost"),
    )


def total_cost(daily: DataFrame) -> DataFrame:
    return daily.agg(rounded(exact_sum("DailyCost"), 2).alias("TotalCost"))
