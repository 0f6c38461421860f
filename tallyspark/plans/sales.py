"""Sales totals: best days and the best publisher."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.numeric import exact_sum, rounded
from tallyspark.functions.temporal import within_years


def daily_totals(
    sales: DataFrame, day: str = "orderDate", price: str = "productPrice", count: str = "productCount"
) -> DataFrame:
    """Total price and item count per day; works on batches and streams alike."""
    return sales.groupBy(day).agg(
        exact_sum(f"{price} * {count}").alias("totalPrice"),
        F.sum(F.col(count).cast("bigint")).alias("totalCount"),
    )


def best_days(sales: DataFrame, n: int = 8, **columns) -> DataFrame:
    """The ``n`` days with the highest total price, best first."""
    day = columns.get("day", "orderDate")
    totals = daily_totals(sales, **columns).withColumnRenamed("totalPrice", "totalSales")
    return totals.select(day, "totalSales").orderBy(F.desc("totalSales"), F.asc(day)).limit(n)


def publisher_years(
    sales: DataFrame, first_year: int, last_year: int, publisher: str = "publisher",
    year: str = "year", region: str = "na_sales", world: str = "total_sales", released: str | None = None,
) -> DataFrame:
    """Per publisher and year: sums and the number of titles without regional sales.

    With the name of a timestamp column ``released`` the range of years is a
    range of that column, which lets the scan skip what is outside.
    """
    inside = F.col(year).between(first_year, last_year) if released is None else within_years(released, first_year, last_year)
    return (
        sales.filter(inside)
        .groupBy(publisher, year)
        .agg(
            exact_sum(region).alias("na_total"),
            exact_sum(world).alias("global_total"),
            F.count_if(F.col(region).isNull()).alias("missing_titles"),
        )
    )


def best_publisher_years(rollup: DataFrame, publisher: str = "publisher", year: str = "year") -> DataFrame:
    """Yearly rows of the publisher with the highest regional total.

    The years of a publisher (as many as the closed range has) travel as an
    array on its one total row. So the sales are read once, and the best
    publisher is found without a trip to the driver.
    """
    yearly = F.struct(year, "na_total", "global_total", "missing_titles")
    best = (
        rollup.groupBy(publisher)
        .agg(exact_sum("na_total").alias("na_all"), F.collect_list(yearly).alias("years"))
        .orderBy(F.desc_nulls_last("na_all"), F.asc(publisher))
        .limit(1)
    )
    return best.select(publisher, "na_all", F.explode("years").alias("y")).select(
        publisher,
        F.col(f"y.{year}").alias(year),
        rounded("y.na_total").alias("na_total"),
        rounded("y.global_total").alias("global_total"),
        F.col("y.missing_titles").alias("missing_titles"),
        "na_all",
    )


def missing_titles_of_best(rollup: DataFrame, publisher: str = "publisher") -> DataFrame:
    """The best publisher, its regional total and its titles without regional sales."""
    return (
        rollup.groupBy(publisher)
        .agg(exact_sum("na_total").alias("na_all"), F.sum("missing_titles").alias("missing_titles"))
        .orderBy(F.desc_nulls_last("na_all"), F.asc(publisher))
        .limit(1)
    )


def totals_best_first(sales: DataFrame, group: str, value: str, name: str) -> DataFrame:
    return sales.groupBy(group).agg(exact_sum(value).alias(name)).orderBy(F.desc(name), F.asc(group))
