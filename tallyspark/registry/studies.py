"""Energy costs and best selling days."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark import bindings as b
from tallyspark.functions.numeric import rounded
from tallyspark.plans import energy, sales
from tallyspark.registry.core import TOTAL_DIGITS, half_up, query, total_sum

def _mean(kind: str, and_only: str = "true") -> str:
    only = f"CASE WHEN event_type = '{kind}' AND {and_only} THEN value / 7 END"
    return f"fsum({only}) / nullif(count({only}), 0)"


ENERGY_SQL = f"""hourly AS (
  SELECT date_trunc('hour', ts) AS t, {_mean("signup")} AS AvgTemperature,
         {_mean("click")} / 1000 AS ProducedEnergy,
         ({_mean("view", "event_id % 2 = 0")} + {_mean("purchase")} + {_mean("view", "event_id % 2 = 1")}) / 1000
           AS ConsumedEnergy,
         arg_min(value / 7, epoch_ms(ts)) FILTER (WHERE event_type = 'error') AS Price
  FROM events GROUP BY 1),
costs AS (
  SELECT *, (ConsumedEnergy - ProducedEnergy) * Price / 1000 AS HourlyCost FROM hourly),
daily AS (
  SELECT strftime(t, '%Y-%m-%d') AS Date,
         {half_up("fsum(AvgTemperature) / count(AvgTemperature)", 2)} AS Temperature,
         {total_sum("ProducedEnergy", 2)} AS ProducedEnergy,
         {total_sum("ConsumedEnergy", 2)} AS ConsumedEnergy,
         {total_sum("HourlyCost", 2)} AS DailyCost
  FROM costs GROUP BY 1)"""


def _hourly(spark, sf):
    return energy.hourly_balance(b.power_series(spark, sf))


# Hourly means and costs are small numbers.
MEAN_DIGITS = 10


def _comparable(df, *names, digits=MEAN_DIGITS):
    """Means and costs are equal in both engines up to the last bits."""
    return df.withColumns({n: rounded(n, digits) for n in names})


def _comparable_sql(*names):
    return ", ".join(f"{half_up(n, MEAN_DIGITS)} AS {n}" for n in names)


@query(
    "hourly_energy", "AG16 AG17 SC4",
    sql=f"""WITH {ENERGY_SQL} SELECT strftime(t, '%Y-%m-%d %H:%M:%S') AS Time,
            {_comparable_sql("AvgTemperature", "ProducedEnergy", "ConsumedEnergy")}, Price FROM hourly""",
)
def hourly_energy(spark, sf):
    hourly = _comparable(_hourly(spark, sf), "AvgTemperature", "ProducedEnergy", "ConsumedEnergy")
    return hourly.withColumn("Time", F.date_format("Time", "yyyy-MM-dd HH:mm:ss"))


@query(
    "hourly_cost", "DP7 SC7 SC15 PRJ3",
    sql=f"""WITH {ENERGY_SQL} SELECT strftime(t, '%Y-%m-%d %H:%M:%S') AS Time,
            {half_up("HourlyCost", MEAN_DIGITS)} AS HourlyCost,
            {half_up("CASE WHEN HourlyCost IS NOT NULL THEN greatest(HourlyCost, 0.0) END", MEAN_DIGITS)} AS FlooredCost
            FROM costs""",
)
def hourly_cost(spark, sf):
    hourly = _hourly(spark, sf)
    plain = energy.hourly_cost(hourly)
    floored = energy.hourly_cost(plain.withColumnRenamed("HourlyCost", "PlainCost"), floor_at_zero=True)
    return floored.select(
        F.date_format("Time", "yyyy-MM-dd HH:mm:ss").alias("Time"),
        rounded("PlainCost", MEAN_DIGITS).alias("HourlyCost"),
        rounded("HourlyCost", MEAN_DIGITS).alias("FlooredCost"),
    )


@query("daily_energy", "DP7 AG18 SC3", sql=f"WITH {ENERGY_SQL} SELECT * FROM daily ORDER BY Date")
def daily_energy(spark, sf):
    daily = energy.daily_table(energy.hourly_cost(_hourly(spark, sf)))
    return daily.withColumn("Date", F.col("Date").cast("string")).orderBy("Date")


@query(
    "total_energy_cost", "DP7 AG19",
    sql=f"WITH {ENERGY_SQL} SELECT {total_sum('DailyCost', 2)} AS TotalCost FROM daily",
)
def total_energy_cost(spark, sf):
    return energy.total_cost(energy.daily_table(energy.hourly_cost(_hourly(spark, sf))))


DAILY_SALES_SQL = f"""{b.SALES_SQL},
daily_sales AS (
  SELECT orderDate, {total_sum("productPrice * productCount")} AS totalPrice,
         CAST(sum(productCount) AS BIGINT) AS totalCount FROM sales GROUP BY orderDate)"""


@query("daily_sales", "DP9 AG8 PRJ3", sql=f"WITH {DAILY_SALES_SQL} SELECT * FROM daily_sales")
def daily_sales(spark, sf):
    return _comparable(sales.daily_totals(b.sales(spark, sf)), "totalPrice", digits=TOTAL_DIGITS)


@query(
    "best_days", "DP9 SL2",
    sql=f"""WITH {DAILY_SALES_SQL} SELECT orderDate, totalPrice AS totalSales FROM daily_sales
            ORDER BY totalSales DESC, orderDate LIMIT 8""",
)
def best_days(spark, sf):
    return _comparable(sales.best_days(b.sales(spark, sf), 8), "totalSales", digits=TOTAL_DIGITS)
