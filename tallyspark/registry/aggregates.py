"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark import bindings as b
from tallyspark.functions.numeric import exact_sum, rounded
from tallyspark.plans import sales, weather
from tallyspark.registry.core import TOTAL_DIGITS, half_up, query, total_sum
from tallyspark.tables import table


@query(
    "row_counts_of_tables", "AG1",
    sql=" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in ("customer", "orders", "lineitem")
    ),
)
def row_counts_of_tables(spark, sf):
    from functools import reduce

    counts = [
        table(spark, sf, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n")
        for t in ("customer", "orders", "lineitem")
    ]
    return reduce(lambda a, c: a.union(c), counts)


@query(
    "global_extremes", "AG2",
    sql=f"""WITH {b.WEATHER_SQL} SELECT min(temperature_min) AS temperature_min,
            max(temperature_max) AS temperature_max FROM weather""",
)
def global_extremes(spark, sf):
    return weather.extremes(b.weather(spark, sf))


@query(
    "extremes_by_year", "AG3 SL1",
    sql=f"""WITH {b.WEATHER_SQL} SELECT year, min(temperature_min) AS temperature_min,
            max(temperature_max) AS temperature_max FROM weather GROUP BY year ORDER BY year DESC""",
)
def extremes_by_year(spark, sf):
    return weather.extremes_by_year(b.weather(spark, sf)).orderBy(F.desc("year"))


SUMMARY_SQL = f"""{b.WEATHER_SQL},
summary AS (
  SELECT year, country, count(*) AS entries, {half_up("min(temperature_min)", 1)} AS temperature_min,
         {half_up("max(temperature_max)", 1)} AS temperature_max,
         CAST({half_up("fsum(snow_depth) / count(*)", 0)} AS INTEGER) AS snow_depth_avg
  FROM weather GROUP BY year, country)"""


@query(
    "summary_by_year_and_country", "AG4 SL1 SC6",
    sql=f"WITH {SUMMARY_SQL} SELECT * FROM summary ORDER BY year DESC, country",
)
def summary_by_year_and_country(spark, sf):
    return weather.summary_by_year_and_country(b.weather(spark, sf)).orderBy(F.desc("year"), "country")


@query(
    "cold_days_by_year", "AG5 FLT1 FLT2",
    sql=f"""WITH {b.WEATHER_SQL} SELECT year, count(*) AS count FROM weather
            WHERE country = 'A' AND temperature_avg < -10 GROUP BY year""",
)
def cold_days_by_year(spark, sf):
    return weather.cold_days_by_year(b.weather(spark, sf), "A", -10)


@query(
    "warm_days_with_snow", "AG5",
    sql=f"""WITH {b.WEATHER_SQL} SELECT country, count(*) AS count FROM weather
            WHERE temperature_avg > 5 AND snow_depth > 100 GROUP BY country""",
)
def warm_days_with_snow(spark, sf):
    return weather.warm_days_with_snow(b.weather(spark, sf), 5, 100)


@query(
    "picked_values", "AG6 AG7",
    sql=f"""WITH {SUMMARY_SQL}
            SELECT max(CASE WHEN year = 1996 AND country = 'A' THEN temperature_min END) AS coldest,
                   max(CASE WHEN year = 1997 AND country = 'N' THEN temperature_max END) AS warmest,
                   max(CASE WHEN year = 1998 AND country = 'R' THEN temperature_max END)
                   - max(CASE WHEN year = 1998 AND country = 'R' THEN temperature_min END) AS spread,
                   CAST({half_up("avg(CASE WHEN year = 1995 THEN snow_depth_avg END)", 0)} AS INTEGER) AS mean_snow_depth
            FROM summary""",
)
def picked_values(spark, sf):
    summary = weather.summary_by_year_and_country(b.weather(spark, sf))
    return weather.picked_values(summary, (1996, "A"), (1997, "N"), (1998, "R"), 1995)


@query(
    "publisher_totals", "AG8 SL1",
    sql=f"""WITH {b.GAME_SALES_SQL} SELECT publisher, {total_sum("na_sales")} AS na_all FROM game_sales GROUP BY publisher""",
)
def publisher_totals(spark, sf):
    totals = sales.totals_best_first(b.game_sales(spark, sf), "publisher", "na_sales", "na_all")
    return totals.withColumn("na_all", rounded("na_all", TOTAL_DIGITS))


ROLLUP_SQL = f"""{b.GAME_SALES_SQL},
rollup_rows AS (
  SELECT publisher, year, fsum(na_sales) AS na_total,
         fsum(total_sales) AS global_total,
         count(*) FILTER (WHERE na_sales IS NULL) AS missing_titles
  FROM game_sales WHERE year BETWEEN 1996 AND 2000 GROUP BY publisher, year),
best AS (
  SELECT publisher, fsum(na_total) AS na_all FROM rollup_rows GROUP BY publisher
  ORDER BY na_all DESC NULLS LAST, publisher LIMIT 1)"""


@query(
    "best_publisher_years", "DP8 AG9 AG10",
    sql=f"""WITH {ROLLUP_SQL} SELECT publisher, year, {half_up("na_total", 2)} AS na_total,
            {half_up("global_total", 2)} AS global_total, missing_titles, {half_up("na_all", TOTAL_DIGITS)} AS na_all
            FROM rollup_rows JOIN best USING (publisher)""",
)
def best_publisher_years(spark, sf):
    years = sales.best_publisher_years(sales.publisher_years(b.game_sales(spark, sf), 1996, 2000, released="released"))
    return years.withColumn("na_all", rounded("na_all", TOTAL_DIGITS))


@query(
    "missing_titles_of_best", "DP8 AG9 AG11",
    sql=f"""WITH {ROLLUP_SQL} SELECT publisher, {half_up("any_value(na_all)", TOTAL_DIGITS)} AS na_all,
            CAST(sum(missing_titles) AS BIGINT) AS missing_titles
            FROM rollup_rows JOIN best USING (publisher) GROUP BY publisher""",
)
def missing_titles_of_best(spark, sf):
    best = sales.missing_titles_of_best(sales.publisher_years(b.game_sales(spark, sf), 1996, 2000, released="released"))
    return best.withColumn("na_all", rounded("na_all", TOTAL_DIGITS))


@query(
    "two_rounded_sums", "AG10",
    sql=f"""SELECT l_returnflag, {total_sum("l_extendedprice / l_quantity", 2)} AS price,
            {total_sum("l_quantity / 3", 2)} AS quantity FROM lineitem GROUP BY l_returnflag""",
)
def two_rounded_sums(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        rounded(exact_sum("l_extendedprice / l_quantity"), 2).alias("price"),
        rounded(exact_sum("l_quantity / 3"), 2).alias("quantity"),
    )


WIDE = "CASE l_suppkey % 3 WHEN 0 THEN l_extendedprice / 1e12 WHEN 1 THEN l_extendedprice * 1e12 ELSE l_extendedprice END / 7"


@query(
    "sums_of_all_sizes", "AG8 AG10",
    sql=f"""WITH totals AS (
              SELECT CAST(l_suppkey % 3 AS BIGINT) AS size, fsum({WIDE}) AS total FROM lineitem GROUP BY 1)
            SELECT size, {half_up("CASE size WHEN 0 THEN total * 1e12 WHEN 1 THEN total / 1e12 ELSE total END", 2)} AS total
            FROM totals""",
)
def sums_of_all_sizes(spark, sf):
    """Sums of values around 10^-8, 10^4 and 10^16, each brought back to one size."""
    size = (F.col("l_suppkey") % 3).cast("bigint").alias("size")
    totals = table(spark, sf, "lineitem").groupBy(size).agg(exact_sum(WIDE).alias("total"))
    scale = F.when(F.col("size") == 0, F.col("total") * 1e12).when(F.col("size") == 1, F.col("total") / 1e12)
    return totals.select("size", rounded(scale.otherwise(F.col("total")), 2).alias("total"))


@query(
    "conditional_sums", "AG12",
    sql="""SELECT l_suppkey, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned,
                  CAST(sum(CASE WHEN l_returnflag <> 'R' THEN l_linenumber ELSE 0 END) AS BIGINT) AS kept_numbers
           FROM lineitem GROUP BY l_suppkey""",
)
def conditional_sums(spark, sf):
    returned = F.col("l_returnflag") == "R"
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.sum(F.when(returned, 1).otherwise(0)).alias("returned"),
        F.sum(F.when(~returned, F.col("l_linenumber")).otherwise(0)).alias("kept_numbers"),
    )


@query(
    "arithmetic_over_aggregates", "AG13",
    sql="""SELECT l_suppkey, CAST(3 * count(*) FILTER (WHERE l_returnflag = 'A')
                  + count(*) FILTER (WHERE l_returnflag = 'N') AS BIGINT) AS points
           FROM lineitem GROUP BY l_suppkey""",
)
def arithmetic_over_aggregates(spark, sf):
    flag = F.col("l_returnflag")
    points = F.count_if(flag == "A") * 3 + F.count_if(flag == "N")
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(points.alias("points"))


@query("distinct_count", "AG20 ST3", sql="SELECT count(DISTINCT l_partkey) AS parts FROM lineitem")
def distinct_count(spark, sf):
    return table(spark, sf, "lineitem").agg(F.countDistinct("l_partkey").alias("parts"))


@query(
    "count_per_key", "AG21",
    sql="SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey",
)
def count_per_key(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))


@query(
    "argmin_per_group", "AG23",
    sql="""SELECT c_mktsegment, c_custkey, c_acctbal FROM customer
           QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) = 1""",
)
def argmin_per_group(spark, sf):
    from tallyspark.operators.ranking import top_n

    customers = table(spark, sf, "customer")
    lowest = top_n(customers, ["c_mktsegment"], [F.asc("c_acctbal"), F.asc("c_custkey")], 1)
    return lowest.select("c_mktsegment", "c_custkey", "c_acctbal")


@query(
    "sum_of_cubes", "AG24",
    sql="SELECT CAST(sum(CAST(l_linenumber AS BIGINT) * l_linenumber * l_linenumber) AS BIGINT) AS cubes FROM lineitem",
)
def sum_of_cubes(spark, sf):
    x = F.col("l_linenumber").cast("bigint")
    return table(spark, sf, "lineitem").agg(F.sum(x * x * x).alias("cubes"))


@query(
    "maximum_of_polynomial", "AG25",
    sql="SELECT CAST(max(1 + 9 * l_linenumber - l_linenumber * l_linenumber) AS INTEGER) AS highest FROM lineitem",
)
def maximum_of_polynomial(spark, sf):
    x = F.col("l_linenumber")
    return table(spark, sf, "lineitem").agg(F.max(1 + 9 * x - x * x).alias("highest"))


@query(
    "tokens_of_one_text", "AG29",
    sql="""SELECT token, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS token FROM benchmark)
           WHERE token <> '' GROUP BY token""",
)
def tokens_of_one_text(spark, sf):
    tokens = table(spark, sf, "benchmark").select(F.explode(F.split("text", " ")).alias("token"))
    return tokens.filter(F.col("token") != "").groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query(
    "reduce_to_grand_total", "AG19",
    sql=f"""SELECT {total_sum("daily", 2)} AS total FROM (
              SELECT {total_sum("value / 7", 2)} AS daily FROM events GROUP BY CAST(ts AS DATE))""",
)
def reduce_to_grand_total(spark, sf):
    daily = table(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(
        rounded(exact_sum("value / 7"), 2).alias("daily")
    )
    return daily.agg(rounded(exact_sum("daily"), 2).alias("total"))
