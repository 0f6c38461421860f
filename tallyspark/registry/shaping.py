"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark import bindings as b
from tallyspark.functions import numeric, temporal
from tallyspark.functions.temporal import within_years
from tallyspark.functions.words import NOT_BLANK, not_blank
from tallyspark.operators.profile import column_profile
from tallyspark.registry.core import half_up, query
from tallyspark.tables import table


def _count():
    return F.count(F.lit(1)).alias("n")


# --- projections -------------------------------------------------------------


@query(
    "rename_and_drop", "PRJ4 PRJ5",
    sql="SELECT c_custkey AS customer, c_name, c_nationkey, c_mktsegment AS segment FROM customer",
)
def rename_and_drop(spark, sf):
    renamed = table(spark, sf, "customer").withColumnsRenamed({"c_custkey": "customer", "c_mktsegment": "segment"})
    return renamed.drop("c_acctbal")


@query(
    "home_and_away_views", "PRJ2 ST1",
    sql=f"""WITH {b.MATCH_SQL} SELECT matchId, homeTeam AS team, awayTeam AS opponent, true AS at_home FROM match_list
            UNION ALL SELECT matchId, awayTeam, homeTeam, false FROM match_list""",
)
def home_and_away_views(spark, sf):
    matches = b.matches(spark, sf).select(
        "matchId", F.col("homeTeamData.team").alias("homeTeam"), F.col("awayTeamData.team").alias("awayTeam")
    )
    home = matches.select(
        "matchId", F.col("homeTeam").alias("team"), F.col("awayTeam").alias("opponent"), F.lit(True).alias("at_home")
    )
    away = matches.select(
        "matchId", F.col("awayTeam").alias("team"), F.col("homeTeam").alias("opponent"), F.lit(False).alias("at_home")
    )
    return home.union(away)


@query(
    "computed_and_constant_columns", "PRJ3 PRJ6 SC1",
    sql="""SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, 'store' AS channel,
                  o_totalprice * 2 AS doubled FROM orders""",
)
def computed_and_constant_columns(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").alias("year"),
        F.lit("store").alias("channel"),
        (F.col("o_totalprice") * 2).alias("doubled"),
    )


@query(
    "casts", "PRJ7",
    sql="""SELECT CAST(o_orderkey AS VARCHAR) AS key_text, CAST(trunc(o_totalprice) AS BIGINT) AS whole_price,
                  TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level,
                  TRY_CAST(o_orderpriority AS INTEGER) AS no_number,
                  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders""",
)
def casts(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_totalprice").cast("bigint").alias("whole_price"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("level"),
        F.col("o_orderpriority").try_cast("int").alias("no_number"),
        F.col("o_orderdate").cast("date").cast("string").alias("day"),
    )


PROFILED = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz", "o_orderpriority": "string", "regional": "double",
}


@query(
    "column_profile", "PRJ8",
    sql="WITH o AS (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS regional FROM orders) "
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS column_name, '{kind}' AS column_type, count(*) - count({name}) AS null_count,
            count(DISTINCT {name}) AS distinct_count FROM o"""
        for name, kind in PROFILED.items()
    ),
)
def profile(spark, sf):
    regional = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("regional")
    return column_profile(table(spark, sf, "orders").select("*", regional))


@query(
    "column_sums", "PRJ9",
    sql="""SELECT l_quantity + l_linenumber AS two_terms,
                  l_quantity + l_linenumber + l_tax
                    AS three_terms
           FROM lineitem""",
)
def column_sums(spark, sf):
    two = F.col("l_quantity") + F.col("l_linenumber")
    three = two + F.col("l_tax")
    return table(spark, sf, "lineitem").select(two.cast("double").alias("two_terms"), three.cast("double").alias("three_terms"))


# --- filters -----------------------------------------------------------------


@query(
    "filter_equal_and", "FLT1",
    sql="""SELECT o_orderkey, o_totalprice FROM orders
           WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'""",
)
def filter_equal_and(spark, sf):
    wanted = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "2-HIGH")
    return table(spark, sf, "orders").filter(wanted).select("o_orderkey", "o_totalprice")


@query(
    "filter_compare", "FLT2",
    sql="SELECT l_orderkey, l_quantity, l_discount FROM lineitem WHERE l_quantity > 45 AND l_discount < 0.02",
)
def filter_compare(spark, sf):
    wanted = (F.col("l_quantity") > 45) & (F.col("l_discount") < 0.02)
    return table(spark, sf, "lineitem").filter(wanted).select("l_orderkey", "l_quantity", "l_discount")


@query(
    "filter_closed_range", "FLT3",
    sql="SELECT o_orderkey FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 2000",
)
def filter_closed_range(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.filter(within_years("o_orderdate", 1996, 2000)).select("o_orderkey")


@query(
    "filter_is_null", "FLT4 AG11",
    sql=f"""WITH {b.GAME_SALES_SQL} SELECT publisher, count(*) AS missing FROM game_sales
            WHERE na_sales IS NULL GROUP BY publisher""",
)
def filter_is_null(spark, sf):
    missing = b.game_sales(spark, sf).filter(F.col("na_sales").isNull())
    return missing.groupBy("publisher").agg(F.count(F.lit(1)).alias("missing"))


@query(
    "filter_array_member", "FLT5",
    sql="""SELECT p_partkey, p_name FROM part WHERE list_contains(string_split(p_name, ' '), 'red')""",
)
def filter_array_member(spark, sf):
    parts = table(spark, sf, "part")
    return parts.filter(F.array_contains(F.split("p_name", " "), "red")).select("p_partkey", "p_name")


@query(
    "filter_regex", "FLT6",
    sql=f"""WITH {b.LINES_SQL} SELECT value, count(*) AS n FROM lines
            WHERE regexp_matches(value, '{NOT_BLANK}') AND regexp_matches(value, '^[a-zA-Z ]+$') GROUP BY value""",
)
def filter_regex(spark, sf):
    lines = b.lines_of_text(spark, sf)
    plain = lines.filter(not_blank("value") & F.col("value").rlike("^[a-zA-Z ]+$"))
    return plain.groupBy("value").agg(_count())


@query(
    "filter_string_tests", "FLT7",
    sql="""SELECT c_custkey, c_name FROM customer
           WHERE NOT contains(c_name, '99') AND (ends_with(c_name, '7') OR starts_with(c_mktsegment, 'B'))
             AND length(c_mktsegment) > 8""",
)
def filter_string_tests(spark, sf):
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    wanted = ~name.contains("99") & (name.endswith("7") | segment.startswith("B")) & (F.length(segment) > 8)
    return table(spark, sf, "customer").filter(wanted).select("c_custkey", "c_name")


def _gappy_orders(spark, sf):
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(status != "P", F.col("o_totalprice")).alias("price"),
        F.when(status != "F", F.col("o_orderpriority")).alias("priority"),
    )


GAPPY_SQL = """gappy AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price,
         CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS priority FROM orders)"""


@query(
    "drop_rows_with_any_null", "FLT8",
    sql=f"WITH {GAPPY_SQL} SELECT * FROM gappy WHERE price IS NOT NULL AND priority IS NOT NULL",
)
def drop_rows_with_any_null(spark, sf):
    return _gappy_orders(spark, sf).na.drop()


@query(
    "drop_rows_with_null_in_used", "FLT9",
    sql=f"WITH {GAPPY_SQL} SELECT * FROM gappy WHERE price IS NOT NULL",
)
def drop_rows_with_null_in_used(spark, sf):
    return _gappy_orders(spark, sf).na.drop(subset=["price"])


@query(
    "fill_null", "FLT10",
    sql=f"""WITH {GAPPY_SQL} SELECT o_orderkey, coalesce(price, 0.0) AS price,
            coalesce(priority, 'unknown') AS priority FROM gappy""",
)
def fill_null(spark, sf):
    return _gappy_orders(spark, sf).fillna({"price": 0.0, "priority": "unknown"})


@query(
    "filter_blank_lines", "FLT11",
    sql=f"""WITH {b.LINES_SQL} SELECT count(*) AS n FROM lines WHERE regexp_matches(value, '{NOT_BLANK}')""",
)
def filter_blank_lines(spark, sf):
    return b.lines_of_text(spark, sf).filter(not_blank("value")).agg(_count())


# --- scalar functions --------------------------------------------------------


@query(
    "dates_and_years", "SC1 SC2 SC3",
    sql="""SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
                  strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""",
)
def dates_and_years(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "dd.MM.yyyy").alias("text")
    )
    return orders.select(
        "o_orderkey",
        temporal.parsed_year("text", "dd.MM.yyyy").alias("year"),
        F.to_date(F.try_to_timestamp("text", F.lit("dd.MM.yyyy"))).cast("string").alias("day"),
    )


@query(
    "hour_buckets", "SC4 SC3",
    sql="""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour,
                  strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1, 2""",
)
def hour_buckets(spark, sf):
    hour = temporal.hour_of_millis("Time")
    series = b.power_series(spark, sf).groupBy(hour.alias("h")).agg(_count())
    return series.select(
        F.date_format("h", "yyyy-MM-dd HH:mm:ss").alias("hour"), F.to_date("h").cast("string").alias("day"), "n"
    )


@query(
    "month_and_hour_numbers", "SC5",
    sql="""SELECT CAST(month(l_shipdate) AS INTEGER) AS month,
                  CAST((l_linenumber * 3 + CAST(l_quantity AS INTEGER)) % 24 AS INTEGER) AS hour, count(*) AS n
           FROM lineitem GROUP BY 1, 2""",
)
def month_and_hour_numbers(spark, sf):
    minutes = b.energy_minutes(spark, sf)
    keys = [temporal.month_of_seconds("time").alias("month"), temporal.hour_number_of_seconds("time").alias("hour")]
    return minutes.groupBy(*keys).agg(_count())


@query(
    "rounding", "SC6",
    sql=f"""SELECT l_orderkey, {half_up("l_extendedprice", 1)} AS one, {half_up("l_extendedprice", 0)} AS whole,
            {half_up("l_discount", 1)} AS discount FROM lineitem""",
)
def rounding(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        numeric.rounded("l_extendedprice", 1).alias("one"),
        numeric.rounded("l_extendedprice", 0).alias("whole"),
        numeric.rounded("l_discount", 1).alias("discount"),
    )


@query(
    "floor_at_zero", "SC7",
    sql="SELECT c_custkey, greatest(c_acctbal, 0.0) AS balance FROM customer",
)
def floor_at_zero(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", numeric.floored("c_acctbal").alias("balance"))


@query(
    "text_building", "SC8 SC9 SC21",
    sql="""SELECT c_custkey, 'prefix-' || c_mktsegment || '_Z1' AS marked,
                  regexp_replace(c_name, '#0*', '-') AS short_name, substr(c_name, 1, 12) AS shown FROM customer""",
)
def text_building(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.concat(F.lit("prefix-"), "c_mktsegment", F.lit("_Z1")).alias("marked"),
        F.regexp_replace("c_name", "#0*", "-").alias("short_name"),
        F.substring("c_name", 1, 12).alias("shown"),
    )


@query(
    "delete_characters_and_lower", "SC10 SC11",
    sql="""SELECT conv_id, turn, md5(lower(translate(text, '.,!?:''', ''))) AS digest FROM conversations""",
)
def delete_characters_and_lower(spark, sf):
    cleaned = F.lower(F.translate("text", ".,!?:'", ""))
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", F.md5(cleaned.cast("binary")).alias("digest")
    )


@query(
    "split_and_explode", "SC12",
    sql="""SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(p_name, '\\s+')) AS word FROM part)
           GROUP BY word""",
)
def split_and_explode(spark, sf):
    words = table(spark, sf, "part").select(F.explode(F.split("p_name", r"\s+")).alias("word"))
    return words.groupBy("word").agg(_count())


@query(
    "temperature_units", "SC13",
    sql="SELECT c_custkey, (CAST(c_custkey % 130 - 20 AS DOUBLE) - 32) * 5 / 9 AS celsius FROM customer",
)
def temperature_units(spark, sf):
    fahrenheit = (F.col("c_custkey") % 130 - 20).cast("double")
    return table(spark, sf, "customer").select(
        "c_custkey", numeric.fahrenheit_to_celsius(fahrenheit).alias("celsius")
    )


@query(
    "signed_numbers", "SC14",
    sql="""SELECT c_custkey, CASE WHEN c_nationkey > 12 THEN '+' ELSE '' END || (c_nationkey - 12) AS difference
           FROM customer""",
)
def signed_numbers(spark, sf):
    difference = numeric.signed_text(F.col("c_nationkey") - 12)
    return table(spark, sf, "customer").select("c_custkey", difference.alias("difference"))


@query(
    "ratios", "SC15",
    sql="""SELECT l_orderkey, CASE WHEN l_discount = 0 THEN NULL ELSE l_tax / l_discount END AS ratio,
                  l_extendedprice / 1000 AS thousands FROM lineitem""",
)
def ratios(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.try_divide("l_tax", "l_discount").alias("ratio"),
        (F.col("l_extendedprice") / 1000).alias("thousands"),
    )


@query(
    "outcome_flags", "SC16",
    sql=f"""WITH {b.MATCH_EVENTS_SQL} SELECT matchId, CASE WHEN homeTeamGoals > awayTeamGoals THEN 1 ELSE 0 END AS win,
            CASE WHEN homeTeamGoals = awayTeamGoals THEN 1 ELSE 0 END AS draw,
            CASE WHEN homeTeamGoals < awayTeamGoals THEN 1 ELSE 0 END AS loss FROM match_results""",
)
def outcome_flags(spark, sf):
    from tallyspark.plans.football import match_results

    home, away = F.col("homeTeamGoals"), F.col("awayTeamGoals")
    return match_results(b.match_events(spark, sf)).select(
        "matchId",
        F.when(home > away, 1).otherwise(0).alias("win"),
        F.when(home == away, 1).otherwise(0).alias("draw"),
        F.when(home < away, 1).otherwise(0).alias("loss"),
    )


@query(
    "absolute_and_cyclic_distance", "SC17",
    sql="""SELECT l_orderkey, CAST(abs(month(l_shipdate) - month(o_orderdate)) AS INTEGER) AS direct,
                  CAST(least(abs(month(l_shipdate) - month(o_orderdate)),
                             12 - abs(month(l_shipdate) - month(o_orderdate))) AS INTEGER) AS cyclic
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def absolute_and_cyclic_distance(spark, sf):
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    a, c = F.month("l_shipdate"), F.month("o_orderdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", F.abs(a - c).alias("direct"), numeric.cyclic_distance(a, c, 12).alias("cyclic")
    )


@query(
    "seeded_column", "SC18",
    sql="""SELECT c_custkey, CAST(CAST(CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 1000 AS INTEGER) AS DOUBLE) / 10
           AS pseudo_random FROM customer""",
)
def seeded_column(spark, sf):
    """A made value per key with one decimal; unlike ``rand`` it survives re-runs."""
    from tallyspark.operators.sampling import hash_bucket

    value = hash_bucket("c_custkey", 1000).cast("double") / 10
    return table(spark, sf, "customer").select("c_custkey", value.alias("pseudo_random"))


@query(
    "fifth_roots", "SC19",
    sql=f"SELECT o_orderkey, {half_up('pow(o_totalprice, 0.2)', 6)} AS root FROM orders",
)
def fifth_roots(spark, sf):
    root = numeric.rounded(numeric.fifth_root("o_totalprice"), 6)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return orders.select("o_orderkey", root.alias("root"))


@query(
    "whole_minutes", "SC20",
    sql="SELECT l_orderkey, CAST(ceil(l_quantity * 57.5 / 60) AS INTEGER) AS minutes FROM lineitem",
)
def whole_minutes(spark, sf):
    seconds = F.col("l_quantity") * 57.5
    return table(spark, sf, "lineitem").select("l_orderkey", temporal.whole_minutes(seconds).alias("minutes"))
