"""Windows, sorts, samples, sets and joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark import bindings as b
from tallyspark.operators import joins, ranking, sampling
from tallyspark.plans import schema_change, weather
from tallyspark.registry.core import half_up, query
from tallyspark.tables import table

# --- windows -----------------------------------------------------------------


@query(
    "positions_in_group", "WN1",
    sql="""SELECT c_nationkey, c_custkey, CAST(row_number() OVER (
             PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS INTEGER) AS place
           FROM customer""",
)
def positions_in_group(spark, sf):
    order = [F.desc("c_acctbal"), F.asc("c_custkey")]
    ranked = ranking.positions(table(spark, sf, "customer"), ["c_nationkey"], order, "place")
    return ranked.select("c_nationkey", "c_custkey", "place")


@query(
    "top_two_per_group", "WN2",
    sql="""SELECT l_suppkey, l_orderkey, l_partkey, l_extendedprice, CAST(row_number() OVER w AS INTEGER) AS place
           FROM lineitem
           WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_partkey)
           QUALIFY row_number() OVER w <= 2""",
)
def top_two_per_group(spark, sf):
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_partkey")]
    best = ranking.top_n(table(spark, sf, "lineitem"), ["l_suppkey"], order, 2, position="place")
    return best.select("l_suppkey", "l_orderkey", "l_partkey", "l_extendedprice", "place")


@query(
    "best_row_per_role", "WN3",
    sql="""SELECT p_brand, p_partkey, p_retailprice FROM part
           QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) = 1""",
)
def best_row_per_role(spark, sf):
    best = ranking.top_n(table(spark, sf, "part"), ["p_brand"], [F.desc("p_retailprice"), F.asc("p_partkey")], 1)
    return best.select("p_brand", "p_partkey", "p_retailprice")


EVENT_COUNTS_SQL = """event_counts AS (
  SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type)"""


def _event_counts(spark, sf):
    return table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "ordered_top_names", "WN4",
    sql=f"""WITH {EVENT_COUNTS_SQL}, placed AS (
              SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS place FROM event_counts)
            SELECT user_id, string_agg(event_type, '-' ORDER BY place) AS best FROM placed WHERE place <= 3
            GROUP BY user_id""",
)
def ordered_top_names(spark, sf):
    named = ranking.top_names(_event_counts(spark, sf), ["user_id"], "event_type", "n", 3, "best")
    return named.select("user_id", F.array_join("best", "-").alias("best"))


@query(
    "share_of_total", "WN5",
    sql=f"""WITH {EVENT_COUNTS_SQL} SELECT user_id, event_type, n,
            {half_up("100.0 * n / sum(n) OVER (PARTITION BY user_id)", 2)} AS share FROM event_counts""",
)
def share_of_total(spark, sf):
    return ranking.share_of_total(_event_counts(spark, sf), ["user_id"], "n", "share")


# --- sorts, limits, samples --------------------------------------------------


@query(
    "sort_mixed", "SL1",
    sql="SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority DESC, o_totalprice, o_orderkey",
)
def sort_mixed(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return orders.orderBy(F.desc("o_orderpriority"), F.asc("o_totalprice"), F.asc("o_orderkey"))


@query(
    "widest_days", "SL2",
    sql=f"""WITH {b.WEATHER_SQL} SELECT CAST(date AS VARCHAR) AS date,
            {half_up("temperature_max - temperature_min", 2)} AS temperature_diff FROM weather
            WHERE country = 'R' ORDER BY temperature_diff DESC, date LIMIT 10""",
)
def widest_days(spark, sf):
    widest = weather.widest_days(b.weather(spark, sf), "R", 10)
    return widest.withColumn("date", F.col("date").cast("string"))


@query("first_rows", "SL3", sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 7")
def first_rows(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(7)


@query(
    "last_rows", "SL4",
    sql="SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 6",
)
def last_rows(spark, sf):
    picked = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return picked.orderBy(F.desc("o_orderkey")).limit(6)


@query(
    "latest_rows", "SL5 FLT1",
    sql=f"""WITH {b.ACCIDENTS_SQL} SELECT ID, Start_Time, Temperature_F FROM accidents WHERE City = 'F'
            ORDER BY Start_Time DESC, ID DESC LIMIT 73""",
)
def latest_rows(spark, sf):
    latest = schema_change.latest_rows(b.accidents(spark, sf), "F", 73)
    return latest.select("ID", F.date_format("Start_Time", "yyyy-MM-dd HH:mm:ss").alias("Start_Time"), "Temperature_F")


MARKED_IDS_SQL = """marked AS (
  SELECT 'A-' || o_orderkey || CASE o_orderstatus WHEN 'F' THEN '_Z1' WHEN 'O' THEN '_Z2' ELSE '' END AS id,
         o_totalprice FROM orders),
classed AS (
  SELECT *, CASE WHEN NOT contains(id, '_') THEN '' WHEN ends_with(id, 'Z1') THEN 'Z1' ELSE 'Z2' END AS sample_class
  FROM marked)"""


@query(
    "sample_by_suffix", "SL6 ST2 FLT7",
    sql=f"""WITH {MARKED_IDS_SQL} SELECT id, o_totalprice, sample_class FROM classed
            QUALIFY row_number() OVER (PARTITION BY sample_class ORDER BY id) <= 4""",
)
def sample_by_suffix(spark, sf):
    mark = F.when(F.col("o_orderstatus") == "F", "_Z1").when(F.col("o_orderstatus") == "O", "_Z2").otherwise("")
    ident = F.concat(F.lit("A-"), F.col("o_orderkey").cast("string"), mark)
    orders = table(spark, sf, "orders").select(ident.alias("id"), "o_totalprice")
    return sampling.sample_by_suffix(orders, "id", ["Z1", "Z2"], 4)


@query(
    "split_by_key", "SL7",
    sql="""SELECT o_orderkey, CASE WHEN CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80
                  THEN 'train' ELSE 'test' END AS part FROM orders""",
)
def split_by_key(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", sampling.part_by_key("o_orderkey", 80).alias("part"))


@query(
    "split_exactly", "SL7",
    sql="""WITH hashed AS (
             SELECT o_orderkey, o_orderstatus, CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) AS h
             FROM orders)
           SELECT o_orderkey, o_orderstatus,
                  CASE WHEN row_number() OVER (PARTITION BY o_orderstatus ORDER BY h, o_orderkey)
                            <= count(*) OVER (PARTITION BY o_orderstatus) * 80 // 100
                       THEN 'train' ELSE 'test' END AS part FROM hashed""",
)
def split_exactly(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.split_exactly(orders, "o_orderkey", 80, ["o_orderstatus"])


@query("random_split_sizes", "SL7", sql="SELECT count(*) AS n, true AS both_filled FROM orders")
def random_split_sizes(spark, sf):
    train, test = table(spark, sf, "orders").randomSplit([0.8, 0.2], seed=1)
    parts = train.select(F.lit(1).alias("in_train")).unionAll(test.select(F.lit(0).alias("in_train")))
    filled = (F.max("in_train") == 1) & (F.min("in_train") == 0)
    return parts.agg(F.count(F.lit(1)).alias("n"), filled.alias("both_filled"))


# --- sets --------------------------------------------------------------------


@query(
    "union_positional", "ST1",
    sql="SELECT c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def union_positional(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    return customers.union(table(spark, sf, "supplier").select("s_suppkey", "s_name"))


@query(
    "union_by_fold", "ST2",
    sql="""SELECT c_nationkey AS nation FROM customer UNION ALL SELECT s_nationkey FROM supplier
           UNION ALL SELECT n_nationkey FROM nation""",
)
def union_by_fold(spark, sf):
    parts = [("customer", "c_nationkey"), ("supplier", "s_nationkey"), ("nation", "n_nationkey")]
    return reduce(DataFrame.union, [table(spark, sf, t).select(F.col(c).alias("nation")) for t, c in parts])


@query("distinct_rows", "ST3", sql="SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(spark, sf):
    return table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag").distinct()


@query(
    "union_missing_columns", "ST4",
    sql="""SELECT p_partkey AS key, p_name AS name, p_size AS size, NULL::DOUBLE AS balance FROM part
           UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
)
def union_missing_columns(spark, sf):
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("key"), F.col("p_name").alias("name"), F.col("p_size").alias("size")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("key")
    )
    return parts.unionByName(suppliers, allowMissingColumns=True)


# --- joins -------------------------------------------------------------------


@query(
    "left_join_zero_filled", "JN1 ST3 AG12",
    sql=f"WITH {b.MATCH_EVENTS_SQL} SELECT * FROM match_results",
)
def left_join_zero_filled(spark, sf):
    """All matches, left joined with the goals of those that had any."""
    from tallyspark.plans import football

    events = b.match_events(spark, sf)
    matches = events.select(*football.MATCH_KEYS).distinct()
    goals = football.match_results(events.filter(football.is_goal()))
    return joins.left_join_filled(matches, goals, football.MATCH_KEYS, {"homeTeamGoals": 0, "awayTeamGoals": 0})


@query(
    "inner_join_two_keys", "JN2",
    sql="""SELECT l_partkey, l_suppkey, a.n, z.largest FROM
             (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL) a
           JOIN (SELECT l_partkey, l_suppkey, max(l_quantity) AS largest FROM lineitem
                 WHERE l_returnflag = 'R' GROUP BY ALL) z USING (l_partkey, l_suppkey)""",
)
def inner_join_two_keys(spark, sf):
    keys = ["l_partkey", "l_suppkey"]
    lines = table(spark, sf, "lineitem")
    counts = lines.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    largest = lines.filter(F.col("l_returnflag") == "R").groupBy(*keys).agg(F.max("l_quantity").alias("largest"))
    return counts.join(largest, keys)


@query(
    "dimension_lookup", "JN5",
    sql="""SELECT l_partkey, p_name, p_brand, n FROM
             (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey) JOIN part ON l_partkey = p_partkey""",
)
def dimension_lookup(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    parts = table(spark, sf, "part").withColumnRenamed("p_partkey", "l_partkey")
    return joins.lookup(counts, parts, ["l_partkey"], ["p_name", "p_brand"])
