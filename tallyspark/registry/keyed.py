"""Changes of a keyed table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.functions.numeric import exact_sum, fahrenheit_to_celsius, rounded
from tallyspark.operators import keyed
from tallyspark.registry.core import TOTAL_DIGITS, query, total_sum
from tallyspark.session import fresh_dir
from tallyspark.sinks.storage import row_counts
from tallyspark.sinks.writers import write_parquet
from tallyspark.sources.readers import read_parquet
from tallyspark.tables import table

NEW_KEYS_FROM = 1_000_000_000


def _accounts(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )


def _new_accounts(spark, sf):
    return table(spark, sf, "supplier").select(
        (F.lit(NEW_KEYS_FROM) + F.col("s_suppkey")).alias("key"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )


def _updates(spark, sf):
    """Customers with orders get their order total as balance; suppliers are new."""
    totals = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("key"))
        .agg(rounded(exact_sum("o_totalprice / 7"), TOTAL_DIGITS).alias("balance"))
        .select("key", F.lit("updated").alias("name"), "balance")
    )
    return totals.unionByName(_new_accounts(spark, sf))


KEYED_SQL = f"""base AS (SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance FROM customer),
new_rows AS (SELECT {NEW_KEYS_FROM} + s_suppkey AS key, s_name AS name, s_acctbal AS balance FROM supplier),
updates AS (
  SELECT o_custkey AS key, 'updated' AS name, {total_sum('o_totalprice / 7')} AS balance
  FROM orders GROUP BY o_custkey UNION ALL SELECT * FROM new_rows),
merged AS (
  SELECT * FROM base WHERE key NOT IN (SELECT key FROM updates) UNION ALL SELECT * FROM updates)"""


@query("append_rows", "KT1 ST1", sql=f"WITH {KEYED_SQL} SELECT * FROM base UNION ALL SELECT * FROM new_rows")
def append_rows(spark, sf):
    return keyed.append_rows(_accounts(spark, sf), _new_accounts(spark, sf))


@query(
    "append_changed_rows", "KT2 ST4",
    sql=f"""WITH {KEYED_SQL} SELECT * FROM base UNION ALL BY NAME
            SELECT key, name, 'supplier' AS kind, CAST(key - {NEW_KEYS_FROM} AS BIGINT) AS old_key FROM new_rows""",
)
def append_changed_rows(spark, sf):
    changed = _new_accounts(spark, sf).select(
        "key", "name", F.lit("supplier").alias("kind"), (F.col("key") - NEW_KEYS_FROM).alias("old_key")
    )
    return keyed.append_merged(_accounts(spark, sf), changed)


@query("upsert", "KT3 JN6", sql=f"WITH {KEYED_SQL} SELECT * FROM merged")
def upsert(spark, sf):
    return keyed.upsert(_accounts(spark, sf), _updates(spark, sf), ["key"])


@query(
    "anti_join", "JN6",
    sql="""SELECT c_custkey, c_name FROM customer
           WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""",
)
def anti_join(spark, sf):
    customer, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    without = customer.join(orders, customer.c_custkey == orders.o_custkey, "left_anti")
    return without.select("c_custkey", "c_name")


@query(
    "update_all_and_matching", "KT4 SC13",
    sql="""SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal,
                  CAST(round(CAST((c_custkey % 130 - 52) * 5.0 / 9 AS DECIMAL(30, 8)), 1) AS DOUBLE) AS celsius
           FROM customer""",
)
def update_all_and_matching(spark, sf):
    base = table(spark, sf, "customer").select(
        "c_custkey", "c_acctbal", (F.col("c_custkey") % 130 - 20).alias("fahrenheit"), F.lit(None).cast("double").alias("celsius")
    )
    filled = keyed.update_where(base, {"celsius": rounded(fahrenheit_to_celsius("fahrenheit"), 1)})
    return keyed.update_where(filled, {"c_acctbal": F.lit(0.0)}, F.col("c_acctbal") < 0).drop("fahrenheit")


@query(
    "delete_matching", "KT5",
    sql="""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price
           FROM orders WHERE NOT coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END < 100000, false)""",
)
def delete_matching(spark, sf):
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    base = table(spark, sf, "orders").select("o_orderkey", price.alias("price"))
    return keyed.delete_where(base, F.col("price") < 100000)


@query(
    "latest_per_key", "KT6",
    sql="""SELECT o_custkey, o_orderkey, o_totalprice FROM orders
           QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def latest_per_key(spark, sf):
    orders = table(spark, sf, "orders")
    newest = keyed.latest_per_key(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return newest.select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "counts_per_stage", "KT7 KT3 KT5",
    sql=f"""WITH {KEYED_SQL}
            SELECT 'before' AS stage, count(*) AS n_rows, 3 AS n_columns FROM base
            UNION ALL SELECT 'merged', count(*), 3 FROM merged
            UNION ALL SELECT 'deleted', count(*), 3 FROM merged WHERE NOT coalesce(balance < 1000, false)""",
)
def counts_per_stage(spark, sf):
    """Each stage is a written snapshot, so no stage is computed twice."""
    before = _accounts(spark, sf)
    merge = keyed.upsert(before, _updates(spark, sf), ["key"])
    merged = read_parquet(spark, write_parquet(merge, fresh_dir(spark, "merged")))
    deleted = keyed.delete_where(merged, F.col("balance") < 1000)
    return row_counts({"before": before, "merged": merged, "deleted": deleted})
