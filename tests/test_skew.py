"""One match and one word hold a third of all rows; joins are forced to shuffle."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from check import difference
from conftest import SMALL, rows
from tallyspark import bindings
from tallyspark.operators import keyed
from tallyspark.plans import football as fb
from tallyspark.plans import players as pl
from tallyspark.registry import REGISTRY

FORCED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
}


@pytest.fixture
def shuffling(spark):
    before = {k: spark.conf.get(k, None) for k in FORCED}
    for key, value in FORCED.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def hot_folder(spark, tmp_path_factory):
    """The small tables, but a third of all line items belongs to one order."""
    folder = str(tmp_path_factory.mktemp("hot"))
    import shutil

    for name in ("orders", "customer", "nation", "supplier", "part", "region", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        shutil.copy(f"{SMALL}/{name}.parquet", folder)
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    copies = lines.crossJoin(spark.range(5)).drop("id")
    hot = F.when(F.rand(3) < 0.34, F.lit(77).cast("bigint")).otherwise(F.col("l_orderkey"))
    copies.withColumn("l_orderkey", hot).repartition(12).write.parquet(f"{folder}/lineitem_parts")
    spark.read.parquet(f"{folder}/lineitem_parts").repartition(12).write.parquet(f"{folder}/lineitem.parquet")
    return folder


@pytest.fixture(scope="module")
def duck(hot_folder):
    import duckdb

    from check import TABLES

    connection = duckdb.connect()
    for name in TABLES:
        path = f"{hot_folder}/{name}.parquet" + ("/*.parquet" if name == "lineitem" else "")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


HOT = [
    "match_results", "season_table", "league_tables", "best_teams", "worst_passers", "minutes_played", "plus_minus",
    "goals_while_on_field", "left_join_zero_filled", "top_two_per_group", "count_per_key", "inner_join_two_keys",
    "cyclic_closeness", "absolute_and_cyclic_distance", "dimension_lookup", "longest_per_role",
]


@pytest.mark.parametrize("name", HOT)
def test_hot_match_gives_whole_results(shuffling, duck, hot_folder, name):
    df = REGISTRY[name].run(shuffling, hot_folder)
    assert difference(df, duck.sql(REGISTRY[name].sql)) is None


def test_hot_join_partition_is_split(shuffling, hot_folder):
    df = fb.match_results(bindings.match_events(shuffling, hot_folder))
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_goals_of_a_hot_match_fit_one_short_array(shuffling, hot_folder):
    goals = pl.goal_points(bindings.match_events(shuffling, hot_folder))
    from tallyspark.operators.joins import points_per_group

    sizes = points_per_group(goals, ["matchId"], "clock", "value").select("matchId", F.size("points"))
    assert goals.filter("matchId = 77").count() > 1500
    assert max(n for _, n in rows(sizes)) <= 100


def test_upsert_into_a_base_with_a_hot_key(shuffling):
    """A base may repeat a key; a third of it does, and all these rows are replaced by one."""
    random.seed(2)
    base = [("hot" if i % 3 == 0 else f"k{random.randrange(50)}", i) for i in range(3000)]
    schema = "key string, v int"
    merged = keyed.upsert(
        shuffling.createDataFrame(base, schema).repartition(9),
        shuffling.createDataFrame([("hot", -1), ("new", -2)], schema),
        ["key"],
    )
    counts = Counter(r.key for r in merged.collect())
    assert counts["hot"] == 1 and counts["new"] == 1
    assert sum(counts.values()) == sum(k != "hot" for k, _ in base) + 2
