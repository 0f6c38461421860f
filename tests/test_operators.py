from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import plan, rows
from tallyspark.session import shuffle_partitions_for
from tallyspark.operators import joins, keyed, profile, ranking, sampling

BASE = [("a", 49.0, None), ("b", 58.0, None), ("c", 48.0, None), ("x", 31.0, None), ("y", 31.0, None), ("z", 31.0, None)]
UPDATES = [("a", 63.6, None), ("b", 59.9, None), ("c", 13.5, None), ("d", 7.7, None), ("e", 85.4, None)]
SCHEMA = "ID string, F double, C double"


def test_upsert_update_delete_change_the_counts(frame):
    merged = keyed.upsert(frame(BASE, SCHEMA), frame(UPDATES, SCHEMA), ["ID"])
    assert merged.count() == 8
    celsius = F.round((F.col("F") - 32) * 5 / 9, 1)
    updated = keyed.update_where(merged, {"C": celsius})
    kept = keyed.delete_where(updated, F.col("C") < -12)
    assert kept.count() == 7
    got = {r.ID: r.C for r in kept.collect()}
    assert got == {"a": 17.6, "b": 15.5, "c": -10.3, "e": 29.7, "x": -0.6, "y": -0.6, "z": -0.6}


def test_upsert_rejects_duplicate_keys(frame):
    twice = frame([("a", 1.0, None), ("a", 2.0, None)], SCHEMA)
    with pytest.raises(PySparkException, match="two rows for one key"):
        keyed.upsert(frame(BASE, SCHEMA), twice, ["ID"]).collect()


def test_duplicate_check_survives_column_pruning(frame):
    twice = frame([("a", 1.0, None), ("a", 2.0, None)], SCHEMA)
    with pytest.raises(PySparkException, match="two rows for one key"):
        keyed.upsert(frame(BASE, SCHEMA), twice, ["ID"]).select("ID").collect()
    for use in (lambda df: df.count(), lambda df: df.select("F").collect(), lambda df: df.select(F.lit(1)).collect()):
        with pytest.raises(PySparkException, match="two rows for one key"):
            use(keyed.upsert(frame(BASE, SCHEMA), twice, ["ID"]))


def test_null_keys_match_nothing(frame):
    base = frame([(None, 1.0, None), ("a", 2.0, None)], SCHEMA)
    merged = keyed.upsert(base, frame([(None, 3.0, None), (None, 4.0, None), ("a", 5.0, None)], SCHEMA), ["ID"])
    assert rows(merged.select("ID", "F")) == [("a", 5.0), (None, 1.0), (None, 3.0), (None, 4.0)]


def test_upsert_into_and_from_nothing(frame, spark):
    none = spark.createDataFrame([], SCHEMA)
    assert keyed.upsert(none, frame(UPDATES, SCHEMA), ["ID"]).count() == 5
    assert rows(keyed.upsert(frame(BASE, SCHEMA), none, ["ID"])) == rows(frame(BASE, SCHEMA))


def test_upsert_keeps_null_values_of_updates(frame):
    merged = keyed.upsert(frame([("a", 1.0, 2.0)], SCHEMA), frame([("a", None, 3.0)], SCHEMA), ["ID"])
    assert rows(merged) == [("a", None, 3.0)]


def test_delete_keeps_rows_with_null_condition(frame):
    df = frame([(1, None), (2, -20.0), (3, 5.0)], "k int, c double")
    assert rows(keyed.delete_where(df, F.col("c") < -12)) == [(1, None), (3, 5.0)]


def test_conditional_update(frame):
    df = frame([(1, 1.0), (2, None), (3, 3.0)], "k int, c double")
    assert rows(keyed.update_where(df, {"c": F.lit(0.0)}, F.col("c") > 2)) == [(1, 1.0), (2, None), (3, 0.0)]


def test_append_merged_fills_with_null(frame):
    merged = keyed.append_merged(frame([(1, "a")], "k int, x string"), frame([(2, 5.0)], "k int, y double"))
    assert merged.columns == ["k", "x", "y"]
    assert rows(merged) == [(1, "a", None), (2, None, 5.0)]


def test_latest_per_key_breaks_ties(frame):
    df = frame([("a", 1, 10), ("a", 2, 11), ("a", 2, 12), ("b", 5, 13)], "k string, ts int, v int")
    latest = keyed.latest_per_key(df, ["k"], [F.desc("ts"), F.desc("v")])
    assert rows(latest) == [("a", 2, 12), ("b", 5, 13)]


def skewed(spark, n=3000):
    """A third of all rows belongs to one group; many equal values."""
    random.seed(3)
    data = [("hot" if i % 3 == 0 else f"g{random.randrange(40)}", random.randrange(50), i) for i in range(n)]
    return spark.createDataFrame(data, "g string, v int, id int").repartition(7)


def test_positions_equal_a_plain_window(spark):
    df = skewed(spark)
    order = [F.desc("v"), F.asc("id")]
    want = df.withColumn("p", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    got = ranking.positions(df, ["g"], order, "p")
    assert rows(got.select("g", "v", "id", "p")) == rows(want.select("g", "v", "id", "p"))


def test_positions_split_a_value_that_a_third_of_all_rows_has(spark):
    """All positions are given once, and no range holds the hot value alone."""
    data = [("hot", 7, i) if i % 3 == 0 else (f"g{i % 5}", i % 9, i) for i in range(6000)] + [(None, 1, -1)]
    df = spark.createDataFrame(data, "g string, v int, id int").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ranking.positions(df, ["g"], [F.desc("v")], "p").collect()
        ranges = df.repartitionByRange(F.col("g"), F.desc("v"), F.xxhash64("g", "v", "id"))
        sizes = ranges.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(r["count"] for r in sizes) < 2000
    per_group = {}
    for r in got:
        per_group.setdefault(r.g, []).append((r.p, r.v))
    for members in per_group.values():
        assert sorted(p for p, _ in members) == list(range(1, len(members) + 1))
        values = [v for _, v in sorted(members)]
        assert values == sorted(values, reverse=True)
    assert len(got) == 6001 and len(per_group[None]) == 1


def test_top_n_cuts_before_the_shuffle(spark):
    df = skewed(spark)
    best = ranking.top_n(df, ["g"], [F.desc("v"), F.asc("id")], 2)
    assert plan(best).count("WindowGroupLimit") == 2
    per_group = {}
    for g, v, i in sorted(((r.g, r.v, r.id) for r in df.collect()), key=lambda t: (t[0], -t[1], t[2])):
        per_group.setdefault(g, []).append((g, v, i))
    assert rows(best) == sorted(t for group in per_group.values() for t in group[:2])


@pytest.mark.parametrize("bounded", [False, True])
def test_share_of_total(frame, bounded):
    df = frame([("a", "x", 1), ("a", "y", 2), ("b", "x", 0), ("c", "x", 7)], "g string, name string, n int")
    shares = ranking.share_of_total(df, ["g"], "n", "share", bounded=bounded).select("g", "name", "share")
    assert rows(shares) == [("a", "x", 33.33), ("a", "y", 66.67), ("b", "x", None), ("c", "x", 100.0)]


@pytest.mark.parametrize("bounded", [False, True])
def test_share_of_total_keeps_rows_whose_group_is_null(frame, bounded):
    made = [("a", "p", 1), ("a", None, 3), (None, "p", 2), (None, None, 5), (None, None, 15), ("a", None, 1)]
    df = frame(made, "g string, h string, n int")
    shares = ranking.share_of_total(df, ["g", "h"], "n", "share", bounded=bounded).select("g", "h", "n", "share")
    want = [("a", "p", 1, 100.0), ("a", None, 3, 75.0), (None, "p", 2, 100.0), (None, None, 5, 25.0), (None, None, 15, 75.0), ("a", None, 1, 25.0)]
    assert sorted(rows(shares), key=repr) == sorted(want, key=repr)


def test_interval_sums_of_a_long_match_equal_plain_sums(spark):
    rng = random.Random(4)
    goals = [("m", rng.randrange(40_000), rng.randrange(-3, 4)) for _ in range(100_000)] + [("n", None, 9), ("m", None, 7), ("m", 5, None)]
    spans = [("m", *(rng.randrange(-5, 41_000) for _ in range(2))) for _ in range(2_000)]
    spans += [("m", 10, 10), ("m", 20, 10), ("m", None, 5), ("m", 5, None), ("n", 0, 9), ("none", 0, 9), ("m", -10, 99_999)]
    points = spark.createDataFrame(goals, "m string, at int, v int").repartition(5)
    intervals = spark.createDataFrame(spans, "m string, a int, b int").repartition(3)
    got = joins.sum_in_interval(intervals, points, ["m"], "at", "v", F.col("a"), F.col("b"), "total")
    score = [0] * 41_002
    for m, at, v in goals:
        if m == "m" and at is not None:
            score[at + 1] += v or 0
    for i in range(1, len(score)):
        score[i] += score[i - 1]
    upto = lambda x: score[min(max(x, 0), 41_001)]
    want = [(m, a, b, upto(b) - upto(a) if m == "m" and a is not None and b is not None and a < b else 0) for m, a, b in spans]
    assert sorted(rows(got.select("m", "a", "b", "total")), key=repr) == sorted(want, key=repr)


def test_top_names_order_ties_by_name(frame):
    df = frame([("a", "z", 5), ("a", "y", 5), ("a", "x", 9), ("a", "w", 1), ("b", "q", 1)], "g string, name string, n int")
    assert rows(ranking.top_names(df, ["g"], "name", "n", 3, "best")) == [("a", ["x", "y", "z"]), ("b", ["q"])]


def test_left_join_filled(frame):
    left = frame([(1, "a"), (2, "b")], "k int, x string")
    right = frame([(1, 3)], "k int, goals int")
    assert rows(joins.left_join_filled(left, right, ["k"], {"goals": 0})) == [(1, "a", 3), (2, "b", 0)]


def test_sum_in_interval_against_brute_force(spark):
    random.seed(11)
    spans = [(random.choice("hijk"), random.randrange(20), random.randrange(20), n) for n in range(200)]
    points = [("h" if i % 3 else random.choice("ijk"), random.randrange(20), random.choice([1, -1])) for i in range(500)]
    got = joins.sum_in_interval(
        spark.createDataFrame(spans, "m string, a int, b int, id int"),
        spark.createDataFrame(points, "m string, at int, v long").repartition(5),
        ["m"], "at", "v", F.col("a"), F.col("b"), "total",
    )
    want = sorted(
        (m, a, b, i, sum(v for pm, at, v in points if pm == m and a <= at < b)) for m, a, b, i in spans
    )
    assert rows(got) == want
    assert "NestedLoop" not in plan(got) and "CartesianProduct" not in plan(got)


def test_interval_without_points_sums_to_zero(spark):
    spans = spark.createDataFrame([("a", 0, 9)], "m string, a int, b int")
    points = spark.createDataFrame([], "m string, at int, v long")
    got = joins.sum_in_interval(spans, points, ["m"], "at", "v", F.col("a"), F.col("b"), "total")
    assert rows(got) == [("a", 0, 9, 0)]


def test_sample_by_suffix(frame):
    ids = [f"A-{i}{s}" for i in range(10, 16) for s in ("", "_Z1", "_Z2", "_Q")]
    sample = sampling.sample_by_suffix(frame([(i,) for i in ids], "ID string"), "ID", ["Z1", "Z2"], 2)
    assert rows(sample) == [("A-10", ""), ("A-10_Z1", "Z1"), ("A-10_Z2", "Z2"), ("A-11", ""), ("A-11_Z1", "Z1"), ("A-11_Z2", "Z2")]


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    train, test = sampling.split_by_key(df, "k")
    again, _ = sampling.split_by_key(df.repartition(13), "k")
    assert rows(train) == rows(again)
    assert train.count() + test.count() == 5000
    assert 0.77 < train.count() / 5000 < 0.83


def test_exact_split_of_classes_with_a_hot_key_and_nulls(spark):
    made = [(k % 700 if k % 3 else 7, ("a", "b", None)[k % 5 % 3], k) for k in range(3000)]
    made += [(None, "c", k) for k in range(9)] + [(1, "d", 0)] * 7
    df = spark.createDataFrame(made, "k int, c string, __n int").repartition(5)
    for percent in (0, 33, 80, 100):
        split = sampling.split_exactly(df, "k", percent, ["c"])
        assert split.columns == ["k", "c", "__n", "part"] and rows(split.drop("part")) == rows(df)
        sizes = {c: (n, t) for c, n, t in rows(split.groupBy("c").agg(F.count("*"), F.count_if(F.col("part") == "train")))}
        assert {c: t for c, (_, t) in sizes.items()} == {c: n * percent // 100 for c, (n, _) in sizes.items()}
        again = sampling.split_exactly(df.repartition(11), "k", percent, ["c"])
        assert rows(split) == rows(again)
    whole = sampling.split_exactly(df, "k", 50)
    assert whole.filter("part = 'train'").count() == 1508
    assert sampling.split_exactly(df.filter("1 = 0"), "k").count() == 0


def test_column_profile_counts_null_and_distinct(frame):
    df = frame([(1, "a", None), (2, "a", None), (2, None, None)], "k int, s string, d double")
    assert rows(profile.column_profile(df)) == [("d", "double", 3, 0), ("k", "int", 0, 2), ("s", "string", 1, 1)]


def test_shuffle_partitions_follow_the_input():
    gigabyte = 1 << 30
    assert shuffle_partitions_for(0, 8) == 8
    assert shuffle_partitions_for(16 * gigabyte, 8) == 128
    assert shuffle_partitions_for(100_000 * gigabyte, 2) == shuffle_partitions_for(100_000 * gigabyte, 4000) == 800_000


def test_queries_leave_the_shuffle_setting_alone(spark):
    import __spark_entry__ as entry_points

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        entry_points.queries()["count_per_key"](spark, "/root/testdata/sf0.001")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "13"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_zero_has_no_sign_in_a_profile(frame):
    assert rows(profile.column_profile(frame([(0.0,), (-0.0,), (1.5,)], "d double"))) == [("d", "double", 0, 2)]
