from __future__ import annotations

import random
import threading

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from conftest import rows
from tallyspark.learning import forests, levels, regression, scores
from tallyspark.learning.regression import assemble
from tallyspark.sources import schemas


@pytest.fixture(scope="module")
def points(spark):
    random.seed(2)
    made = [(x / 7, 1.5 * x / 7 - 0.1 + random.gauss(0, 0.3)) for x in range(80)]
    return spark.createDataFrame(made, schemas.POINTS)


def test_line_and_predictions(spark, points):
    model = regression.fit_line(points, ["X"])
    got = regression.line_parameters(spark, model).first()
    want = points.agg(F.regr_slope("label", "X"), F.regr_intercept("label", "X")).first()
    assert tuple(got) == pytest.approx(tuple(want), abs=6e-5)
    new = spark.createDataFrame([(-2.8,), (123.45,)], "X double")
    predicted = regression.predict(model, new, ["X"])
    assert predicted.columns == ["X", "prediction"]
    assert [r.prediction for r in predicted.orderBy("X").collect()] == pytest.approx([want[0] * x + want[1] for x in (-2.8, 123.45)])


def test_regression_scores_agree_with_the_evaluator(points):
    model = regression.fit_line(points, ["X"])
    predicted = regression.predict(model, points, ["X"])
    got = regression.regression_scores(predicted, "label", 8).first()
    for name in ("rmse", "mae", "r2"):
        want = RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName=name).evaluate(predicted)
        assert got[name] == pytest.approx(want, abs=1e-7)


def test_fit_series_has_every_point(points):
    part = F.when(F.col("X") < 8, "train").otherwise("test")
    series = regression.fit_series(regression.fit_line(points, ["X"]), points, part, "X", "label")
    assert series.columns == ["part", "x", "y", "prediction"] and series.count() == 80


def test_class_scores_on_a_circle(spark):
    pairs = [(1, 12), (1, 1), (1, 3), (12, 2), (6, 12), (5, 5)]
    chances = F.array(*[F.when(F.col("prediction") == i, 0.7).otherwise(0.025) for i in range(13)])
    made = spark.createDataFrame([(float(a), float(p)) for a, p in pairs], "label double, prediction double")
    made = made.withColumn("probability", array_to_vector(chances))
    assert rows(scores.closeness(made, "label", 12)) == [(6, 33.3333, 50.0, 83.3333)]
    evaluator = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    assert scores.accuracy(made, "label").first()[0] == pytest.approx(100 * evaluator.evaluate(made), abs=1e-4)
    mean = made.agg(scores.true_class_probability("label")).first()[0]
    assert mean == pytest.approx(100 * (2 * 0.7 + 4 * 0.025) / 6, abs=1e-4)


def test_unseen_class_has_probability_zero(spark):
    made = spark.createDataFrame([(5.0, [0.5, 0.5]), (1.0, [0.2, 0.8])], "label double, p array<double>")
    made = made.withColumn("probability", array_to_vector("p"))
    assert made.agg(scores.true_class_probability("label")).first()[0] == 40.0


@pytest.fixture(scope="module")
def minutes(spark):
    random.seed(8)
    made = []
    for i in range(1500):
        month = i % 12
        missing = None if i % 10 == 0 else 3.0 * month
        made.append((1704067200 + month * 2_629_800 + i, 10.0 * month, float(i % 7), missing, 1.0 * (i % 5), 2.0, 3.0, 0.5 * month))
    return forests.with_labels(spark.createDataFrame(made, schemas.ENERGY_MINUTES).repartition(4))


def test_cleaning_drops_as_few_rows_as_possible(minutes):
    weather, power = (next(c for c in forests.CASES if c.name == f"month from {k}") for k in ("weather", "power"))
    assert forests.clean(minutes, weather, ["time"]).count() == 1350
    assert forests.clean(minutes, power, ["time"]).count() == 1500


def test_cases():
    assert len(forests.CASES) == 8 and sum(c.regression for c in forests.CASES) == 2


def test_experiments_learn_what_can_be_learned(minutes):
    names = ("month from weather", "price from month")
    cases = [c for c in forests.CASES if c.name in names]
    result = {r["case"]: r for r in forests.run_cases(minutes, "time", cases, trees=6, depth=6).collect()}
    month, price = (result[n] for n in names)
    assert month.accuracy > 90 and month.one_away >= month.accuracy and month.two_away >= month.one_away
    assert month.train_accuracy > 90 and month.mean_probability > 30 and month.rmse is None
    assert price.r2 > 0.9 and price.accuracy is None
    assert 0 < month.n < 1350
    assert {r.error for r in result.values()} == {None}


def test_a_failing_case_does_not_lose_the_others(minutes):
    good = next(c for c in forests.CASES if c.name == "price from month")
    bad = forests.Case("broken", ("temperature",), "month")
    data = minutes.withColumn("temperature", F.col("temperature").cast("double"))
    result = {r["case"]: r for r in forests.run_cases(data.withColumn("month", F.col("month") + 0.5), "time", [good, bad], 2, 2).collect()}
    assert result["price from month"].error is None and result["price from month"].n > 0
    assert result["broken"].error and result["broken"].n is None
    with pytest.raises(Exception):  # noqa: B017 - the error of the only case
        forests.run_cases(data.withColumn("month", F.col("month") + 0.5), "time", [bad], 2, 2)


def test_tasks_run_at_once_with_the_properties_of_their_caller(spark):
    barrier = threading.Barrier(3, timeout=60)
    spark.sparkContext.setLocalProperty("mark", "of the caller")

    def task(name):
        def run():
            barrier.wait()  # passes only if all three run at the same time
            return [spark.sparkContext.getLocalProperty(p) for p in ("mark", "spark.scheduler.pool")]

        return run

    try:
        found = forests.side_by_side(spark, {n: task(n) for n in "abc"}, 3)
    finally:
        spark.sparkContext.setLocalProperty("mark", None)
    assert found == {n: ["of the caller", n] for n in "abc"}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_features_are_written_in_parts_that_tasks_can_share(spark, monkeypatch):
    monkeypatch.setattr(forests, "SPLIT_BYTES", 64 << 10)
    rows_in = spark.range(200_000).select(F.col("id").alias("time"), *[F.rand(i).alias(c) for i, c in enumerate(("temperature", "humidity", "wind_speed"))], F.lit(1).alias("month")).coalesce(1)
    table = forests.prepared(rows_in, "time", cases=[forests.Case("x", forests.WEATHER_INPUTS, "month")])
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1 << 20)
    try:
        sizes = [n for n in table.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect() if n]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(sizes) > 2 and sum(sizes) == 200_000


def test_alike_rows_are_counted_and_every_row_stays(spark):
    made = spark.createDataFrame([("a", 1), ("b", 7), ("c", 10)], "k string, n_alike bigint")
    got = {k: sorted(n for key, n in rows(forests.in_portions(made, 4)) if key == k) for k in "abc"}
    assert got == {"a": [1], "b": [1, 2, 2, 2], "c": [2, 2, 3, 3]}


def _many_minutes(spark, n=24_000):
    number = F.col("id")
    return spark.range(n).select(
        number.alias("time"),
        (number % 20).cast("double").alias("temperature"),
        (number % 3).cast("double").alias("humidity"),
        F.when(number % 10 != 0, (number % 7).cast("double")).alias("wind_speed"),
        (number % 20 % 12 + 1).alias("month"),
    )


def test_alike_rows_train_the_same_forest(spark, monkeypatch):
    case = next(c for c in forests.CASES if c.name == "month from weather")
    table = forests.prepared(_many_minutes(spark), "time", cases=[case])
    plain = forests.case_scores(forests.case_predictions(table, case, 20, 6)[1], case).first()
    monkeypatch.setattr(forests, "DRAWN_ROWS", 9_000)
    seen = []
    fit = forests.fit_forest
    monkeypatch.setattr(forests, "fit_forest", lambda train, *a, **k: seen.append((train.count(), train.agg(F.sum("n_alike")).first()[0])) or fit(train, *a, **k))
    model, predictions = forests.case_predictions(table, case, 20, 6)
    alike = forests.case_scores(predictions, case).first()
    train = forests.clean(table, case, ["is_test"]).filter("NOT is_test").count()
    assert len(seen) == 1 and seen[0][0] <= 9_000 < seen[0][1] == train  # all rows, in fewer
    assert predictions.count() == forests.clean(table, case, ["is_test"]).count() and model.getNumTrees == 20
    assert alike.n == plain.n and abs(alike.accuracy - plain.accuracy) < 5
    assert abs(alike.mean_probability - plain.mean_probability) < 5


def test_training_rows_are_dealt_in_parts_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(forests, "ROWS_PER_TASK", 1_000)
    case = next(c for c in forests.CASES if c.name == "month from weather")
    seen, fit = [], forests.fit_forest
    monkeypatch.setattr(forests, "fit_forest", lambda train, *a, **k: seen.append(train.rdd.getNumPartitions()) or fit(train, *a, **k))
    table = forests.prepared(_many_minutes(spark), "time", cases=[case])
    forests.case_predictions(table, case, 2, 2)
    assert seen == [22]  # 21,600 rows


@pytest.mark.parametrize("most, at_once", [(40_000_000, 2), (1_500, 1)])
def test_cases_train_at_once_as_far_as_their_rows_fit(minutes, monkeypatch, most, at_once):
    monkeypatch.setattr(forests, "ROWS_AT_ONCE", most)
    seen, beside = [], forests.side_by_side
    monkeypatch.setattr(forests, "side_by_side", lambda spark, tasks, n: seen.append(n) or beside(spark, tasks, n))
    cases = [c for c in forests.CASES if c.name in ("month from weather", "price from month")]
    assert forests.run_cases(minutes, "time", cases, trees=2, depth=2).count() == 2 and seen == [at_once]


def _odd_minutes(spark, n=6_000):
    """Inputs of few values; the label follows two of them, with noise."""
    number = F.xxhash64("id")
    part = lambda shift, of: F.pmod(F.shiftrightunsigned(number, shift), F.lit(of))
    made = spark.range(n).select(
        F.col("id").alias("time"),
        part(3, 20).cast("double").alias("temperature"),
        (part(9, 11) * 1.5).alias("humidity"),
        F.when(F.col("id") % 10 != 0, part(15, 9).cast("double")).alias("wind_speed"),
        part(21, 5).alias("noise"),
    )
    month = F.pmod(F.col("temperature") * 2 + F.col("humidity") + F.col("noise"), F.lit(12)).cast("bigint") + 1
    return made.select("*", month.alias("month"), (month * 0.3 + F.col("noise") / 7 + F.col("temperature")).alias(forests.PRICE))


@pytest.mark.parametrize("regression", [False, True])
def test_one_tree_over_packed_rows_is_the_tree_of_spark(spark, regression):
    label = forests.PRICE if regression else "month"
    case = forests.Case("x", forests.WEATHER_INPUTS, label, regression)
    rows_in = forests.clean(_odd_minutes(spark), case, ["time"]).repartition(3)
    kind = RandomForestRegressor if regression else RandomForestClassifier
    forest = kind(featuresCol="features", labelCol=label, numTrees=1, maxDepth=4, bootstrap=False)
    theirs = forests.forest_predictions(forest.fit(assemble(rows_in, list(case.inputs))), rows_in, case)
    model = levels.fit(rows_in, list(case.inputs), label, regression, 1, 4, bootstrap=False)
    mine = model.transform(rows_in)
    want = {r["time"]: r["prediction"] for r in theirs.select("time", "prediction").collect()}
    got = {r["time"]: r["prediction"] for r in mine.select("time", "prediction").collect()}
    assert len(got) == 5_400 and got == pytest.approx(want)
    assert len(set(want.values())) > 4 and model.getNumTrees == 1
    # Every row is in the leaves, none twice.
    assert (model.leaves[..., 0] if regression else model.leaves.sum(-1)).sum() == 5_400


@pytest.mark.parametrize("name", ["month from weather", "price from month"])
def test_forests_of_many_rows_score_as_those_of_spark_without_its_trainer(spark, monkeypatch, name):
    case = next(c for c in forests.CASES if c.name == name)
    case = forests.Case(name, (*forests.WEATHER_INPUTS, *(["month"] if case.regression else [])), case.label, case.regression)
    table = _odd_minutes(spark)
    plain = forests.run_cases(table, "time", [case], trees=40).first()
    monkeypatch.setattr(forests, "PACKED_ROWS", 1_000)

    def never(*_, **__):
        raise AssertionError("keeps every row with a number for each tree")

    monkeypatch.setattr(forests, "fit_forest", never)
    packed = forests.run_cases(table, "time", [case], trees=40).first()
    assert packed.error is None and packed.n == plain.n
    if case.regression:
        assert packed.r2 == pytest.approx(plain.r2, abs=0.03) and packed.mae == pytest.approx(plain.mae, rel=0.1)
    else:
        assert packed.accuracy == pytest.approx(plain.accuracy, abs=3) and plain.accuracy > 12
        assert packed.mean_probability == pytest.approx(plain.mean_probability, abs=1)


def test_a_row_is_drawn_once_on_average_and_the_same_in_every_pass():
    drawn = levels.weights(1, 5, 7, 200_000)
    assert (drawn == levels.weights(1, 5, 7, 200_000)).all() and not (drawn == levels.weights(1, 5, 8, 200_000)).all()
    assert abs(drawn.mean() - 1) < 0.02 and abs(drawn.var() - 1) < 0.02


def test_packed_rows_want_labels_that_number_classes(spark):
    made = spark.createDataFrame([(1.0, 0.5), (2.0, 1.0)], "a double, month double")
    with pytest.raises(ValueError, match="whole numbers"):
        levels.fit(made, ["a"], "month", False, 2, 2)
