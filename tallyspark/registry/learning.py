"""Regression and classification."""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyspark import bindings as b
from tallyspark.functions.numeric import rounded
from tallyspark.learning import forests, regression, scores
from tallyspark.operators.sampling import part_by_key, split_by_key
from tallyspark.registry.core import half_up, query
from tallyspark.session import written

BUCKET = "CAST('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 100"
LINE_SQL = f"""points AS (
  SELECT l_quantity AS x, l_extendedprice AS y, {BUCKET} < 80 AS train FROM lineitem),
line AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM points WHERE train)"""


def _parts(spark, sf):
    return split_by_key(b.line_points(spark, sf), "key", 80)


@query(
    "assembled_features", "ML1",
    sql="""SELECT l_orderkey AS key, l_quantity AS first, l_extendedprice AS second, 2 AS size FROM lineitem""",
)
def assembled_features(spark, sf):
    vectors = regression.assemble(b.line_points(spark, sf), ["X", "label"])
    values = vector_to_array("features")
    return vectors.select("key", values[0].alias("first"), values[1].alias("second"), F.size(values).alias("size"))


@query(
    "line_parameters", "ML2 SL7",
    sql=f"WITH {LINE_SQL} SELECT {half_up('slope', 4)} AS slope, {half_up('intercept', 4)} AS intercept FROM line",
)
def line_parameters(spark, sf):
    train, _ = _parts(spark, sf)
    return regression.line_parameters(spark, regression.fit_line(train, ["X"]))


@query(
    "predictions_for_new_values", "ML3 SRC2",
    sql=f"""WITH {LINE_SQL} SELECT v.x AS "X", {half_up("slope * v.x + intercept", 4)} AS prediction
            FROM line, (VALUES (-2.8::DOUBLE), (3.14), (9.9), (123.45)) v(x)""",
)
def predictions_for_new_values(spark, sf):
    train, _ = _parts(spark, sf)
    model = regression.fit_line(train, ["X"])
    new = spark.createDataFrame([(-2.8,), (3.14,), (9.9,), (123.45,)], "X double")
    return regression.predict(model, new, ["X"]).select("X", rounded("prediction", 4).alias("prediction"))


@query(
    "held_out_error", "ML3 ML4",
    sql=f"""WITH {LINE_SQL}, errors AS (
              SELECT y, y - (slope * x + intercept) AS e FROM points, line WHERE NOT train)
            SELECT count(*) AS n, {half_up("sqrt(avg(e * e))", 4)} AS rmse, {half_up("avg(abs(e))", 4)} AS mae,
                   {half_up("1.0 - avg(e * e) / var_pop(y)", 4)} AS r2 FROM errors""",
)
def held_out_error(spark, sf):
    train, test = _parts(spark, sf)
    model = regression.fit_line(train, ["X"])
    return regression.regression_scores(regression.predict(model, test, ["X"]), "label")


@query(
    "evaluator_rmse", "ML4",
    sql=f"""WITH {LINE_SQL} SELECT {half_up("sqrt(avg((y - slope * x - intercept) * (y - slope * x - intercept)))", 4)} AS rmse
            FROM points, line WHERE NOT train""",
)
def evaluator_rmse(spark, sf):
    train, test = _parts(spark, sf)
    predicted = regression.predict(regression.fit_line(train, ["X"]), test, ["X"])
    error = RegressionEvaluator(predictionCol="prediction", labelCol="label", metricName="rmse").evaluate(predicted)
    return spark.createDataFrame([(error,)], "rmse double").select(rounded("rmse", 4).alias("rmse"))


@query(
    "fit_series", "ML12",
    sql=f"""WITH {LINE_SQL} SELECT CASE WHEN train THEN 'train' ELSE 'test' END AS part, x, y,
            {half_up("slope * x + intercept", 3)} AS prediction FROM points, line""",
)
def fit_series(spark, sf):
    points = b.line_points(spark, sf)
    model = regression.fit_line(split_by_key(points, "key", 80)[0], ["X"])
    series = regression.fit_series(model, points, part_by_key("key", 80), "X", "label")
    return series.withColumn("prediction", rounded("prediction", 3))


def _case(name):
    return next(case for case in forests.CASES if case.name == name)


def _minutes(spark, sf):
    return forests.with_labels(b.energy_minutes(spark, sf))


@query("forest_classifier", "ML5 ML7 ML8")
def forest_classifier(spark, sf):
    return forests.run_case(_minutes(spark, sf), _case("hour from weather"), "row_key")


@query("forest_regressor", "ML6")
def forest_regressor(spark, sf):
    return forests.run_case(_minutes(spark, sf), _case("price from hour"), "row_key")


@query("forest_experiments", "ML11 ML5 ML6")
def forest_experiments(spark, sf):
    return forests.run_cases(_minutes(spark, sf), "row_key")


MINUTES_SQL = """minutes AS (
  SELECT CAST('0x' || substr(md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 8) AS BIGINT) % 100
           >= 80 AS is_test,
         CAST(hour(l_shipdate + to_hours(CAST((l_linenumber * 3 + CAST(l_quantity AS INTEGER)) % 24 AS BIGINT))) AS BIGINT)
           AS hour,
         l_returnflag <> 'A' AS has_wind, l_linestatus <> 'F' AS has_maintenance,
         l_extendedprice / l_quantity AS price
  FROM lineitem)"""


@query(
    "forest_parts", "ML11 FLT9 SL7",
    sql=f"WITH {MINUTES_SQL} " + " UNION ALL ".join(
        f"""SELECT '{name}' AS "case", is_test, count(*) AS n_rows FROM minutes WHERE {test} GROUP BY is_test"""
        for name, test in (
            ("month from weather", "has_wind"), ("month from power", "has_maintenance"),
            ("month from all", "has_wind AND has_maintenance"), ("hour from weather", "has_wind"),
            ("hour from power", "has_maintenance"), ("hour from all", "has_wind AND has_maintenance"),
            ("price from hour", "has_wind AND has_maintenance"), ("price from month", "has_wind AND has_maintenance"),
        )
    ),
)
def forest_parts(spark, sf):
    """What the experiment runner trains and tests each case on."""
    return forests.rows_per_part(forests.prepared(_minutes(spark, sf), "row_key"))


@query(
    "forest_classifier_facts", "ML5 ML7 ML8 ML11",
    sql=f"""WITH {MINUTES_SQL} SELECT count(*) FILTER (WHERE NOT is_test) AS n_train,
            count(*) FILTER (WHERE is_test) AS n_test, max(hour) FILTER (WHERE NOT is_test) + 1 AS classes,
            100 AS trees, true AS chances_add_up, true AS as_reported, true AS beats_majority
            FROM minutes WHERE has_wind""",
)
def forest_classifier_facts(spark, sf):
    """Facts of a trained model: its stored predictions are counted again, plainly."""
    case = _case("hour from weather")
    model, predictions = forests.case_predictions(forests.prepared(_minutes(spark, sf), "row_key", cases=[case]), case)
    # Of the chances only what is asked for is stored: that of the true class and how far all are from one.
    off = F.aggregate(vector_to_array("probability"), F.lit(-1.0), lambda a, x: a + x)
    given = scores.given_to_true_class(case.label)
    stored = written(
        predictions.select(case.label, "prediction", "is_test", given.alias("given"), off.alias("off")), "predictions"
    )
    reported = forests.case_scores(stored, case).select("accuracy", "train_accuracy").first()
    right, test = F.col(case.label) == F.col("prediction"), F.col("is_test")
    percent = lambda hits, of: 100 * F.count_if(hits) / F.count_if(of)
    common = stored.filter(test).groupBy(case.label).count().agg(F.max("count")).first()[0]
    return stored.agg(
        F.count_if(~test).alias("n_train"),
        F.count_if(test).alias("n_test"),
        F.lit(model.numClasses).cast("bigint").alias("classes"),
        F.lit(model.getNumTrees).alias("trees"),
        (F.count_if(F.abs("off") > 1e-9) == 0).alias("chances_add_up"),
        (
            (F.abs(percent(right & test, test) - reported["accuracy"]) < 1e-4)
            & (F.abs(percent(right & ~test, ~test) - reported["train_accuracy"]) < 1e-4)
        ).alias("as_reported"),
        (F.count_if(right & test) >= (common or 0)).alias("beats_majority"),
    )


@query(
    "forest_regressor_facts", "ML6 ML4 ML11",
    sql=f"""WITH {MINUTES_SQL} SELECT count(*) FILTER (WHERE NOT is_test) AS n_train,
            count(*) FILTER (WHERE is_test) AS n_test, 100 AS trees, true AS as_reported, true AS beats_mean
            FROM minutes WHERE has_wind AND has_maintenance""",
)
def forest_regressor_facts(spark, sf):
    case = _case("price from hour")
    model, predictions = forests.case_predictions(forests.prepared(_minutes(spark, sf), "row_key", cases=[case]), case)
    stored = written(predictions.select(case.label, "prediction", "is_test"), "predictions")
    reported = forests.case_scores(stored, case).first()["rmse"]
    test = F.col("is_test")
    error = F.when(test, F.col(case.label) - F.col("prediction"))
    rmse = F.sqrt(F.avg(error * error))
    return stored.agg(
        F.count_if(~test).alias("n_train"),
        F.count_if(test).alias("n_test"),
        F.lit(model.getNumTrees).alias("trees"),
        (F.abs(rmse - reported) < 1e-4).alias("as_reported"),
        (rmse <= F.stddev_pop(F.when(test, F.col(case.label)))).alias("beats_mean"),
    )


@query(
    "rows_per_case", "ML11 FLT9",
    sql=" UNION ALL ".join(
        f"""SELECT '{name}' AS "case", count(*) AS n_rows FROM lineitem WHERE {test}"""
        for name, test in (
            ("month from weather", "l_returnflag <> 'A'"),
            ("month from power", "l_linestatus <> 'F'"),
            ("month from all", "l_returnflag <> 'A' AND l_linestatus <> 'F'"),
            ("hour from weather", "l_returnflag <> 'A'"),
            ("hour from power", "l_linestatus <> 'F'"),
            ("hour from all", "l_returnflag <> 'A' AND l_linestatus <> 'F'"),
            ("price from hour", "l_returnflag <> 'A' AND l_linestatus <> 'F'"),
            ("price from month", "l_returnflag <> 'A' AND l_linestatus <> 'F'"),
        )
    ),
)
def rows_per_case(spark, sf):
    """Rows left for each case: only NULLs in the used columns drop a row."""
    data = _minutes(spark, sf)
    complete = [
        F.count_if(F.forall(F.array(*[F.col(c).isNotNull() for c in (*case.inputs, case.label)]), lambda x: x))
        for case in forests.CASES
    ]
    counted = data.agg(*[n.alias(case.name) for n, case in zip(complete, forests.CASES, strict=True)])
    return counted.unpivot([], [case.name for case in forests.CASES], "case", "n_rows")


@query(
    "class_accuracy", "ML7 ML8",
    sql=f"""WITH {b.CLASS_SQL} SELECT {half_up("100.0 * count(*) FILTER (WHERE label = prediction) / count(*)", 4)} AS accuracy
            FROM predictions""",
)
def class_accuracy(spark, sf):
    evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="accuracy")
    share = evaluator.evaluate(b.class_predictions(spark, sf))
    return spark.createDataFrame([(100 * share,)], "accuracy double").select(rounded("accuracy", 4).alias("accuracy"))


DISTANCE = "least(abs(label - prediction), 12 - abs(label - prediction))"


@query(
    "cyclic_closeness", "ML9 SC17",
    sql=f"""WITH {b.CLASS_SQL} SELECT count(*) AS n,
            {half_up(f"100.0 * count(*) FILTER (WHERE {DISTANCE} = 0) / count(*)", 4)} AS accuracy,
            {half_up(f"100.0 * count(*) FILTER (WHERE {DISTANCE} <= 1) / count(*)", 4)} AS one_away,
            {half_up(f"100.0 * count(*) FILTER (WHERE {DISTANCE} <= 2) / count(*)", 4)} AS two_away
            FROM predictions""",
)
def cyclic_closeness(spark, sf):
    return scores.closeness(b.class_predictions(spark, sf), "label", 12)


@query(
    "true_class_probability", "ML10",
    sql=f"""WITH {b.CLASS_SQL} SELECT {half_up("fsum(given) / count(*) * 100", 4)}
            AS mean_probability FROM predictions""",
)
def true_class_probability(spark, sf):
    return b.class_predictions(spark, sf).agg(scores.true_class_probability("label").alias("mean_probability"))
