"""Scores of class predictions, each in a single pass over the predictions."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.numeric import cyclic_distance, exact_mean, rounded


def _percent(condition: Column, among: Column) -> Column:
    hits = F.count_if(condition & among).cast("decimal(20,0)") * 100
    return rounded(F.try_divide(hits, F.count_if(among).cast("decimal(20,0)")), 4)


def accuracy(predictions: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    return predictions.agg(_percent(F.col(label) == F.col(prediction), F.lit(True)).alias("accuracy"))


def _closeness_scores(label: str, prediction: str, period: int, among: Column) -> list[Column]:
    distance = cyclic_distance(label, prediction, period)
    return [
        F.count_if(among).alias("n"),
        _percent(distance == 0, among).alias("accuracy"),
        _percent(distance <= 1, among).alias("one_away"),
        _percent(distance <= 2, among).alias("two_away"),
    ]


def closeness(
    predictions: DataFrame, label: str, period: int, prediction: str = "prediction"
) -> DataFrame:
    """Percent exactly right, and at most one and two away on a circle."""
    return predictions.agg(*_closeness_scores(label, prediction, period, F.lit(True)))


def true_class_probability(
    label: str, probability: str = "probability", among: Column | None = None
) -> Column:
    """Mean probability that the model gave to the true class, in percent.

    Classes are numbered by label, so the label indexes the vector directly; a
    class that the model has never seen has probability 0.
    """
    given = given_to_true_class(label, probability)
    given = given if among is None else F.when(among, given)
    return rounded(exact_mean(given) * 100, 4)


def given_to_true_class(label: str, probability: str = "probability") -> Column:
    """Probability that the model gave to the true class."""
    return F.coalesce(F.get(vector_to_array(probability), F.col(label).cast("int")), F.lit(0.0))


def class_scores(predictions: DataFrame, label: str, period: int, is_test: Column) -> DataFrame:
    """All class scores of the test rows and the accuracy on the other rows, in one row.

    The exact sum uses its value often, so the vector is looked at in a step before it; a
    column ``given`` with that probability takes its place.
    """
    given = F.col("given") if "given" in predictions.columns else given_to_true_class(label)
    narrow = predictions.select(label, "prediction", is_test.alias("__test"), given.alias("given"))
    test = F.col("__test")
    return narrow.agg(
        *_closeness_scores(label, "prediction", period, test),
        rounded(exact_mean(F.when(test, F.col("given"))) * 100, 4).alias("mean_probability"),
        _percent(F.col(label) == F.col("prediction"), ~test).alias("train_accuracy"),
    )
