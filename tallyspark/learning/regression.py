"""Linear regression: fit, predict, and error."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.numeric import rounded


def assemble(df: DataFrame, inputs: list[str], output: str = "features") -> DataFrame:
    """Add a vector column of the inputs. A NULL input is an error, as in Spark ML."""
    return VectorAssembler(inputCols=inputs, outputCol=output).transform(df)


def fit_line(df: DataFrame, inputs: list[str], label: str = "label") -> LinearRegressionModel:
    """Least squares by the normal equations: one pass, a small matrix on the driver."""
    model = LinearRegression(featuresCol="features", labelCol=label, solver="normal")
    return model.fit(assemble(df.select(*inputs, label), inputs))


def predict(model, df: DataFrame, inputs: list[str]) -> DataFrame:
    return model.transform(assemble(df, inputs)).drop("features")


def line_parameters(spark: SparkSession, model: LinearRegressionModel, digits: int = 4) -> DataFrame:
    """Slope of the first input and the intercept."""
    row = [(float(model.coefficients[0]), float(model.intercept))]
    raw = spark.createDataFrame(row, "slope double, intercept double")
    return raw.select(rounded("slope", digits).alias("slope"), rounded("intercept", digits).alias("intercept"))


def regression_scores(predictions: DataFrame, label: str, digits: int = 4) -> DataFrame:
    """RMSE, mean absolute error and R2 in one pass."""
    error = F.col(label) - F.col("prediction")
    mean_square = F.avg(error * error)
    return predictions.agg(
        F.count(F.lit(1)).alias("n"),
        rounded(F.sqrt(mean_square), digits).alias("rmse"),
        rounded(F.avg(F.abs(error)), digits).alias("mae"),
        rounded(F.lit(1.0) - F.try_divide(mean_square, F.var_pop(label)), digits).alias("r2"),
    )


def fit_series(model, points: DataFrame, part: Column, x: str, label: str) -> DataFrame:
    """Rows (part, x, y, prediction) that a fit plot would draw, from one scan."""
    parts = points.select(part.alias("part"), x, label)
    return predict(model, parts, [x]).select(
        "part", F.col(x).alias("x"), F.col(label).alias("y"), "prediction"
    )
