"""Random forest experiments: cases of inputs and a label, trained side by side."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.temporal import hour_number_of_seconds, month_of_seconds
from tallyspark.learning import levels
from tallyspark.learning.regression import assemble, regression_scores
from tallyspark.learning.scores import class_scores
from tallyspark.operators.sampling import hash_bucket
from tallyspark.session import written

# Measurement columns of the energy table and circle lengths.
WEATHER_INPUTS = ("temperature", "humidity", "wind_speed")
POWER_INPUTS = ("power_tenants", "power_maintenance", "power_solar_panels")
PRICE = "electricity_price"
ALL_INPUTS = (*WEATHER_INPUTS, *POWER_INPUTS, PRICE)
PERIODS = {"month": 12, "hour": 24}
# Size of the parts in which tasks share the feature table.
SPLIT_BYTES = 2 << 20
# Spark keeps a row with a number for each tree while it trains, some 530 bytes of memory: rows that
# one task holds, and rows up to which cases train at the same time.
ROWS_PER_TASK = 100_000
ROWS_AT_ONCE = 40_000_000
# How many rows trees draw from at most where rows are alike, and in how many portions
# rows of equal values must be drawn on average for that.
DRAWN_ROWS = 4_000_000
LEAST_PORTIONS = 4
# From how many rows on a forest is grown from packed rows, where they are not alike.
PACKED_ROWS = 1_000_000
SCORES = ("accuracy", "one_away", "two_away", "mean_probability", "train_accuracy", "rmse", "mae", "r2")


@dataclass(frozen=True)
class Case:
    name: str
    inputs: tuple[str, ...]
    label: str
    regression: bool = False


CASES = [
    *[
        Case(f"{label} from {what}", inputs, label)
        for label in PERIODS
        for what, inputs in (("weather", WEATHER_INPUTS), ("power", POWER_INPUTS), ("all", ALL_INPUTS))
    ],
    *[
        Case(f"price from {label}", (*WEATHER_INPUTS, *POWER_INPUTS, label), PRICE, regression=True)
        for label in ("hour", "month")
    ],
]


def with_labels(minutes: DataFrame) -> DataFrame:
    """Add month and hour of the epoch second, in the session time zone."""
    return minutes.withColumns({"month": month_of_seconds("time"), "hour": hour_number_of_seconds("time")})


def clean(df: DataFrame, case: Case, keep: list[str]) -> DataFrame:
    """Only the used columns; only rows with NULL in one of them are dropped."""
    used = [*case.inputs, case.label]
    return df.select(*keep, *used).na.drop(subset=used)


def fit_forest(train: DataFrame, case: Case, trees: int = 100, depth: int = 5, seed: int = 1, weight: str | None = None):
    kind = RandomForestRegressor if case.regression else RandomForestClassifier
    forest = kind(featuresCol="features", labelCol=case.label, numTrees=trees, maxDepth=depth, seed=seed)
    return (forest.setWeightCol(weight) if weight else forest).fit(assemble(train, list(case.inputs)))


def dealt(rows: DataFrame, n_rows: int) -> DataFrame:
    """Rows in parts of bounded size; files of narrow rows would be read in a few large ones."""
    return rows.repartition(max(1, -(-n_rows // ROWS_PER_TASK)))


def forest_predictions(model, df: DataFrame, case: Case) -> DataFrame:
    return model.transform(assemble(df, list(case.inputs)))


def prepared(df: DataFrame, key: str, train_percent: int = 80, cases: list[Case] = CASES) -> DataFrame:
    """Inputs, labels and the mark ``is_test`` (by a hash of the key), written once.

    All cases train and score from this narrow table.
    """
    used = sorted({c for case in cases for c in (*case.inputs, case.label)})
    return written(df.select(*used, (hash_bucket(key) >= train_percent).alias("is_test")), "features", SPLIT_BYTES)


def in_portions(cells: DataFrame, portions: int) -> DataFrame:
    """Each row, with its count ``n_alike``, as at most so many rows of nearly equal counts that add up to it."""
    parts = F.least(F.col("n_alike"), F.lit(portions)).cast("int")
    size = F.expr("n_alike div __parts") + F.when(F.col("__part") < F.col("n_alike") % F.col("__parts"), 1).otherwise(0)
    split = cells.withColumn("__parts", parts).withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
    return split.withColumn("n_alike", size).drop("__parts", "__part")


def _predictions_of_alike(rows: DataFrame, case: Case, trees: int, depth: int):
    """Model and predictions where many rows have equal inputs and labels, or None.

    Equal rows are counted. The bootstrap draws them in portions, as many as make
    ``DRAWN_ROWS`` rows in all; up to that number a portion is one row. Every row
    counts in training, whatever its portion. Equal inputs are predicted once.
    """
    train = rows.filter(~F.col("is_test")).select(*case.inputs, case.label)
    known = train.agg(F.approx_count_distinct(F.xxhash64(*train.columns)).alias("cells")).first()
    portions = DRAWN_ROWS // max(1, known["cells"])
    if portions < LEAST_PORTIONS:
        return None
    cells = written(train.groupBy(*train.columns).agg(F.count(F.lit(1)).alias("n_alike")), "alike")
    model = fit_forest(dealt(in_portions(cells, portions), DRAWN_ROWS), case, trees, depth, weight="n_alike")
    inputs = list(case.inputs)
    predicted = forest_predictions(model, rows.select(*inputs).distinct(), case)
    predicted = written(predicted.select(*inputs, "prediction", "probability"), "predicted")
    return model, rows.join(predicted, inputs)


def case_predictions(data: DataFrame, case: Case, trees: int = 100, depth: int = 5):
    """The model of a case and its predictions for training and test rows.

    From ``PACKED_ROWS`` on the forest is not grown by Spark's trainer, but by the same
    method over packed rows (``levels``), unless the rows are alike.
    """
    rows = clean(data, case, ["is_test"])
    n_rows = rows.count()
    if not case.regression and n_rows >= 2 * DRAWN_ROWS:
        found = _predictions_of_alike(rows, case, trees, depth)
        if found:
            return found
    if n_rows >= PACKED_ROWS:
        model = levels.fit(
            rows.filter(~F.col("is_test")), list(case.inputs), case.label, case.regression, trees, depth
        )
        return model, model.transform(rows)
    rows = dealt(rows, n_rows)
    model = fit_forest(rows.filter(~F.col("is_test")), case, trees, depth)
    return model, forest_predictions(model, rows, case)


def case_scores(predictions: DataFrame, case: Case) -> DataFrame:
    """One result row; training and test rows are scored in the same pass."""
    if case.regression:
        result = regression_scores(predictions.filter("is_test"), case.label)
    else:
        result = class_scores(predictions, case.label, PERIODS[case.label], F.col("is_test"))
    return result.select(F.lit(case.name).alias("case"), "*")


def run_case(
    df: DataFrame, case: Case, key: str, trees: int = 100, depth: int = 5, train_percent: int = 80
) -> DataFrame:
    """Clean, split by a hash of the key, train, and score: one result row."""
    data = prepared(df, key, train_percent, [case])
    return case_scores(case_predictions(data, case, trees, depth)[1], case)


def rows_per_part(data: DataFrame, cases: list[Case] = CASES) -> DataFrame:
    """Rows that each case keeps of the prepared table, for training and test."""
    counted = [
        clean(data, case, ["is_test"]).groupBy("is_test").agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(case.name).alias("case"), "is_test", "n_rows")
        for case in cases
    ]
    return reduce(DataFrame.unionByName, counted)


def side_by_side(spark: SparkSession, tasks: dict[str, Callable[[], Row]], at_once: int) -> dict[str, Row | Exception]:
    """Run tasks that start Spark jobs in threads; what each gives, or the error that ended it.

    A thread has the caller's job properties (group, tags, description) and a pool of its
    own name, so a fair scheduler shares the executors between the tasks.
    """

    def start(name: str, task: Callable[[], Row]) -> Row | Exception:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            return task()
        except Exception as error:  # the other tasks go on
            return error
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(at_once) as pool:
        # The properties are copied where the thread's work is handed over.
        futures = {name: pool.submit(inheritable_thread_target(spark)(start), name, task) for name, task in tasks.items()}
        return {name: future.result() for name, future in futures.items()}


def run_cases(
    df: DataFrame, key: str, cases: list[Case] = CASES, trees: int = 100, depth: int = 5, at_once: int | None = None
) -> DataFrame:
    """All cases, one row each; scores a case does not have are NULL.

    All cases read one prepared table and train at once (``at_once`` of them; if not
    given, as many as hold ``ROWS_AT_ONCE`` rows, which Spark keeps while it trains), as one
    forest alone leaves executors idle between its levels. A case that fails has its
    reason in ``error``; if all fail, so does this.
    """
    spark, data = df.sparkSession, prepared(df, key, cases=cases)
    n_rows = data.count()
    kept = max(1, n_rows if n_rows < PACKED_ROWS else min(n_rows, DRAWN_ROWS))
    at_once = at_once or max(1, min(len(cases), ROWS_AT_ONCE // kept))

    def task(case: Case) -> Callable[[], Row]:
        return lambda: case_scores(case_predictions(data, case, trees, depth)[1], case).first()

    found = side_by_side(spark, {case.name: task(case) for case in cases}, at_once)
    errors = [e for e in found.values() if isinstance(e, Exception)]
    if errors and len(errors) == len(cases):
        raise errors[0]
    made = [{"case": n, "error": str(r)} if isinstance(r, Exception) else r.asDict() for n, r in found.items()]
    names = ["case", "n", *SCORES, "error"]
    schema = f"case string, n bigint, {', '.join(f'{s} double' for s in SCORES)}, error string"
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in made], schema)
