"""Running daily totals of a sales stream.

The aggregation itself is ``plans.sales.daily_totals``; here are the queries
that run it. State and results have one row per day, however much is sold.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyspark.plans.sales import daily_totals
from tallyspark.session import fresh_dir


def running_totals(stream: DataFrame, best_first: bool = False, **columns) -> DataFrame:
    """Daily totals of a stream, optionally sorted (in complete mode)."""
    totals = daily_totals(stream, **columns)
    return totals.orderBy(F.desc("totalPrice"), F.asc(columns.get("day", "orderDate"))) if best_first else totals


def start_in_memory(result: DataFrame, name: str, checkpoint: str, drain: bool = False) -> StreamingQuery:
    """Start a query whose complete result can be read as table ``name``.

    The memory sink keeps the result on the driver: use it for results with
    few rows, such as totals per day. ``drain`` stops after the present data.
    """
    writer = (
        result.writeStream.outputMode("complete")
        .format("memory")
        .queryName(name)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if drain else writer).start()


def start_to_files(result: DataFrame, path: str, checkpoint: str, drain: bool = False) -> StreamingQuery:
    """Start a query that writes every complete result to its own folder.

    Each micro-batch overwrites ``path/batch=<id>``, so a batch that is run
    again after a failure leaves one result. Nothing passes the driver.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = (
        result.writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if drain else writer).start()


def finish(query: StreamingQuery, seconds: int | None = None) -> StreamingQuery:
    """Wait for a draining query to end. With a limit it is stopped and fails
    if it takes longer."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"stream did not finish within {seconds} s")
    return query


def drain_to_table(spark: SparkSession, result: DataFrame, label: str = "totals") -> DataFrame:
    """Run a stream over its present data; the final state as a table."""
    name = f"{label}_{uuid.uuid4().hex}"
    finish(start_in_memory(result, name, fresh_dir(spark, f"state-{label}"), drain=True))
    return spark.table(name)


def drain_to_files(spark: SparkSession, result: DataFrame, label: str = "totals") -> DataFrame:
    """Run a stream over its present data; the final state from files.

    Without any input there is no batch, and the result has no rows.
    """
    path = fresh_dir(spark, f"result-{label}")
    query = finish(start_to_files(result, path, fresh_dir(spark, f"state-{label}"), drain=True))
    last = [p["batchId"] for p in query.recentProgress if p["numInputRows"]]
    if not last:
        return spark.createDataFrame([], result.schema)
    return spark.read.parquet(f"{path}/batch={last[-1]}")


def agreement(batch: DataFrame, streamed: DataFrame, day: str) -> DataFrame:
    """Days whose totals agree and differ between a batch and a stream result."""
    both = batch.alias("b").join(streamed.alias("s"), day, "full_outer")
    same = F.col("b.totalPrice").eqNullSafe(F.col("s.totalPrice")) & F.col("b.totalCount").eqNullSafe(
        F.col("s.totalCount")
    )
    return both.agg(F.count_if(same).alias("equal_days"), F.count_if(~same).alias("different_days"))
