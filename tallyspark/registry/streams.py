"""Streaming totals."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyspark import bindings as b
from tallyspark.plans.sales import daily_totals
from tallyspark.functions.numeric import rounded
from tallyspark.registry.core import TOTAL_DIGITS, query
from tallyspark.registry.studies import DAILY_SALES_SQL
from tallyspark.session import fresh_dir
from tallyspark.sinks import writers
from tallyspark.sources import readers
from tallyspark.sources.readers import CsvOptions, named_table
from tallyspark.streaming import totals
from tallyspark.tables import table

NO_HEADER = CsvOptions(sep=";", header=False)
SALES_SCHEMA = "orderId string, orderDate string, productPrice double, productCount int"


def _comparable(totals_per_day):
    """Sums are equal in both engines up to the last bits."""
    return totals_per_day.withColumn("totalPrice", rounded("totalPrice", TOTAL_DIGITS))


def _stream(spark, sf):
    schema = table(spark, sf, "events").schema
    # A glob matches the table as one file and as a folder of files alike.
    return b.as_sales(readers.stream_parquet(spark, f"{sf}/{{events}}.parquet", schema))


@query("stream_daily_totals", "SM1", sql=f"WITH {DAILY_SALES_SQL} SELECT * FROM daily_sales")
def stream_daily_totals(spark, sf):
    return _comparable(totals.drain_to_files(spark, totals.running_totals(_stream(spark, sf))))


@query("stream_csv_totals", "SRC13 SM1 SNK1", sql=f"WITH {DAILY_SALES_SQL} SELECT * FROM daily_sales")
def stream_csv_totals(spark, sf):
    path = writers.write_csv(b.sales(spark, sf), fresh_dir(spark, "stream"), NO_HEADER)
    stream = readers.stream_csv(spark, path, SALES_SCHEMA, NO_HEADER, files_per_batch=2)
    return _comparable(totals.drain_to_files(spark, totals.running_totals(stream)))


@query("stream_named_result", "SNK7 SM2 SRC15", sql=f"WITH {DAILY_SALES_SQL} SELECT * FROM daily_sales")
def stream_named_result(spark, sf):
    name = f"daily_{fresh_dir(spark, 'q').rsplit('-', 1)[1]}"
    result = totals.running_totals(_stream(spark, sf))
    totals.finish(totals.start_in_memory(result, name, fresh_dir(spark, "state"), drain=True))
    return _comparable(named_table(spark, name))


@query(
    "stream_best_first", "SM3 SL1",
    sql=f"""WITH {DAILY_SALES_SQL} SELECT *, CAST(row_number() OVER (ORDER BY totalPrice DESC, orderDate) AS INTEGER)
            AS place FROM daily_sales""",
)
def stream_best_first(spark, sf):
    """All days with their place in the stream's own order, read from its sorted files."""
    sorted_result = totals.running_totals(_stream(spark, sf), best_first=True)
    kept = totals.drain_to_files(spark, sorted_result)
    # A sorted result is written as files in order, and rows of a file are in order.
    seen = kept.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    place = F.row_number().over(Window.orderBy("file", "row"))
    return _comparable(seen.withColumn("place", place).drop("file", "row"))


@query(
    "stream_equals_batch", "SM4",
    sql=f"WITH {DAILY_SALES_SQL} SELECT count(*) AS equal_days, CAST(0 AS BIGINT) AS different_days FROM daily_sales",
)
def stream_equals_batch(spark, sf):
    streamed = totals.drain_to_files(spark, totals.running_totals(_stream(spark, sf)))
    return totals.agreement(daily_totals(b.sales(spark, sf)), streamed, "orderDate")
