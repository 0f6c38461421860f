"""Append study: rows of the same and of a changed schema added to a store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.numeric import fahrenheit_to_celsius

# Id postfixes and the content of the added columns.
SAME_SCHEMA_POSTFIX = "_Z1"
CHANGED_SCHEMA_POSTFIX = "_Z2"
CITY_PREFIX = "prefix-"
NEW_COLUMN_TEXT = "New column"


def latest_rows(df: DataFrame, city: str, n: int) -> DataFrame:
    """The ``n`` newest rows of a city, newest first."""
    return df.filter(F.col("City") == city).orderBy(F.desc("Start_Time"), F.desc("ID")).limit(n)


def same_schema_rows(latest: DataFrame) -> DataFrame:
    return latest.withColumn("ID", F.concat("ID", F.lit(SAME_SCHEMA_POSTFIX)))


def changed_schema_rows(rows: DataFrame) -> DataFrame:
    """Other postfix, Celsius instead of Fahrenheit, two new columns, no description."""
    return rows.select(
        F.regexp_replace("ID", SAME_SCHEMA_POSTFIX + "$", CHANGED_SCHEMA_POSTFIX).alias("ID"),
        "Start_Time",
        "End_Time",
        "City",
        "County",
        "State",
        fahrenheit_to_celsius("Temperature_F").alias("Temperature_C"),
        F.concat(F.lit(CITY_PREFIX), "City").alias("AddedColumn1"),
        F.lit(NEW_COLUMN_TEXT).alias("AddedColumn2"),
    )
