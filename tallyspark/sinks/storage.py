"""Reports about stored data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def storage_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file below ``path`` with its size; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", F.col("length").alias("bytes"))
    )


def storage_profile(spark: SparkSession, path: str) -> DataFrame:
    """Number of files, bytes, and megabytes with two decimals."""
    megabytes = F.col("bytes").cast("decimal(30,8)") / F.lit(1024 * 1024)
    return (
        storage_files(spark, path)
        .agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
        .withColumn("megabytes", F.round(megabytes, 2).cast("double"))
    )


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows per scanned file of a file-based DataFrame."""
    return df.groupBy(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_bytes"),
    ).agg(F.count(F.lit(1)).alias("n_rows"))


def row_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """One row (stage, rows, columns) per named DataFrame."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("stage"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in stages.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def round_trip_check(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: counts on both sides, whether they and the column types agree."""
    same_types = sorted(before.dtypes) == sorted(after.dtypes)
    counted = row_counts({"before": before, "after": after})

    def rows(stage: str):
        return F.max(F.when(F.col("stage") == stage, F.col("n_rows")))

    return counted.agg(rows("before").alias("rows_before"), rows("after").alias("rows_after")).select(
        "rows_before",
        "rows_after",
        (F.col("rows_before") == F.col("rows_after")).alias("same_rows"),
        F.lit(same_types).alias("same_types"),
    )
