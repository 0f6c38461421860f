"""Batch writers. None of them collects or repartitions unless asked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.sources.readers import CsvOptions


def write_csv(
    df: DataFrame, path: str, options: CsvOptions = CsvOptions(), mode: str = "errorifexists"
) -> str:
    """Write as CSV. In a store that is read line by line, a value with a line
    break would come back as several rows, so it is an error."""
    if not options.multi_line:
        df = df.withColumns(
            {
                c: F.when(F.col(c).rlike("[\\r\\n]"), F.raise_error(F.lit(f"line break in column {c}"))).otherwise(F.col(c))
                for c, kind in df.dtypes
                if kind == "string"
            }
        )
    df.write.options(**options.as_options()).mode(mode).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).parquet(path)
    return path


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).json(path)
    return path


def write_lines(df: DataFrame, path: str, column: str, mode: str = "errorifexists") -> str:
    df.select(column).write.mode(mode).text(path)
    return path


def append_csv(df: DataFrame, path: str, options: CsvOptions = CsvOptions()) -> str:
    """Append with the options of the store; CSV columns match by position."""
    return write_csv(df, path, options, mode="append")


def append_parquet(df: DataFrame, path: str) -> str:
    """Append, also with other columns; read back with ``merge=True``."""
    return write_parquet(df, path, mode="append")
