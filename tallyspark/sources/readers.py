"""Readers for the supported formats, batch and streaming."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyspark.session import for_small_files

IMAGE = "origin string, height int, width int, nChannels int, mode int, data binary"


@dataclass(frozen=True)
class CsvOptions:
    """One set of options per CSV store, used by every write and every read."""

    sep: str = ","
    header: bool = True
    multi_line: bool = False
    quote: str = '"'
    null_mark: str = "\\N"  # an empty text is "" and no NULL

    def as_options(self) -> dict[str, str]:
        options = {
            "sep": self.sep,
            "header": str(self.header).lower(),
            "quote": self.quote,
            "nullValue": self.null_mark,
            # Writers trim values unless told not to.
            "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false",
        }
        if self.quote:
            # Doubled quotes, so a quote inside a value survives a round trip.
            options["escape"] = self.quote
        if self.multi_line:
            options["multiLine"] = "true"
        return options


def read_csv(
    spark: SparkSession,
    path: str,
    options: CsvOptions = CsvOptions(),
    schema: StructType | str | None = None,
    infer: bool = False,
) -> DataFrame:
    """CSV file or directory: declared schema, inferred types, or all strings."""
    reader = spark.read.options(**options.as_options())
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str, columns=None, merge: bool = False) -> DataFrame:
    """Parquet scan, optionally of some columns; ``merge`` unites the file schemas."""
    frame = spark.read.option("mergeSchema", str(merge).lower()).parquet(path)
    return frame.select(*columns) if columns else frame


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``value`` per text line of a file or directory."""
    return spark.read.text(path)


def read_json_lines(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path)


def read_images(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Columns origin, height, width, nChannels, mode, data of an image folder, or of several.

    A file that is no image keeps a row, with sizes of -1 and no data. The driver holds
    the states of all files: see ``from_images`` for folders with very many.
    """
    return spark.read.format("image").option("recursiveFileLookup", "true").load(path).select("image.*")


def from_images(
    spark: SparkSession, portions: list[list[str]], made: Callable[[DataFrame], DataFrame], path: str
) -> DataFrame:
    """What is made of the images of all folders, stored at a new path: portion after portion, so that
    the driver knows the files of one portion at a time and forgets them with it."""
    for folders in portions:
        made(read_images(for_small_files(spark), folders)).write.mode("append").parquet(path)
    none = made(spark.createDataFrame([], IMAGE))
    return spark.read.schema(none.schema).parquet(path) if portions else none


def stream_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    options: CsvOptions = CsvOptions(sep=";", header=False),
    files_per_batch: int | None = None,
) -> DataFrame:
    """Unbounded table over the CSV files that appear in a folder."""
    reader = spark.readStream.schema(schema).options(**options.as_options())
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(path)


def stream_parquet(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Unbounded table over the Parquet files of a folder or glob."""
    return spark.readStream.schema(schema).parquet(path)


def named_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM {name}")


def file_stem(path) -> Column:
    """File name of a path or file URI without folder and extension, decoded."""
    path = F.col(path) if isinstance(path, str) else path
    stem = F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)
    # In a URI only %xx stands for something else; a plus is a plus.
    plain = F.try_url_decode(F.replace(stem, F.lit("+"), F.lit("%2B")))
    return F.when(path.rlike("^[a-z][a-z0-9]*:/"), F.coalesce(plain, stem)).otherwise(stem)
