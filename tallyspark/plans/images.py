"""Basic colors of images and questions about them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.functions.pixels import NO_COLOR, PIXEL_COLORS, color_histogram, pixel_hex
from tallyspark.operators.ranking import share_of_total, top_n, top_names
from tallyspark.sources.readers import file_stem

# Fixed value: the image mode with four channels in blue-green-red-alpha order.
BGRA_MODE = 24
# Images up to which a table of their names is small enough for every task.
FEW_IMAGES = 200_000


def image_key(images: DataFrame, origin: str = "origin", name: str = "image") -> DataFrame:
    """Add the file name without extension, which metadata refers to."""
    return images.withColumn(name, file_stem(origin))


def _positions(images: DataFrame, keys: list[str]) -> DataFrame:
    """One row per pixel position. Positions are exploded, not pixels: the bytes
    are cut out in the same generated loop, and no array of texts is built."""
    count = F.floor(F.try_divide(F.octet_length("data"), "nChannels")).cast("int")
    places = F.when(count > 0, F.sequence(F.lit(0), count - 1))
    return images.select(*keys, "mode", "nChannels", "data", F.explode(places).alias("position"))


def pixels(images: DataFrame, keys: list[str]) -> DataFrame:
    """One row per pixel: keys, mode, position from 0, and the pixel as hex text."""
    pixel = pixel_hex("data", F.col("position"), F.col("nChannels"))
    return _positions(images, keys).select(*keys, "mode", "position", pixel.alias("pixel"))


def pixel_statistics(images: DataFrame, keys: list[str]) -> DataFrame:
    """Per image: pixels, distinct pixels, the highest and the first pixel (as a number) and the last position.

    The pixels of an image of one to four channels stay in its row.
    """

    def of_image(data: bytes | None, channels: int | None) -> list:
        count = len(data) // channels if data and channels and channels > 0 else 0
        if not count:
            return [0, 0, None, None, None]
        parts = np.frombuffer(data, np.uint8)[: count * channels].reshape(count, channels)
        numbers = np.zeros(count, np.int64)
        for place in range(channels):
            numbers = numbers << 8 | parts[:, place]
        return [count, len(np.unique(numbers)), int(numbers.max()), count - 1, int(numbers[0])]

    kept = images.select(*keys, "nChannels", "data")
    names = ["n", "distinct_pixels", "highest", "last_position", "first_pixel"]
    schema = T.StructType([kept.schema[k] for k in keys])
    for name in names:
        schema = schema.add(name, "integer" if name == "last_position" else "long")

    def run(batches):
        for batch in batches:
            data, channels = batch.column(len(keys) + 1), batch.column(len(keys)).to_pylist()
            found = [of_image(d.as_py(), c) for d, c in zip(data, channels, strict=True)]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], *columns], names=[*keys, *names])

    return kept.mapInArrow(run, schema)


def color_counts(images: DataFrame, keys: list[str]) -> DataFrame:
    """Pixels per image and color name.

    The pixels of an image are counted within its row: no row per pixel is made,
    and an image leaves its task as at most one row per color. Images of other
    modes count as without color; images without pixels have no row.
    """
    kept = images.select(*keys, "mode", "nChannels", "data")
    schema = T.StructType([kept.schema[k] for k in keys]).add("color", "string").add("n", "long")
    own = len(keys)

    def of_image(mode: int | None, channels: int | None, data: bytes | None) -> np.ndarray:
        counts = np.zeros(len(PIXEL_COLORS), np.int64)
        if data is None or not channels or channels < 0:
            return counts
        if mode == BGRA_MODE and channels == 4:
            return color_histogram(data)
        counts[PIXEL_COLORS.index(NO_COLOR)] = len(data) // channels
        return counts

    def run(batches):
        for batch in batches:
            modes, channels = batch.column(own).to_pylist(), batch.column(own + 1).to_pylist()
            data = batch.column(own + 2)
            counts = [of_image(m, c, d.as_py()) for m, c, d in zip(modes, channels, data, strict=True)]
            counts = np.array(counts, np.int64).reshape(-1, len(PIXEL_COLORS))
            rows, colors = np.nonzero(counts)
            columns = [column.take(pa.array(rows)) for column in batch.columns[:own]]
            columns += [pa.array([PIXEL_COLORS[c] for c in colors], pa.string()), pa.array(counts[rows, colors])]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "color", "n"])

    return kept.mapInArrow(run, schema).groupBy(*keys, "color").agg(F.sum("n").alias("n"))


def is_colored() -> Column:
    return F.col("color") != NO_COLOR


def of_metadata(images: DataFrame, metadata: DataFrame, key: str = "image") -> DataFrame:
    """The images that the (filtered) metadata names, before any pixel is read."""
    return images.join(metadata.select(key), key, "left_semi")


def with_metadata(counts: DataFrame, metadata: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Join image counts and metadata on the image key.

    Counting comes first, so this join moves a few short rows per image and
    never the image bytes.
    """
    return counts.join(metadata.select(key, *columns), key)


def color_counts_of(images: DataFrame, metadata: DataFrame, key: str = "image") -> DataFrame:
    """Color counts of the images that the metadata (a written table, so its size is known) names.

    No image leaves its task. Few names are sent to the images, and only those images
    are taken apart. With many names all images are taken apart where they are, and only
    counts meet the names: that costs less than moving the bytes of every image.
    """
    if metadata.count() <= FEW_IMAGES:
        return color_counts(of_metadata(images, metadata, key), [key])
    return of_metadata(color_counts(images, [key]), metadata, key)


def color_totals(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Colored and transparent pixels per image and their ratio."""
    colored = F.coalesce(F.sum(F.when(is_colored(), F.col("n"))), F.lit(0))
    clear = F.coalesce(F.sum(F.when(~is_colored(), F.col("n"))), F.lit(0))
    ratio = F.try_divide(colored.cast("decimal(20,0)"), clear.cast("decimal(20,0)"))
    return counts.groupBy(*keys).agg(
        colored.alias("colored"), clear.alias("transparent"), F.round(ratio, 6).cast("double").alias("ratio")
    )


def most_colored(counts: DataFrame, keys: list[str], n: int = 4) -> DataFrame:
    return (
        color_totals(counts, keys)
        .select(*keys, "colored")
        .orderBy(F.desc("colored"), *[F.asc(k) for k in keys])
        .limit(n)
    )


def least_colored(counts: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """Lowest ratio of colored to transparent pixels; images without any
    transparent pixel have no ratio and come last."""
    return (
        color_totals(counts, keys)
        .orderBy(F.asc_nulls_last("ratio"), *[F.asc(k) for k in keys])
        .limit(n)
    )


def color_shares(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Percent of the colored pixels of an image per color.

    An image has at most one row per color name, so groups are bounded.
    """
    return share_of_total(counts.filter(is_colored()), keys, "n", "share", bounded=True)


def top_colors(counts: DataFrame, keys: list[str], n: int = 3) -> DataFrame:
    """The ``n`` most common colors of every image with their shares."""
    order = [F.desc("n"), F.asc("color")]
    return top_n(color_shares(counts, keys), keys, order, n, position="place")


def images_with_top_colors(counts: DataFrame, keys: list[str], colors: list[str]) -> DataFrame:
    """Images whose most common colors are the given ones in that order."""
    named = top_names(counts.filter(is_colored()), keys, "color", "n", len(colors), "top_colors")
    wanted = F.array(*[F.lit(c) for c in colors])
    return named.filter(F.col("top_colors") == wanted).select(*keys)


def most_of_color(counts: DataFrame, keys: list[str], color: str = "Red", n: int = 5) -> DataFrame:
    """Images with the most pixels of a color and how many these are."""
    return (
        counts.filter(F.col("color") == color)
        .groupBy(*keys)
        .agg(F.sum("n").alias("pixels"))
        .orderBy(F.desc("pixels"), *[F.asc(k) for k in keys])
        .limit(n)
    )
