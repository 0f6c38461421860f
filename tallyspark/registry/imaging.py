"""Pixels and colors."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark import bindings as b
from tallyspark.plans import images as im
from tallyspark.registry.core import half_up, query
from tallyspark.session import written

IMAGES = f"WITH {b.IMAGES_SQL}"
KEYS = ["image", "annotation", "group"]


def _scan(spark, sf):
    return im.image_key(b.images(spark, sf))


def _counts(spark, sf, wanted=None):
    """Color counts per image, then the metadata. If only some metadata is
    wanted, only the images that it names are counted."""
    metadata, images = b.image_metadata(spark, sf), _scan(spark, sf)
    if wanted is None:
        counts = im.color_counts(images, ["image"])
    else:
        metadata = written(metadata.filter(wanted), "wanted-metadata")
        counts = im.color_counts_of(images, metadata)
    return im.with_metadata(counts, metadata, "image", ["annotation", "group"])


@query(
    "pixel_values", "IM1",
    sql=f"""{IMAGES}, placed AS (
              SELECT image, unnest(regexp_extract_all(hex, '.{{8}}')) AS pixel,
                     generate_subscripts(regexp_extract_all(hex, '.{{8}}'), 1) - 1 AS position FROM images)
            SELECT image, count(*) AS n, count(DISTINCT pixel) AS distinct_pixels,
                   max(CAST('0x' || pixel AS BIGINT)) AS highest, CAST(max(position) AS INTEGER) AS last_position,
                   max(CASE WHEN position = 0 THEN CAST('0x' || pixel AS BIGINT) END) AS first_pixel
            FROM placed GROUP BY image""",
)
def pixel_values(spark, sf):
    return im.pixel_statistics(_scan(spark, sf), ["image"])


@query(
    "color_names", "IM2",
    sql=f"{IMAGES} SELECT color, CAST(sum(n) AS BIGINT) AS n FROM color_counts GROUP BY color",
)
def color_names(spark, sf):
    return im.color_counts(_scan(spark, sf), ["mode"]).select("color", "n")


@query("color_counts", "IM2 JN3", sql=f"{IMAGES} SELECT * FROM color_counts")
def color_counts(spark, sf):
    return _counts(spark, sf)


TOTALS_SQL = """totals AS (
  SELECT image, annotation, "group", CAST(coalesce(sum(n) FILTER (WHERE color <> 'None'), 0) AS BIGINT) AS colored,
         CAST(coalesce(sum(n) FILTER (WHERE color = 'None'), 0) AS BIGINT) AS transparent
  FROM color_counts GROUP BY ALL)"""


@query(
    "most_colored_images", "IM3 SL2",
    sql=f"""{IMAGES}, {TOTALS_SQL} SELECT image, annotation, "group", colored FROM totals
            ORDER BY colored DESC, image LIMIT 4""",
)
def most_colored_images(spark, sf):
    return im.most_colored(_counts(spark, sf), KEYS, 4)


@query(
    "least_colored_images", "IM4 SC15",
    sql=f"""{IMAGES}, {TOTALS_SQL} SELECT image, annotation, "group", colored, transparent,
            CAST(round(CAST(CAST(colored AS DOUBLE) / nullif(transparent, 0) AS DECIMAL(30, 12)), 6) AS DOUBLE) AS ratio
            FROM totals ORDER BY ratio NULLS LAST, image LIMIT 5""",
)
def least_colored_images(spark, sf):
    return im.least_colored(_counts(spark, sf), KEYS, 5)


TOP_SQL = f"""shares AS (
  SELECT image, annotation, "group", color, n,
         {half_up("100.0 * n / sum(n) OVER (PARTITION BY image)", 2)} AS share,
         CAST(row_number() OVER (PARTITION BY image ORDER BY n DESC, color) AS INTEGER) AS place
  FROM color_counts WHERE color <> 'None')"""


@query(
    "top_colors_of_image", "IM5 WN5",
    sql=f"{IMAGES}, {TOP_SQL} SELECT * FROM shares WHERE place <= 3 AND annotation = 'src7 of 7'",
)
def top_colors_of_image(spark, sf):
    counts = _counts(spark, sf, F.col("annotation") == "src7 of 7")
    return im.top_colors(counts, KEYS, 3)


@query(
    "top_colors_of_all_images", "IM5 WN5 WN2",
    sql=f"{IMAGES}, {TOP_SQL} SELECT * FROM shares WHERE place <= 3",
)
def top_colors_of_all_images(spark, sf):
    return im.top_colors(_counts(spark, sf), KEYS, 3)


@query(
    "images_with_color_order", "IM6 WN4",
    sql=f"""{IMAGES}, {TOP_SQL} SELECT image, annotation, "group" FROM shares WHERE place <= 3
            GROUP BY ALL HAVING string_agg(color, '-' ORDER BY place) = 'Green-Blue-Purple'""",
)
def images_with_color_order(spark, sf):
    return im.images_with_top_colors(_counts(spark, sf), KEYS, ["Green", "Blue", "Purple"])


@query(
    "most_red_images_of_group", "IM7 AG12",
    sql=f"""{IMAGES} SELECT image, annotation, "group", CAST(sum(n) AS BIGINT) AS pixels FROM color_counts
            WHERE color = 'Red' AND "group" = 'en' GROUP BY ALL ORDER BY pixels DESC, image LIMIT 5""",
)
def most_red_images_of_group(spark, sf):
    counts = _counts(spark, sf, F.col("group") == "en")
    return im.most_of_color(counts, KEYS, "Red", 5)


@query(
    "metadata_join", "JN3",
    sql=f"""{IMAGES} SELECT image, annotation, "group", CAST(length(hex) / 8 AS INTEGER) AS n_pixels FROM images""",
)
def metadata_join(spark, sf):
    sizes = _scan(spark, sf).select("image", (F.col("height") * F.col("width")).alias("n_pixels"))
    return im.with_metadata(sizes, b.image_metadata(spark, sf), "image", ["annotation", "group"])
