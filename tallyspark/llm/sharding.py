"""Shards along a Hilbert curve through several metadata dimensions.

Each dimension is quantised to ``LEVELS`` steps that hold about equally many
rows. The cell of a row gets its place on a Hilbert curve, so that neighbours
on the curve are neighbours in every dimension. Rows are ordered by that place
and the order is cut into runs: a shard covers few values of each dimension and
readers can skip the others (``manifest`` says which values a shard covers).

Law ``rows``: counts of shards are at most one apart.

The position of a row is the number of rows on earlier cells, plus those in
earlier parts of its own cell, plus its number within the part. Parts are dealt
by a hash, so a cell that holds a third of all rows is numbered by many tasks.
Only counts of cells, at most ``LEVELS`` ** dimensions, meet in one task.

Defined results: a NULL text has no bytes and the checksum of the empty text; a
NULL in a dimension is its lowest value; repeated rows are rows of their own;
an empty table gives no rows; columns named like a result are replaced.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import with_new_columns, written

BITS = 4
LEVELS = 1 << BITS
SHARDS = 16
PARTS = 1024
RESULTS = ("size", "text_crc32", "hilbert", "law", "shard", "slot", "grown_shard")


def hilbert_index(point: tuple[int, ...], bits: int) -> int:
    """Place of a cell on the Hilbert curve through all cells."""
    x, n = list(point), len(point)
    for level in range(bits - 1, 0, -1):  # undo the turns of each level, coarse to fine
        below = (1 << level) - 1
        for i in range(n):
            if x[i] >> level & 1:
                x[0] ^= below
            else:
                swap = (x[0] ^ x[i]) & below
                x[0] ^= swap
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = 0
    for level in range(bits - 1, 0, -1):
        if x[-1] >> level & 1:
            flip ^= (1 << level) - 1
    place = 0
    for level in range(bits - 1, -1, -1):
        for value in x:
            place = place << 1 | ((value ^ flip) >> level & 1)
    return place


def class_code(column) -> Column:
    """0 to 65,536 for a text value: part of its hash, 0 for NULL. Bounded, so
    that counts per code fit in one task whatever the number of values."""
    digits = F.substring(F.md5(F.col(column).cast("string").cast("binary")), 1, 4)
    return F.coalesce(F.conv(digits, 16, 10).cast("int") + 1, F.lit(0))


def size_code(size: Column) -> Column:
    """Size in steps of a 32nd of a doubling; at most some thousand values."""
    return F.floor(F.log2(size.cast("double")) * 32).cast("int")


def _levels(df: DataFrame, codes: list[str]) -> dict[str, list[float]]:
    """Limits between the levels of each code, with equally many rows between them."""
    shares = F.array(*[F.lit(i / LEVELS) for i in range(1, LEVELS)])
    row = df.agg(*[F.percentile(c, shares).alias(c) for c in codes]).first()
    # A value with many rows is a limit several times: the levels it fills stay one step apart from the rest.
    return {c: sorted(row[c] or []) for c in codes}


def assign(
    docs: DataFrame,
    dimensions: tuple[str, ...] = ("lang", "source"),
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    shards: int = SHARDS,
) -> DataFrame:
    """The kept columns with ``size``, ``text_crc32``, ``hilbert``, ``law``,
    ``shard``, ``slot`` and ``grown_shard`` (NULL under this law).

    The dimensions are the given columns and the size of the text.
    """
    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    codes = [f"__code{i}" for i in range(len(dimensions) + 1)]
    size = F.octet_length(content).cast("bigint") + 1
    slim = docs.select(
        *[F.col(c).alias(f"__keep{i}") for i, c in enumerate(keep)],
        size.alias("size"),
        F.crc32(content).alias("text_crc32"),
        *[class_code(d).alias(c) for d, c in zip(dimensions, codes, strict=False)],
        size_code(size).alias(codes[-1]),
    )
    slim = written(slim, "shard-keys")  # texts are read once
    limits = _levels(slim, codes)
    cell: Column = F.lit(0)
    for code in codes:
        level: Column = F.lit(0)
        for limit in limits[code]:
            level = level + (F.col(code) > limit).cast("int")
        cell = cell * LEVELS + level
    curve = F.lit([hilbert_index(p, BITS) for p in product(range(LEVELS), repeat=len(codes))])
    kept = [f"__keep{i}" for i in range(len(keep))]
    placed = slim.select(*kept, "size", "text_crc32", F.element_at(curve, cell + 1).alias("hilbert")).withColumn(
        "__part", F.pmod(F.xxhash64(*kept, "text_crc32", "size"), F.lit(PARTS)).cast("int")
    )
    parts = placed.groupBy("hilbert", "__part").agg(F.count(F.lit(1)).alias("__n"))
    cells = parts.groupBy("hilbert").agg(F.sum("__n").alias("__n"))
    starts = cells.select(
        "hilbert",
        F.coalesce(F.sum("__n").over(Window.orderBy("hilbert").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__cell"),
        F.sum("__n").over(Window.partitionBy()).alias("__rows"),
    )
    inside = Window.partitionBy("hilbert").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "hilbert", "__part", F.coalesce(F.sum("__n").over(inside), F.lit(0)).alias("__before")
    ).join(starts, "hilbert")
    order = Window.partitionBy("hilbert", "__part").orderBy(*kept, "text_crc32", "size")
    numbered = (
        placed.withColumn("__number", F.row_number().over(order))
        .join(offsets, ["hilbert", "__part"])
        .withColumn("__place", F.col("__cell") + F.col("__before") + F.col("__number") - 1)
        .withColumn("__each", F.floor(F.col("__rows") / shards))
        .withColumn("__extra", F.col("__rows") % shards)
    )
    # The first shards take one row more each, as far as rows are left over.
    large = F.col("__extra") * (F.col("__each") + 1)
    shard = F.when(F.col("__place") < large, F.floor(F.col("__place") / (F.col("__each") + 1))).otherwise(
        F.col("__extra") + F.floor((F.col("__place") - large) / F.greatest(F.col("__each"), F.lit(1)))
    )
    start = F.col("shard") * F.col("__each") + F.least(F.col("shard"), F.col("__extra"))
    out = numbered.withColumn("shard", shard.cast("int")).select(
        *[F.col(k).alias(c) for k, c in zip(kept, keep, strict=True)],
        *[F.col(k).alias(f"__r_{k}") for k in ("size", "text_crc32", "hilbert")],
        F.lit("rows").alias("__r_law"),
        F.col("shard").alias("__r_shard"),
        (F.col("__place") - start).cast("bigint").alias("__r_slot"),
        F.lit(None).cast("int").alias("__r_grown_shard"),
    )
    return with_new_columns(out, *RESULTS).withColumnsRenamed({f"__r_{k}": k for k in RESULTS})


def manifest(assigned: DataFrame) -> DataFrame:
    """Per shard its rows, bytes and the run of the curve that it covers."""
    return assigned.groupBy("shard").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("size").alias("bytes"),
        F.min("hilbert").alias("first_cell"),
        F.max("hilbert").alias("last_cell"),
    )


def write_shards(assigned: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """One folder per shard; its rows go to files in order of their slots."""
    piece = F.floor(F.col("slot") / rows_per_file)
    dealt = assigned.repartition("shard", piece).sortWithinPartitions("shard", "slot")
    dealt.write.partitionBy("shard").parquet(path)
