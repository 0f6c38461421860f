"""Merkle fixity audit of web archives that exist in two replicas.

A record is a leaf: its place, length and SHA-256. Over the leaves of a file
lies a tree of ordered offset ranges: nodes of the lowest level cover
``RANGE_BYTES`` bytes each, every level above covers ``FAN_OUT`` times as much.
A node is the hash of what lies below it, in order, so two replicas of a file
are equal if the roots are. Where roots differ, only the children of nodes that
differ are compared, level by level, down to the records.

Both replicas are one table with a mark of the side, so each level of both trees
is one grouping and each comparison another. A node has at most ``FAN_OUT``
children, and a lowest range at most one leaf per byte, however large a file.

Defined results: a record at an offset where the other replica has none is
``missing`` or ``extra`` (seen from the second replica), else ``changed``; files
that only one side has are reported record by record; several records at one
offset are one leaf of all of them; a NULL digest is a value of its own; rows
without file or offset are no records; equal replicas and empty tables give no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import written

RANGE_BYTES = 1 << 16
FAN_OUT = 16
RECORDS_PER_FILE = 1000


def response_record(url: Column, payload: Column, name: Column) -> Column:
    """Text of an archive record around a payload."""
    body = F.coalesce(payload, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(name.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def placed(records: DataFrame, file: str, order: list[str], length: str = "length") -> DataFrame:
    """Add ``offset``: where a record begins if the records of a file follow each other.

    Needs lengths only; the texts of the records need not be in the rows.
    """
    before = Window.partitionBy(file).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return records.withColumn("offset", F.coalesce(F.sum(length).over(before), F.lit(0)).cast("bigint"))


def _leaves(primary: DataFrame, replica: DataFrame, label: str) -> DataFrame:
    columns = ["file", "offset", "length", "digest", label]
    both = primary.select(F.lit(0).alias("side"), *columns).unionByName(replica.select(F.lit(1).alias("side"), *columns))
    own = F.struct("length", "digest")
    # Copies at one place combine before the shuffle, whatever their number.
    leaf = both.filter(F.col("file").isNotNull() & F.col("offset").isNotNull()).groupBy("side", "file", "offset").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min("length").alias("length"),
        F.min("digest").alias("digest"),
        F.sum(F.xxhash64(own).cast("decimal(38,0)")).alias("all"),
        F.min(label).alias(label),
    )
    # No other column goes into the hash than what the record is.
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("offset", "copies", "length", "digest", "all")]
    leaf = leaf.withColumn("hash", F.sha2(F.concat_ws("|", *parts), 256))
    return leaf.withColumn("range", F.floor(F.col("offset") / RANGE_BYTES))


def _above(nodes: DataFrame, place: str, into: Column) -> DataFrame:
    """The next level: the hash of the hashes of the children, in order."""
    grouped = nodes.groupBy("side", "file", into.alias("__range")).agg(
        F.sort_array(F.collect_list(F.struct(F.col(place).alias("at"), "hash"))).alias("children")
    )
    text = F.concat_ws(",", F.transform("children", lambda c: F.concat_ws(":", c["at"].cast("string"), c["hash"])))
    return grouped.select("side", "file", F.col("__range").alias("range"), F.sha2(text, 256).alias("hash"))


def trees(leaves: DataFrame) -> list[DataFrame]:
    """All levels above the leaves, lowest first; the last one has the roots."""
    levels = [written(_above(leaves, "offset", F.col("range")), "ranges")]
    top = levels[0].agg(F.max("range")).first()[0] or 0
    while top > 0:
        levels.append(written(_above(levels[-1], "range", F.floor(F.col("range") / FAN_OUT)), "ranges"))
        top //= FAN_OUT
    return levels


def _differing(nodes: DataFrame, keys: list[str], *more: str) -> DataFrame:
    """Places where the two sides do not have the same hash, with columns of both."""
    sides = []
    for side, name in ((0, "primary"), (1, "replica")):
        sides += [F.max(F.when(F.col("side") == side, F.col(c))).alias(f"{name}_{c}") for c in ("hash", *more)]
    both = nodes.groupBy(*keys).agg(*sides)
    return both.filter(~F.col("primary_hash").eqNullSafe(F.col("replica_hash")))


def audit(primary: DataFrame, replica: DataFrame, label: str) -> DataFrame:
    """Records that differ: ``file``, ``offset``, the label, ``status``, and
    length and digest on both sides.

    Both tables have ``file``, ``offset``, ``length``, ``digest`` and the label.
    """
    leaves = written(_leaves(primary, replica, label), "leaves")
    levels = trees(leaves)
    wrong = _differing(levels[-1], ["file", "range"]).select("file", "range")
    for level in reversed(levels[:-1]):
        below = level.withColumn("__parent", F.floor(F.col("range") / FAN_OUT))
        parents = wrong.select("file", F.col("range").alias("__parent"))
        wrong = _differing(below.join(parents, ["file", "__parent"], "left_semi"), ["file", "range"]).select("file", "range")
    suspects = leaves.join(wrong, ["file", "range"], "left_semi")
    found = _differing(suspects, ["file", "offset"], "length", "digest", label)
    status = (
        F.when(F.col("replica_hash").isNull(), "missing").when(F.col("primary_hash").isNull(), "extra").otherwise("changed")
    )
    return found.select(
        "file", "offset", F.coalesce(f"primary_{label}", f"replica_{label}").alias(label), status.alias("status"),
        "primary_length", "replica_length", "primary_digest", "replica_digest",
    )
