"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import written


def _jump(parents: DataFrame) -> DataFrame:
    """Every node to the parent of its parent."""
    up = parents.select(F.col("node").alias("__up"), F.col("root").alias("__root"))
    return parents.join(up, F.col("root") == F.col("__up"), "left").select(
        "node", F.coalesce("__root", "root").alias("root")
    )


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every linked node.

    Each round every node points to its smallest neighbour, pointers are
    doubled twice, and links are drawn again between what the ends point to.
    Components shrink by at least half per round. Minima combine before the
    shuffle, so a node with very many links is no hot spot, and every round is
    a written table, so nothing but row counts comes to the driver.
    """
    links = written(
        links.filter(F.col(a) != F.col(b))
        .select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        .distinct(),
        "links",
    )
    steps = []
    while not links.isEmpty():
        both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            links.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        parents = both.groupBy("node").agg(F.min("other").alias("root"))
        parents = parents.select("node", F.least("node", "root").alias("root"))
        parents = written(_jump(written(_jump(parents), "parents")), "parents")
        steps.append(parents)
        of_a = parents.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        of_b = parents.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        links = written(
            links.join(of_a, "a")
            .join(of_b, "b")
            .filter("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct(),
            "links",
        )
    if not steps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = steps[0]
    for step in steps[1:]:
        up = step.select(F.col("node").alias("__up"), F.col("root").alias("__root"))
        found = found.join(up, F.col("root") == F.col("__up"), "left").select(
            "node", F.coalesce("__root", "root").alias("root")
        )
    return found
