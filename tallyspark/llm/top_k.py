"""Exact top-k by inner product: aggregation without random access.

Vectors are cut into blocks of bounded size, and so are the queries; every pair
of a query block and a vector block is a task. In a block every component has a
list of all vectors sorted by it. For a query the lists are read from the top
where its component is positive and from the bottom where it is negative, all to
the same depth. What a list can still give is at most the value that it was read
down to, and at least its end. So every vector has an upper and a lower bound of
its score, read or not. A query is done when few vectors have an upper bound that
reaches the k-th best lower bound: outsiders cannot qualify any more, and the
final scores of those left are added up. Else the lists are read deeper.

Bounds of a vector depend on the query through signs and weights only. With the
positive and the negative part of the queries side by side, one matrix product
gives the bounds of a whole block, for all queries that are not done yet. Doubles
hold all sums exactly as long as these stay below 2 ** 53, which is looked at per
block; a block with larger numbers is worked off in whole numbers without bounds.

Rows equal in id and vector are one row with a count while lists are read, and are
told apart again when ranks are given.

Defined results: vectors that are NULL or hold a NULL or a value that is not
finite take no part; every other row is a candidate, also one that equals the query;
equal query rows give one list each; missing components of shorter vectors count as
zero; an empty vector scores zero; ties go to the smaller id, NULL ids last; a
query's own row is no candidate, another row of the same id is; a score that does not fit
into 64 bits is an error; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import written
from tallyspark.operators.ranking import top_n

BEST = 10
SCALE = 1024
VECTORS_PER_BLOCK, QUERIES_PER_BLOCK, QUERIES_AT_ONCE = 4096, 1024, 128
# Shares of the lists read before bounds are looked at. Once the vectors that can
# still qualify are at most this share of a block, their scores are added up.
DEPTHS = (3 / 8, 3 / 4, 1)
FEW = 1 / 2


def quantised(vector, scale: int = SCALE) -> Column:
    """Components as whole numbers; NULL unless all of them are finite."""
    v = F.col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(v.isNull() | odd, None).otherwise(
        F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    )


class Block:
    """The sorted lists of a block of vectors."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        n = len(vectors)
        order = np.argsort(vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(vectors, order, axis=0)
        self.rank = np.empty_like(order)
        np.put_along_axis(self.rank, order, np.arange(n)[:, None], axis=0)

    def bounds(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """What each component of each vector counts at most and at least, after
        reading lists to a depth, for positive and for negative queries."""
        n = len(self.vectors)
        low, high = self.sorted[0], self.sorted[-1]
        from_top, from_bottom = self.rank >= n - depth, self.rank < depth
        to_top, to_bottom = self.sorted[n - depth], self.sorted[depth - 1]
        most = [np.where(from_top, self.vectors, to_top), np.where(from_bottom, self.vectors, to_bottom)]
        least = [np.where(from_top, self.vectors, low), np.where(from_bottom, self.vectors, high)]
        return np.concatenate(most, axis=1), np.concatenate(least, axis=1)

    def best(self, queries: np.ndarray, own: np.ndarray, k: int):
        """For every query the places of all vectors that may be among the best k.

        ``own`` has the place of the query's own vector, or -1.
        """
        n = len(self.vectors)
        parts = np.concatenate([np.maximum(queries, 0), np.minimum(queries, 0)], axis=1).T
        open_, found = np.arange(len(queries)), [np.zeros(0, np.int64)] * len(queries)
        for share in DEPTHS:
            depth = max(1, int(np.ceil(n * share)))
            most, least = self.bounds(depth)
            still = []
            for start in range(0, len(open_), QUERIES_AT_ONCE):
                some = open_[start : start + QUERIES_AT_ONCE]
                upper, lower = most @ parts[:, some], least @ parts[:, some]
                with_own = np.flatnonzero(own[some] >= 0)
                upper[own[some][with_own], with_own] = -np.inf
                lower[own[some][with_own], with_own] = -np.inf
                limit = np.partition(lower, n - k, axis=0)[n - k] if n > k else np.full(len(some), -np.inf)
                alive = (upper >= limit) & (upper > -np.inf)
                done = (alive.sum(axis=0) <= max(FEW * n, 2 * k)) | (depth == n)
                for place in np.flatnonzero(done):
                    found[some[place]] = np.flatnonzero(alive[:, place])
                still.append(some[~done])
            open_ = np.concatenate(still) if still else open_[:0]
            if not len(open_):
                break
        return found


FOUND = {"query": pa.string(), "query_id": pa.int64(), "asks": pa.int64(), "vec_id": pa.int64(), "copies": pa.int64(), "score": pa.int64()}


def _matrix(rows: pa.ChunkedArray, width: int, kind: type = float) -> np.ndarray:
    out = np.zeros((len(rows), width), kind)
    for place, row in enumerate(rows.to_pylist()):
        out[place, : len(row)] = row
    return out


def best_of_block(queries: pa.Table, vectors: pa.Table, k: int) -> dict[str, list]:
    """Best k candidates of one block for each query: numbers of both rows, id and score."""
    out: dict[str, list] = {name: [] for name in FOUND}
    if not queries.num_rows or not vectors.num_rows:
        return out
    width = max(len(r) for t in (queries, vectors) for r in t.column("vector").to_pylist())
    left, right = (_matrix(t.column("vector"), max(1, width)) for t in (queries, vectors))
    exact = width * np.abs(left).max() * np.abs(right).max() < 2.0**53
    if not exact:
        left, right = (_matrix(t.column("vector"), max(1, width), object) for t in (queries, vectors))
    rows = {row: place for place, row in enumerate(vectors.column("row").to_pylist())}
    own = np.array([rows.get(row, -1) for row in queries.column("row").to_pylist()])
    ids = vectors.column("vec_id").to_pylist()
    sortable = np.array([np.iinfo(np.int64).max if i is None else i for i in ids], np.int64)
    copies = vectors.column("copies").to_pylist()
    every = np.arange(len(ids))
    for place, alive in enumerate(Block(right).best(left, own, k) if exact else (every[every != at] for at in own)):
        scores = right[alive] @ left[place]
        if not exact and len(scores) and max(map(abs, scores)) >= 1 << 63:
            raise OverflowError("a score does not fit into 64 bits")
        scores = scores.astype(np.int64)
        for at in np.lexsort((sortable[alive], np.invert(scores)))[:k]:
            out["query"].append(queries.column("row")[place].as_py())
            out["query_id"].append(queries.column("vec_id")[place].as_py())
            out["asks"].append(queries.column("copies")[place].as_py())
            out["vec_id"].append(ids[alive[at]])
            out["copies"].append(copies[alive[at]])
            out["score"].append(int(scores[at]))
    return out


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = BEST,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    vectors_per_block: int = VECTORS_PER_BLOCK,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of the best k for each query row."""
    rows = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
        quantised(vector).alias("vector"),
    )
    equal = rows.filter(F.col("vector").isNotNull()).groupBy("vec_id", "vector")
    rows = equal.agg(F.count(F.lit(1)).alias("copies"), F.count_if("is_query").alias("asks"))
    # A hash of id and vector tells rows apart.
    text = F.to_json(F.struct("vec_id", "vector"))
    rows = written(rows.withColumn("row", F.md5(text.cast("binary"))), "vectors")
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("asks") > 0).alias("q")).first()
    vector_blocks = max(1, -(-sizes["n"] // vectors_per_block))
    query_blocks = max(1, -(-sizes["q"] // QUERIES_PER_BLOCK))
    digits = F.conv(F.substring("row", 1, 15), 16, 10).cast("bigint")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    candidates = rows.select(
        F.lit(False).alias("asking"), "row", "vec_id", "vector", "copies",
        (digits % vector_blocks).cast("int").alias("vector_block"), every(query_blocks).alias("query_block"),
    )
    queries = rows.filter(F.col("asks") > 0).select(
        F.lit(True).alias("asking"), "row", "vec_id", "vector", F.col("asks").alias("copies"),
        every(vector_blocks).alias("vector_block"), (digits % query_blocks).cast("int").alias("query_block"),
    )

    def search(table: pa.Table) -> pa.Table:
        asking = table.column("asking")
        found = best_of_block(table.filter(asking), table.filter(pc.invert(asking)), k)
        return pa.table(found, schema=pa.schema(list(FOUND.items())))

    found = (
        candidates.unionByName(queries)
        .groupBy("query_block", "vector_block")
        .applyInArrow(search, "query string, query_id bigint, asks bigint, vec_id bigint, copies bigint, score bigint")
    )
    # Rows that equal the query, without itself.
    own = F.aggregate("vector", F.lit(0).cast("bigint"), lambda total, x: total + x * x)
    twins = rows.filter((F.col("asks") > 0) & (F.col("copies") > 1)).select(
        F.col("row").alias("query"), F.col("vec_id").alias("query_id"), "asks", "vec_id",
        (F.col("copies") - 1).alias("copies"), own.alias("score"),
    )
    times = lambda count: F.explode(F.sequence(F.lit(1), count))
    single = found.unionByName(twins).withColumn("copy", times(F.least(F.col("copies"), F.lit(k).cast("bigint"))))
    order = [F.desc("score"), F.asc_nulls_last("vec_id")]
    best = top_n(single, ["query", "query_id"], order, k, "rank")
    return best.withColumn("list", times(F.col("asks"))).select("query_id", "rank", "vec_id", "score")
