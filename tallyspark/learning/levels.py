"""Random forests over many rows: the method of Spark's trainer, over rows packed in blocks.

Spark keeps some 530 bytes a row with a number for each tree, and every tree and level
costs it a look into maps of objects. Here a row is one byte per input, the number of its bin,
and a task counts all rows of a block at once. The method is the same: up to 32 bins an
input, a Poisson(1) weight per row and tree, a random subset of the inputs at each node, the
split of the largest gain (Gini or variance), all trees level by level, every row in every tree.

A task keeps one block and the sums of one level; these meet by tree, where the splits
are chosen. The driver gets the chosen splits, one row per tree and level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, exp, factorial, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.session import written

# As in Spark ML: bins of an input, and classes that a label may have.
BINS = 32
MOST_CLASSES = 100
# Rows of a block, and rows whose chances of all classes add up at once: small enough for a processor's cache.
BLOCK_ROWS = 32_768
ROWS_SAID = 2_048
# Size of the parts in which tasks share the blocks.
SPLIT_BYTES = 2 << 20
# Up to which of 16 random bits a tree draws a row 0, 1, 2, … times: Poisson with mean 1.
DRAWS = [round((1 << 16) * sum(exp(-1) / factorial(i) for i in range(k + 1))) for k in range(8)]


def cut_points(train: DataFrame, inputs: list[str]) -> list[np.ndarray]:
    """Values that end the bins of each input: all of them if there are few, else quantiles of all rows
    (a bin may be off by a thousandth of the rows; Spark takes them from a sample)."""
    numbers = train.select(*[F.col(c).cast("double").alias(c) for c in inputs])
    shares = [i / BINS for i in range(1, BINS)]
    known = numbers.agg(
        *[F.percentile_approx(c, shares, 1_000).alias(c) for c in inputs],
        *[F.approx_count_distinct(c).alias(f"{c} values") for c in inputs],
    ).first()
    few = [c for c in inputs if known[f"{c} values"] <= 2 * BINS]
    values = numbers.agg(*[F.collect_set(c).alias(c) for c in few]).first() if few else {}
    every = {c: np.unique(values[c])[:-1] for c in few if len(values[c]) <= BINS}
    return [every[c] if c in every else np.unique(known[c] or []).astype(float) for c in inputs]


def binned(batch: pa.RecordBatch, cuts: list[np.ndarray]) -> np.ndarray:
    """The bin of every value of the first columns, one line per input."""
    columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(cuts))]
    return np.array([np.searchsorted(cut, x) for cut, x in zip(cuts, columns, strict=True)], np.uint8)


def larger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of some ``BLOCK_ROWS``."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        if sum(map(len, waiting)) >= BLOCK_ROWS:
            yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
            waiting = []
    if waiting:
        yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()


def packed(train: DataFrame, inputs: list[str], label: str, cuts: list[np.ndarray], kind: str) -> DataFrame:
    """The training rows in blocks of bins and labels, written once: a block has the same rows in every pass."""
    schema = pa.schema([("block", pa.int64()), ("n", pa.int32()), ("cells", pa.binary()), ("labels", pa.binary())])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(larger(batches)):
            labels = batch.column(len(cuts)).to_numpy(zero_copy_only=False).astype(kind)
            values = [[first + number], [len(batch)], [binned(batch, cuts).tobytes()], [labels.tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)

    numbers = train.select(*[F.col(c).cast("double").alias(c) for c in (*inputs, label)])
    return written(numbers.mapInArrow(blocks, "block bigint, n int, cells binary, labels binary"), "blocks", SPLIT_BYTES)


def weights(seed: int, block: int, tree: int, n: int) -> np.ndarray:
    """How often a tree draws each row of a block; the same in every pass."""
    bits = np.frombuffer(np.random.default_rng([seed, block, tree]).bytes(2 * n), "<u2")
    drawn = np.zeros(n, np.uint8)
    for limit in DRAWS:
        if limit < 1 << 16:
            drawn += bits >= np.uint16(limit)
    return drawn.astype(float)


def picked(arrays: list[np.ndarray], ways: list[np.ndarray]) -> np.ndarray:
    """Of the arrays of all nodes of a level, each row's by its way there (bytes of 0: left, or 255: right)."""
    for way in reversed(ways):
        arrays = [left ^ ((left ^ right) & way) for left, right in zip(arrays[::2], arrays[1::2], strict=True)]
    return arrays[0]


def ways_of(cells: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> list[np.ndarray]:
    """Which way each row goes at each of the first levels of a tree. All nodes of a level are decided for
    all rows, byte by byte, which is faster than looking up the node of each row."""
    ways: list[np.ndarray] = []
    for level in range(levels):
        nodes = range((1 << level) - 1, (2 << level) - 1)
        ways.append(picked([-(cells[feature[i]] > np.uint8(cut[i])).view(np.uint8) for i in nodes], ways))
    return ways


def node_of(ways: list[np.ndarray], n: int) -> np.ndarray:
    """The node of each row in the level that the ways lead to, counted from the left."""
    node = np.zeros(n, np.uint16)
    for way in ways:
        node = 2 * node + (way & 1)
    return node


def block_sums(cells, labels, drawn, ways, subset, classes: int) -> np.ndarray:
    """Sums of a block per node, chosen input and bin: of each class, or of rows and labels."""
    nodes, width = subset.shape
    each, size = classes or 1, nodes * BINS * (classes or 1)
    base = np.multiply(node_of(ways, len(labels)), BINS * each, dtype=np.int64)
    if classes:
        base += labels
    found = np.empty((nodes, width, BINS, classes or 2))
    for place in range(width):
        index = np.multiply(picked([cells[i] for i in subset[:, place]], ways), each, dtype=np.int64)
        index += base
        if classes:
            found[:, place] = np.bincount(index, drawn, size).reshape(nodes, BINS, classes)
        else:
            found[:, place, :, 0] = np.bincount(index, drawn, size).reshape(nodes, BINS)
            found[:, place, :, 1] = np.bincount(index, drawn * labels, size).reshape(nodes, BINS)
    return found


def _purity(sums: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows, and what the impurity of a part falls short of: the gain of a split is a difference of these."""
    n = sums.sum(-1) if classes else sums[..., 0]
    squares = (sums * sums).sum(-1) if classes else sums[..., 1] ** 2
    return n, np.divide(squares, n, out=np.zeros_like(n), where=n > 0)


def best_splits(sums: np.ndarray, subset: np.ndarray, classes: int):
    """Input and last bin to the left of the best split of each node (input -1: none), and sums of node, left and right."""
    nodes, width = subset.shape
    here = sums[:, 0].sum(axis=1)
    left = sums.cumsum(axis=2)[:, :, :-1]
    right = here[:, None, None] - left
    (n_left, good_left), (n_right, good_right) = _purity(left, classes), _purity(right, classes)
    n, good = _purity(here, classes)
    gain = good_left + good_right - good[:, None, None]
    gain = np.where((n_left >= 1) & (n_right >= 1) & (gain > 1e-12 * np.abs(good)[:, None, None]), gain, -1.0)
    best = gain.reshape(nodes, -1).argmax(axis=1)
    place, cut = np.divmod(best, BINS - 1)
    each = np.arange(nodes)
    feature = np.where(gain[each, place, cut] > 0, subset[each, place], -1)
    return feature, cut, here, left[each, place, cut], right[each, place, cut]


@dataclass
class LevelForest:
    """Trees of one depth; a node that is not split passes all rows to the left."""

    inputs: list[str]
    cuts: list[np.ndarray]
    feature: np.ndarray  # tree, node
    cut: np.ndarray
    leaves: np.ndarray  # tree, node of the last level, sums
    numClasses: int  # noqa: N815 - as Spark's models name it; 0: regression
    depth: int

    @property
    def getNumTrees(self) -> int:  # noqa: N802 - as Spark's models name it
        return len(self.feature)

    def given(self) -> np.ndarray:
        """What each leaf says: the share of each class, or the mean label."""
        if not self.numClasses:
            return self.leaves[..., 1:] / np.maximum(self.leaves[..., :1], 1)
        return self.leaves / np.maximum(self.leaves.sum(-1, keepdims=True), 1)

    def transform(self, rows: DataFrame) -> DataFrame:
        """Rows with ``prediction`` and, of classes, ``probability``: the mean of what all trees say."""
        given, cuts, feature, cut, depth = self.given(), self.cuts, self.feature, self.cut, self.depth
        numbers, classes = [f"__{i}" for i in range(len(cuts))], self.numClasses

        def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in larger(batches):
                cells = binned(batch, cuts)
                leaf = [node_of(ways_of(cells, f, c, depth), len(batch)) for f, c in zip(feature, cut, strict=True)]
                said = np.zeros((len(batch), given.shape[2]))
                for start in range(0, len(batch), ROWS_SAID):
                    some = said[start : start + ROWS_SAID]
                    for tree in range(len(given)):
                        some += given[tree].take(leaf[tree][start : start + ROWS_SAID], axis=0)
                said /= len(given)
                columns, names = batch.columns[len(cuts) :], batch.schema.names[len(cuts) :]
                columns.append(pa.array(said.argmax(axis=1).astype(float) if classes else said[:, 0]))
                if classes:
                    ends = pa.array(np.arange(0, said.size + 1, classes), pa.int32())
                    columns.append(pa.ListArray.from_arrays(ends, pa.array(said.ravel())))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "prediction", "probability"][: len(columns)])

        as_numbers = [F.col(c).cast("double").alias(n) for c, n in zip(self.inputs, numbers, strict=True)]
        schema = rows.select("*", F.lit(0.0).alias("prediction"))
        if not classes:
            return rows.select(*as_numbers, "*").mapInArrow(predict, schema.schema)
        schema = schema.select("*", F.array(F.lit(0.0)).alias("probability"))
        predicted = rows.select(*as_numbers, "*").mapInArrow(predict, schema.schema)
        return predicted.withColumn("probability", array_to_vector("probability"))


def _number_of_classes(train: DataFrame, label: str) -> int:
    y = F.col(label).cast("double")
    found = train.agg(F.max(y).alias("most"), F.count_if((y < 0) | (y != F.floor(y))).alias("odd")).first()
    if found["odd"] or found["most"] is None or found["most"] >= MOST_CLASSES:
        raise ValueError(f"labels of classes must be whole numbers from 0 to {MOST_CLASSES - 1}: {label}")
    return int(found["most"]) + 1


def _next_splits(blocks: DataFrame, feature, cut, subset, level: int, classes: int, seed: int | None) -> DataFrame:
    """The best splits of one level: a row per tree. Without a seed every tree has each row once."""
    trees, nodes, width = subset.shape
    shape = (nodes, width, BINS, classes or 2)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            for row in batch.to_pylist():
                cells = np.frombuffer(row["cells"], np.uint8).reshape(-1, row["n"])
                labels = np.frombuffer(row["labels"], np.uint8 if classes else np.float64)
                sums = np.zeros((trees, *shape)) if sums is None else sums
                for tree in range(trees):
                    drawn = weights(seed, row["block"], tree, row["n"]) if seed is not None else np.ones(row["n"])
                    ways = ways_of(cells, feature[tree], cut[tree], level)
                    sums[tree] += block_sums(cells, labels, drawn, ways, subset[tree], classes)
        for tree in range(trees if sums is not None else 0):
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree], pa.int32()), pa.array([sums[tree].tobytes()], pa.binary())], names=["tree", "sums"]
            )

    names = ["tree", "feature", "cut", "here", "left", "right"]

    def choose(table: pa.Table) -> pa.Table:
        tree = table.column("tree")[0].as_py()
        sums = np.zeros(shape)
        for part in table.column("sums"):
            sums += np.frombuffer(part.as_buffer()).reshape(shape)
        found = best_splits(sums, subset[tree], classes)
        kinds = [pa.int64()] * 2 + [pa.float64()] * 3
        arrays = [pa.array([x.ravel().tolist()], pa.list_(k)) for x, k in zip(found, kinds, strict=True)]
        return pa.Table.from_arrays([pa.array([tree], pa.int32()), *arrays], names=names)

    counted = blocks.mapInArrow(count, "tree int, sums binary")
    lists = "feature array<bigint>, cut array<bigint>, here array<double>, left array<double>, right array<double>"
    return counted.groupBy("tree").applyInArrow(choose, f"tree int, {lists}")


def fit(
    train: DataFrame,
    inputs: list[str],
    label: str,
    regression: bool,
    trees: int = 100,
    depth: int = 5,
    seed: int = 1,
    bootstrap: bool = True,
) -> LevelForest:
    """A forest over all rows; inputs and labels have no NULL."""
    classes = 0 if regression else _number_of_classes(train, label)
    cuts, kinds = cut_points(train, inputs), classes or 2
    blocks = packed(train, inputs, label, cuts, "u1" if classes else "f8")
    d = len(inputs)
    width = d if trees == 1 else ceil(sqrt(d) if classes else d / 3)
    feature = np.zeros((trees, (1 << depth) - 1), np.int64)
    cut = np.full((trees, (1 << depth) - 1), BINS, np.int64)
    alive, leaves = np.ones((trees, 1), bool), np.zeros((trees, 1, kinds))
    chance = np.random.default_rng(seed)
    for level in range(depth):
        nodes = 1 << level
        subset = np.argsort(chance.random((trees, nodes, d)), axis=2)[:, :, :width]
        below, split = np.zeros((trees, nodes, 2, kinds)), np.zeros((trees, nodes), bool)
        for row in _next_splits(blocks, feature, cut, subset, level, classes, seed if bootstrap else None).collect():
            t, chosen = row["tree"], np.array(row["feature"])
            here, left, right = (np.array(row[k]).reshape(nodes, kinds) for k in ("here", "left", "right"))
            split[t] = alive[t] & (chosen >= 0)
            leaves[t][alive[t]] = here[alive[t]]
            below[t] = np.where(split[t][:, None, None], np.stack([left, right], axis=1), leaves[t][:, None])
            places = slice(nodes - 1, 2 * nodes - 1)
            feature[t, places] = np.where(split[t], chosen, 0)
            cut[t, places] = np.where(split[t], row["cut"], BINS)
        alive, leaves = np.repeat(split, 2, axis=1), below.reshape(trees, 2 * nodes, kinds)
    return LevelForest(inputs, cuts, feature, cut, leaves, classes, depth)
