"""How document filters overlap: what each removes in every order of them.

Five filters judge each text; a document fails a filter when its condition holds:

- A: fewer than ``MIN_WORDS`` words;
- B: fewer than half as many distinct words as words;
- C: over 3 percent of the characters are ASCII capitals;
- D: a character of ``SYMBOLS``;
- E: the text equals that of a document with a smaller id.

A and B are read from a sparse document-term matrix. Tasks cut their documents
into shards of about ``SHARD_BYTES`` and write each as compressed sparse rows over
the words of the shard, with a list of these words. The lists, one row per word and
shard, are dealt out by word and sorted; a stream over the sorted words numbers
them, which makes the global dictionary, and the numbers go back to the shards to
rename their columns. So postings are never shuffled one by one, and a word in every
document is one row per shard. Sums of the rows are the word counts, their stored
entries the distinct words.

The other flags are computed when the shard is cut and travel with its rows. What
follows works on counts of (part, failed filters, labels), a bounded table.

Defined results: a NULL text counts as empty; a NULL ``lang`` is the part of the
empty string; a document without id never fails E and lets none fail it; labels
are one per id (1 if any of its rows says 1), an id without labels has none;
repeated rows count each; an empty table has no parts and gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import written
from tallyspark.llm.infilling import slices

# The filters' limits.
FILTERS = "ABCDE"
MIN_WORDS = 200
DISTINCT_PERCENT = 50
CAPITALS_PERCENT = 3
SYMBOLS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CONTINUED = bytes(range(0x80, 0xC0))  # bytes within a character of UTF-8
SHARD_BYTES = 16 << 20

LABELS = "array<struct<doc_id:bigint,part:string,fails:string,digest:binary>>"
MATRIX = f"shard bigint, rows {LABELS}, indptr binary, indices binary, counts binary"
CUT = "pos int, word string, " + MATRIX
_LABEL_TYPE = pa.struct([("doc_id", pa.int64()), ("part", pa.string()), ("fails", pa.string()), ("digest", pa.binary())])
_CUT_TYPES = [pa.int32(), pa.string(), pa.int64(), pa.list_(_LABEL_TYPE), pa.binary(), pa.binary(), pa.binary()]
_CUT_NAMES = ["pos", "word", "shard", "rows", "indptr", "indices", "counts"]
WORDS_AT_ONCE = 20_000
SLICE_BYTES = 1 << 20


def flags_of(text: bytes) -> str:
    """Which of the filters C and D a text fails."""
    capitals = len(text) - len(text.translate(None, CAPITALS))
    characters = len(text.translate(None, CONTINUED))
    odd = len(text.translate(None, SYMBOLS)) < len(text)
    return ("C" if 100 * capitals > CAPITALS_PERCENT * characters else "") + ("D" if odd else "")


def packed(numbers: np.ndarray) -> bytes:
    """Integers in compressed little-endian form, behind their width in bytes."""
    return bytes([numbers.dtype.itemsize]) + zstandard.ZstdCompressor(1).compress(numbers.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), f"<i{data[0]}")


def sparse_rows(texts: pa.StringArray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The words of some texts, and per text which of them it holds how often (indptr, indices, counts)."""
    lists = pc.ascii_split_whitespace(texts)
    words, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    real = pc.not_equal(words, "")  # white space at an end leaves an empty string
    coded = words.filter(real).dictionary_encode()
    places = parents.filter(real).to_numpy().astype(np.int64) << 32 | coded.indices.to_numpy()
    cells, counts = np.unique(places, return_counts=True)
    indptr = np.searchsorted(cells >> 32, np.arange(len(texts) + 1)).astype(np.int64)
    return coded.dictionary, indptr, (cells & 0xFFFFFFFF).astype(np.int32), counts.astype(np.int32)


class _Numbers(dict):
    """Numbers words in the order in which they are asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class _Shard:
    """Sparse rows over the words of one shard, built from slices of texts."""

    def __init__(self, number: int):
        self.number, self.words, self.labels, self.bytes = number, _Numbers(), [], 0
        self.indptr, self.indices, self.counts, self.entries = [np.zeros(1, np.int64)], [], [], 0

    def add(self, ids: list, parts: list, texts: pa.StringArray) -> None:
        words, indptr, indices, counts = sparse_rows(texts)
        numbers = np.fromiter(map(self.words.__getitem__, words.to_pylist()), np.int32, len(words))
        self.indptr.append(indptr[1:] + self.entries)
        self.indices.append(numbers[indices])
        self.counts.append(counts)
        self.entries += len(indices)
        for doc_id, part, text in zip(ids, parts, texts, strict=True):
            raw = text.as_buffer().to_pybytes()
            digest = hashlib.sha256(raw).digest()
            self.labels.append({"doc_id": doc_id, "part": part, "fails": flags_of(raw), "digest": digest})
            self.bytes += len(raw) + 64

    def batches(self) -> Iterator[pa.RecordBatch]:
        """One row per word, and one with the sparse rows and their labels."""
        words = list(self.words)
        for start in range(0, len(words), WORDS_AT_ONCE):
            some = words[start : start + WORDS_AT_ONCE]
            columns = [pa.array(np.arange(start, start + len(some), dtype=np.int32)), pa.array(some, pa.string())]
            columns += [pa.array(np.full(len(some), self.number)), *[pa.nulls(len(some), t) for t in _CUT_TYPES[3:]]]
            yield pa.RecordBatch.from_arrays(columns, names=_CUT_NAMES)
        matrix = [packed(np.concatenate(m)) for m in (self.indptr, self.indices, self.counts)]
        values = [None, None, self.number, self.labels, *matrix]
        columns = [pa.array([v], k) for v, k in zip(values, _CUT_TYPES, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=_CUT_NAMES)


def local_shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Shards of sparse rows over their own words (rows without ``word``), and
    these words (all other rows). ``docs``: doc_id, part, text."""
    source = docs.select(
        F.spark_partition_id().cast("bigint").alias("at"),
        F.col("doc_id").cast("bigint"),
        F.coalesce("part", F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )

    def run(batches):
        shard = None
        for batch in batches:
            for start, length in slices(batch.column(3), min(shard_bytes, SLICE_BYTES)):
                at, ids, parts, texts = batch.slice(start, length).columns
                shard = shard or _Shard(at[0].as_py() << 32)
                shard.add(ids.to_pylist(), parts.to_pylist(), texts)
                if shard.bytes >= shard_bytes:
                    yield from shard.batches()
                    shard = _Shard(shard.number + 1)
        if shard and shard.labels:
            yield from shard.batches()

    return written(source.mapInArrow(run, CUT), "shards")


def numbered_words(cut: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The dictionary (``word``, ``term``: dense numbers from 0), and for every
    shard the ``term`` at each place of its word list.

    Words are dealt out by hash and sorted; a stream over a range counts them. The
    numbers of earlier ranges are added from a table with one row per range.
    """
    used = cut.filter(F.col("word").isNotNull()).select("word", "shard", "pos")

    def run(batches):
        seen, last = -1, None
        for batch in batches:
            if not len(batch):
                continue
            words = batch.column(0)
            new = np.ones(len(batch), bool)
            new[1:] = pc.not_equal(words.slice(1), words.slice(0, len(words) - 1)).to_numpy(zero_copy_only=False)
            new[0] = words[0].as_py() != last
            rank = seen + np.cumsum(new)
            seen, last = int(rank[-1]), words[-1].as_py()
            first = pc.if_else(pa.array(new), words, pa.scalar(None, words.type))
            columns = [first, *batch.columns[1:], pa.array(rank)]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "shard", "pos", "range", "rank"])

    dealt = used.repartition("word").sortWithinPartitions("word", "shard").withColumn("range", F.spark_partition_id())
    ranked = written(dealt.mapInArrow(run, "word string, shard bigint, pos int, range int, rank bigint"), "words")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranked.groupBy("range").agg((F.max("rank") + 1).alias("size"))
    begins = sizes.select("range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("begin"))
    terms = ranked.join(F.broadcast(begins), "range").withColumn("term", F.col("begin") + F.col("rank"))
    return terms.filter(F.col("word").isNotNull()).select("word", "term"), terms.select("shard", "pos", "term")


def csr_shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The document-term matrix: shards of sparse rows whose columns are global word numbers.

    ``indptr``, ``indices`` and ``counts`` are packed integers, see ``unpacked``.
    """
    cut = local_shards(docs, shard_bytes)
    bodies = cut.filter(F.col("word").isNull()).select("shard", "rows", "indptr", "indices", "counts")
    _, terms = numbered_words(cut)

    def rename(body, places):
        numbers = np.zeros(places.num_rows, np.int64)
        numbers[places.column("pos").to_numpy()] = places.column("term").to_numpy()
        local = unpacked(body.column("indices")[0].as_py())
        at = body.schema.get_field_index("indices")
        return body.set_column(at, body.schema.field(at), pa.array([packed(numbers[local])], pa.binary()))

    return bodies.groupBy("shard").cogroup(terms.groupBy("shard")).applyInArrow(rename, MATRIX)


def row_statistics(shards: DataFrame) -> DataFrame:
    """The labels of every row of the matrix with ``words`` (its sum) and ``distinct`` (its stored entries)."""

    def run(batches):
        for batch in batches:
            for place in range(len(batch)):
                indptr = unpacked(batch.column(2)[place].as_py())
                counts = unpacked(batch.column(4)[place].as_py()).astype(np.int64)
                total = np.concatenate([[0], np.cumsum(counts)])
                labels = batch.column(1)[place].values
                columns = [*labels.flatten(), pa.array(np.diff(total[indptr])), pa.array(np.diff(indptr))]
                names = ["doc_id", "part", "fails", "digest", "words", "distinct"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kinds = "doc_id bigint, part string, fails string, digest binary, words bigint, distinct bigint"
    return shards.select("shard", "rows", "indptr", "indices", "counts").mapInArrow(run, kinds)


def failures(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document: ``doc_id``, ``part``, ``words``, ``distinct`` and ``fails``, the letters of failed filters."""
    rows = written(row_statistics(csr_shards(docs, shard_bytes)), "rows")
    # Copies combine before the shuffle; only texts that some later document repeats are joined back.
    first = rows.filter(F.col("doc_id").isNotNull()).groupBy("digest")
    first = first.agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    copied = first.filter(F.col("last") > F.col("first")).select("digest", "first")
    joined = rows.join(copied, "digest", "left")
    few = F.col("words") < MIN_WORDS
    poor = 100 * F.col("distinct") < DISTINCT_PERCENT * F.col("words")
    copy = F.col("doc_id") > F.col("first")
    said = lambda condition, letter: F.when(condition, letter).otherwise("")
    fails = F.concat(said(few, "A"), said(poor, "B"), F.col("fails"), said(copy, "E"))
    return joined.select("doc_id", "part", "words", "distinct", fails.alias("fails"))


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Per part, order of the filters and step: what is kept, removed and lost there.

    ``removed`` counts documents that fail this filter and none before it, ``redundant``
    those that fail it and one before. ``shapley`` is a filter's ``removed`` summed over
    all orders: a document that fails k filters is removed by each in one of k orders.
    """
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(part).alias("part"), F.col(text).alias("text"))
    found = failures(named)
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("labelled"))
    marks = marks.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad"))
    marked = found.join(marks, F.col("doc_id") == F.col("labelled"), "left")
    one = lambda name: F.coalesce(F.col(name), F.lit(0)).alias(name)
    counts = marked.groupBy("part", "fails", one("good"), one("bad")).agg(F.count(F.lit(1)).alias("rows"))

    orders = ["".join(p) for p in permutations(FILTERS)]
    ordered = counts.withColumn("filter_order", F.explode(F.array(*[F.lit(o) for o in orders])))
    steps = ordered.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    earlier = F.expr("left(filter_order, step - 1)")
    fails = F.col("fails").contains(letter)
    gone = F.call_function("translate", F.col("fails"), earlier, F.lit("")) != F.col("fails")
    share = F.lit(len(orders)) * F.col("rows") / F.greatest(F.length("fails"), F.lit(1))

    def total(condition, value="rows"):
        value = F.col(value) if isinstance(value, str) else value
        return F.sum(F.when(condition, value).otherwise(0)).cast("bigint")

    return steps.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("fails") == letter).alias("unique_fails"),
        total(fails & ~gone & (F.col("good") == 1)).alias("good_lost"),
        total(fails & ~gone & (F.col("bad") == 1)).alias("toxic_lost"),
        total(fails, share).alias("shapley"),
    )
