"""Repeated lines: one document keeps them, all others lose them.

The key of a line is the line without white space at its ends, in lower case
(ASCII). A key of at least ``MIN_CHARS`` characters in at least ``MIN_DOCS``
documents is kept in the document with the largest id and dropped elsewhere.

Hashes of the keys are dealt out in ranges of (hash, id), sorted by hash, then by
document from the largest id down, then by position, and streamed: the first
document of a hash is the one that keeps it. A hash with a third of all lines
covers many ranges, so no task sees all of it. A range does not know what its
neighbours hold of its first and last hash; it passes on those lines undecided
with one row of counts for each of the two hashes, and the counts of all ranges
(two rows a range at most) decide them. Only lines that go, or may go, leave a
range. They become one compressed bitmap per document that loses a line; a
document without a bitmap stays whole. Texts are never shuffled for the decision,
only met by their bitmaps.

A document is an id: rows with one id count once and each has its own bitmap.

Defined results: a NULL text is one empty line; a NULL id is an id smaller than
all others; equal rows have equal bitmaps; documents that lose all lines have an
empty text; an empty table gives no rows; columns named like a result are
replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.common import with_new_columns, written

# White space that is stripped, least length of a key, least number of documents.
SPACE = b" \t\n\x0b\x0c\r"
MIN_CHARS, MIN_DOCS = 20, 3
NO_ID = -(1 << 63)
LINES_AT_ONCE = 20_000
DROPPED, OPEN, EDGE = 0, 1, 2
LINE = ["h1", "h2", "doc", "row", "n_lines", "pos"]
LINE_SCHEMA = "h1 bigint, h2 bigint, doc bigint, row bigint, n_lines int, pos int"
RESULTS = ["n_lines", "n_dropped", "keep", "kept_text"]


def key_of(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The key of a line, or nothing if it is shorter than asked."""
    key = line.strip(SPACE).lower()
    if len(key) < min_chars or (not key.isascii() and len(key.decode()) < min_chars):
        return None
    return key


def _named(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """What names a row: its id and a hash of its text; and the text as bytes."""
    content = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(content).alias("row"),
        content.cast("binary").alias("text"),
    )


def hashed_lines(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """Two 64-bit hashes of the key of every line that is long enough, with its place."""

    def batch_of(found: list) -> pa.RecordBatch:
        digests = np.frombuffer(b"".join(f[0] for f in found), "<i8").reshape(-1, 2)
        columns = [digests[:, 0].copy(), digests[:, 1].copy()]
        columns += [np.array([f[i] for f in found], np.int64 if i < 3 else np.int32) for i in range(1, 5)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=LINE)

    def run(batches):
        found: list = []
        for batch in batches:
            for doc, row, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                lines = value.as_py().split(b"\n")
                for pos, line in enumerate(lines):
                    key = key_of(line, min_chars)
                    if key is not None:
                        found.append((xxhash.xxh3_128_digest(key), doc, row, len(lines), pos))
                    if len(found) == LINES_AT_ONCE:
                        yield batch_of(found)
                        found = []
        if found:
            yield batch_of(found)

    return _named(docs, doc_id, text).mapInArrow(run, LINE_SCHEMA)


class _Run:
    """The hash that the stream is in: its documents so far, and lines not decided yet."""

    def __init__(self, key: tuple[int, int], first_doc: int, edge: bool):
        self.key, self.first_doc, self.edge = key, first_doc, edge
        self.docs, self.last_doc = 0, first_doc
        self.held: list[pa.RecordBatch] = []


def stream_first(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Lines that go, lines to be decided by the counts of all ranges, and these counts.

    The batches are one range in order. The first hash may have begun in an earlier
    range: all its lines stay open. A later hash begins here, so its first document
    keeps it; lines of the others go as soon as ``min_docs`` documents were seen.
    Until then they are held, lines of ``min_docs - 2`` documents at most.
    """

    def marked(lines: pa.RecordBatch, state: int) -> pa.RecordBatch:
        count = len(lines)
        more = [pa.array(np.full(count, state, np.int8)), pa.array(np.zeros(count, np.int64))]
        return pa.RecordBatch.from_arrays([*lines.columns, *more], names=[*LINE, "state", "docs"])

    def edge(of: _Run) -> pa.RecordBatch:
        values = [*of.key, of.first_doc, 0, 0, 0, EDGE, of.docs]
        kinds = [*[pa.int64()] * 4, pa.int32(), pa.int32(), pa.int8(), pa.int64()]
        arrays = [pa.array([v], k) for v, k in zip(values, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=[*LINE, "state", "docs"])

    carried: _Run | None = None
    for batch in batches:
        if not len(batch):
            continue
        h1, h2, doc = (batch.column(i).to_numpy() for i in range(3))
        new_key = np.ones(len(batch), bool)
        new_key[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new_doc = new_key.copy()
        new_doc[1:] |= doc[1:] != doc[:-1]
        if carried is not None and (h1[0], h2[0]) == carried.key:
            new_key[0], new_doc[0] = False, doc[0] != carried.last_doc
        # Run 0 is the carried one, others are numbered from 1; documents are numbered within their run from 1.
        run = np.cumsum(new_key)
        ordinal = np.cumsum(new_doc)
        begun = ordinal[new_key] - 1
        ordinal = ordinal - np.concatenate([[-carried.docs if carried else 0], begun])[run]
        ends = np.flatnonzero(np.append(new_key[1:], True))
        docs = np.zeros(int(run[-1]) + 1, np.int64)
        docs[0] = carried.docs if carried else 0
        docs[run[ends]] = ordinal[ends]
        opened = 1 if carried is None else 0 if carried.edge else -1  # the run at the lower edge, if in this batch

        if carried is not None:
            carried.docs = int(docs[0])
            if not carried.edge and carried.docs >= min_docs:
                for lines in carried.held:
                    yield marked(lines, DROPPED)
                carried.held = []
            if run[-1] > 0 and carried.edge:
                yield edge(carried)
        elif run[-1] > 1:
            first = _Run((int(h1[0]), int(h2[0])), int(doc[0]), True)
            first.docs = int(docs[1])
            yield edge(first)
        if opened >= 0 and (run == opened).any():
            yield marked(batch.filter(pa.array(run == opened)), OPEN)
        later = (ordinal > 1) & (run != opened)
        gone = later & (docs[run] >= min_docs)
        if gone.any():
            yield marked(batch.filter(pa.array(gone)), DROPPED)

        last = int(run[-1])
        if last > 0:
            start = int(np.flatnonzero(new_key)[-1])
            carried = _Run((int(h1[start]), int(h2[start])), int(doc[start]), last == opened)
            carried.docs = int(docs[last])
        carried.last_doc = int(doc[-1])
        waiting = later & ~gone & (run == last)
        if waiting.any():
            carried.held.append(batch.filter(pa.array(waiting)))
    if carried is not None:
        for lines in carried.held:
            yield marked(lines, OPEN)
        yield edge(carried)


def packed(n_lines: int, dropped: np.ndarray) -> bytes:
    """A bit per line, set if the line stays, first line first, compressed."""
    keep = np.ones(n_lines, bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep).tobytes())


def unpacked(keep: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n_lines).astype(bool)


def keep_bitmaps(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """For every row that loses a line: ``doc`` and ``row`` (its name), ``n_lines``,
    ``n_dropped`` and ``keep``, the compressed bitmap of the lines that stay."""
    lines = hashed_lines(docs, doc_id, text, min_chars)
    dealt = lines.repartitionByRange("h1", "h2", F.desc("doc")).sortWithinPartitions("h1", "h2", F.desc("doc"), "row", "pos")
    schema = LINE_SCHEMA + ", state tinyint, docs bigint"
    marks = written(dealt.mapInArrow(lambda batches: stream_first(batches, min_docs), schema), "lines")
    counts = marks.filter(F.col("state") == EDGE).groupBy("h1", "h2")
    repeated = counts.agg(F.sum("docs").alias("__docs"), F.max("doc").alias("__keeper")).filter(F.col("__docs") >= min_docs)
    # Two rows a range at most, whatever the input: safe to broadcast.
    decided = marks.filter(F.col("state") == OPEN).join(F.broadcast(repeated), ["h1", "h2"])
    place = ["doc", "row", "n_lines", "pos"]
    gone = marks.filter(F.col("state") == DROPPED).select(*place)
    gone = gone.unionByName(decided.filter(F.col("doc") != F.col("__keeper")).select(*place))
    lists = gone.groupBy("doc", "row", "n_lines").agg(F.collect_set("pos").alias("places"))

    def run(batches):
        for batch in batches:
            places = batch.column(3)
            maps = [packed(n, p.values.to_numpy()) for n, p in zip(batch.column(2).to_pylist(), places, strict=True)]
            counts = [len(p) for p in places]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(counts, pa.int64()), pa.array(maps, pa.binary())],
                names=["doc", "row", "n_lines", "n_dropped", "keep"],
            )

    return lists.mapInArrow(run, "doc bigint, row bigint, n_lines int, n_dropped bigint, keep binary")


def without_repeated_lines(docs: DataFrame, bitmaps: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents with ``n_lines`` (before), ``n_dropped``, ``keep`` (NULL: all lines stay) and ``kept_text``."""
    base = with_new_columns(docs, *RESULTS)
    names = [f"__{i}" for i in range(len(base.columns))]
    labelled = docs.toDF(*[f"__{base.columns.index(c)}" if c in base.columns else f"__x{i}" for i, c in enumerate(docs.columns)])
    place = {c: labelled.columns[i] for i, c in enumerate(docs.columns)}
    content = F.coalesce(F.col(place[text]), F.lit(""))
    named = labelled.select(
        *names,
        content.cast("binary").alias("__text"),
        F.coalesce(F.col(place[doc_id]).cast("bigint"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(content).alias("row"),
    )
    met = named.join(bitmaps.drop("n_lines"), ["doc", "row"], "left").select(*names, "__text", "n_dropped", "keep")
    own = len(names)
    schema = T.StructType([T.StructField(n, base.schema[i].dataType) for i, n in enumerate(names)])
    for name, kind in zip(RESULTS, ("long", "long", "binary", "string"), strict=True):
        schema = schema.add(name, kind)

    def run(batches):
        for batch in batches:
            totals, kept = [], []
            for value, keep in zip(batch.column(own), batch.column(own + 2), strict=True):
                lines = value.as_py().split(b"\n")
                totals.append(len(lines))
                if keep.is_valid:
                    stays = unpacked(keep.as_py(), len(lines))
                    lines = [line for line, stay in zip(lines, stays.tolist(), strict=True) if stay]
                kept.append(b"\n".join(lines))
            new = [
                pa.array(totals, pa.int64()),
                batch.column(own + 1).fill_null(0),
                batch.column(own + 2),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:own], *new], names=[*names, *RESULTS])

    return met.mapInArrow(run, schema).toDF(*base.columns, *RESULTS)
