"""Benchmark decontamination by Wu-Manber search over words.

The strings searched for are the word windows of the benchmark items; the
alphabet is words. For each window length there is a table of shifts for blocks
of words: a block that ends no window lets the scan jump ahead. Where the shift
is zero, the block picks the bucket of windows that end in it, the first block
of a window is compared first and then the whole window.

Windows are cut and made distinct by Spark and written to the work folder in
portions of about ``WINDOWS_PER_PASS``, told apart by a hash. Texts stay where they
are: the search is one map over the documents, whose tasks hold some texts at a
time and load one portion after the other from the shared folder. What a task holds
is bounded whatever the size of the benchmark, no text is read twice, and neither
items nor windows meet the driver. The list of the items that share a window is as
long as the result for a document that holds it.

Defined results: a NULL or word-less text has no words and no hits; an item
without words has no window; an item with a NULL id marks words but is not
listed; equal items are listed each; repeated documents give repeated rows; an
empty benchmark marks nothing; columns of other names are kept, columns named
like a result are replaced.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyspark.llm.common import written
from tallyspark.session import fresh_dir

WINDOW_WORDS = 10
BLOCK_WORDS = 2
WINDOWS_PER_PASS = 100_000
# Texts that a task holds while it goes through more than one portion.
BYTES_AT_ONCE = 64 * 1024 * 1024

# Fixed rule: ASCII letters are lower-cased, words are runs of ASCII letters and
# digits and of everything beyond ASCII.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

RESULTS = ("n_words", "n_hit", "hit_spans", "items")


class WuManber:
    """Search for word windows of one length."""

    def __init__(self, windows: Iterable[tuple[tuple[bytes, ...], int]], length: int):
        self.length = length
        self.block = min(BLOCK_WORDS, length)
        self.most = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], dict[tuple[bytes, ...], list[int]]]] = {}
        for window, owner in windows:
            for end in range(self.block, length + 1):
                block = window[end - self.block : end]
                jump = length - end
                if jump < self.shift.get(block, self.most):
                    self.shift[block] = jump
            last, first = window[length - self.block :], window[: self.block]
            owners = self.buckets.setdefault(last, {}).setdefault(first, {}).setdefault(window, [])
            if owner not in owners:
                owners.append(owner)

    def find(self, words: list[bytes]) -> Iterator[tuple[int, list[int]]]:
        """Start and owners of every occurrence."""
        length, block, most, shift = self.length, self.block, self.most, self.shift.get
        end, n = length, len(words)
        while end <= n:
            tail = tuple(words[end - block : end])
            jump = shift(tail, most)
            if jump:
                end += jump
                continue
            start = end - length
            starts = self.buckets[tail].get(tuple(words[start : start + block]))
            if starts:
                owners = starts.get(tuple(words[start:end]))
                if owners is not None:
                    yield start, owners
            end += 1


def words_of(text: str | bytes | None) -> list[bytes]:
    if text is None:
        return []
    raw = text.encode() if isinstance(text, str) else text
    return WORD.findall(raw.lower())


def searchers_for(windows: list[tuple[tuple[bytes, ...], int]]) -> list[WuManber]:
    by_length: dict[int, list] = {}
    for window, owner in windows:
        by_length.setdefault(len(window), []).append((window, owner))
    return [WuManber(by_length[length], length) for length in sorted(by_length)]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """Every different window, its words joined by blanks, with the sorted ids of its items.

    A shorter item is one window, an item without words none. Ids are text; NULL ids
    are not listed.
    """
    lowered = F.translate(F.col(text), string.ascii_uppercase, string.ascii_lowercase)
    words = F.regexp_extract_all(lowered, F.lit(WORD_PATTERN), F.lit(0))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (WINDOW_WORDS - 1), F.lit(1)))
    windows = F.transform(starts, lambda start: F.array_join(F.slice("words", start, WINDOW_WORDS), " "))
    cut = benchmark.select(F.col(item).cast("string").alias("item"), words.alias("words")).filter(F.size("words") > 0)
    each = cut.select("item", F.explode(windows).alias("window"))
    return each.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _write_portions(benchmark: DataFrame, item: str, text: str, per_pass: int) -> str:
    """Folder of the written windows, one folder below it per portion."""
    windows = written(benchmark_windows(benchmark, item, text), "windows")
    portions = max(1, -(-windows.count() // per_pass))
    path = fresh_dir(benchmark.sparkSession, "portions")
    numbered = windows.withColumn("portion", F.pmod(F.xxhash64("window"), F.lit(portions)))
    numbered.repartition("portion").write.partitionBy("portion").parquet(path)
    return path


def _folders(path: str) -> list[str]:
    store, root = fs.FileSystem.from_uri(path)
    return sorted(f.path for f in store.get_file_info(fs.FileSelector(root)) if f.type == fs.FileType.Directory)


@lru_cache(maxsize=1)
def _loaded(path: str, folder: str) -> tuple[list[WuManber], pa.Array]:
    """Searchers of a portion and the items of its windows; the latest stays in the worker."""
    store, _ = fs.FileSystem.from_uri(path)
    rows = pq.read_table(folder, filesystem=store, partitioning=None)
    known: dict[bytes, bytes] = {}
    windows = []
    for number, window in enumerate(rows.column("window").cast(pa.binary())):
        words = window.as_py().split(b" ")
        windows.append((tuple(known.setdefault(word, word) for word in words), number))
    return searchers_for(windows), rows.column("items").combine_chunks()


class _Text:
    """A text's words and what the portions have marked in it so far."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.spans: list[tuple[int, int]] = []
        self.items: set[str] = set()

    def search(self, searchers: list[WuManber], items: pa.Array) -> None:
        found, owners = list(self.spans), set()
        for searcher in searchers:
            for start, hits in searcher.find(self.words):
                found.append((start, start + searcher.length))
                owners.update(hits)
        for owner in owners:
            self.items.update(items[owner].as_py())
        self.spans = _merged(found)


def _held(batches: Iterator[pa.RecordBatch], place: int, least: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in groups that end where their texts reach a number of bytes."""
    group: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        group.append(batch)
        size += batch.column(place).nbytes
        if size >= least:
            yield group
            group, size = [], 0
    if group:
        yield group


def _texts_of(column: pa.Array, known: dict[bytes, bytes]) -> list[_Text]:
    """The texts of a batch; equal words are one object."""
    texts = []
    for value in column:
        words = words_of(value.as_buffer().to_pybytes() if value.is_valid else None)
        texts.append(_Text([known.setdefault(word, word) for word in words]))
    return texts


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
FOUND = "n_words bigint, hit_spans array<struct<start:int,end:int>>, items array<string>"


def _found(texts: list[_Text]) -> list[pa.Array]:
    return [
        pa.array([len(t.words) for t in texts], pa.int64()),
        pa.array([[{"start": s, "end": e} for s, e in t.spans] for t in texts], SPANS),
        pa.array([sorted(t.items) for t in texts], pa.list_(pa.string())),
    ]


def _marked(docs: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str, per_pass: int) -> DataFrame:
    """The documents, columns numbered ``c0`` and on, with the columns of FOUND."""
    path = _write_portions(benchmark, item, item_text, per_pass)
    place = docs.columns.index(text)
    rows = docs.toDF(*_numbered(docs))
    schema = StructType([*rows.schema.fields, *StructType.fromDDL(FOUND).fields])

    def search(batches):
        folders = _folders(path)
        for group in _held(batches, place, BYTES_AT_ONCE if len(folders) > 1 else 1):
            known: dict[bytes, bytes] = {}
            texts = [_texts_of(batch.column(place), known) for batch in group]
            for folder in folders:
                searchers, items = _loaded(path, folder)
                for some in texts:
                    for one in some:
                        one.search(searchers, items)
            for batch, some in zip(group, texts, strict=True):
                yield pa.RecordBatch.from_arrays([*batch.columns, *_found(some)], names=schema.names)

    return rows.mapInArrow(search, schema)


def _numbered(docs: DataFrame) -> list[str]:
    return [f"c{place}" for place in range(len(docs.columns))]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    windows_per_pass: int = WINDOWS_PER_PASS,
) -> DataFrame:
    """Documents with ``n_words``, ``n_hit``, ``hit_spans`` (word positions,
    merged) and ``items`` (ids as text, sorted) of the windows that occur."""
    marked = _marked(docs, benchmark, text, item, item_text, windows_per_pass)
    hit = F.aggregate(
        "hit_spans", F.lit(0).cast("bigint"), lambda total, s: total + s["end"].cast("bigint") - s["start"]
    )
    own = [F.col(c).alias(n) for c, n in zip(_numbered(docs), docs.columns, strict=True) if n.lower() not in RESULTS]
    return marked.select(*own, "n_words", hit.alias("n_hit"), "hit_spans", "items")


def clean_documents(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    windows_per_pass: int = WINDOWS_PER_PASS,
) -> DataFrame:
    """The documents in which no window occurs, with their own columns only."""
    marked = _marked(docs, benchmark, text, item, item_text, windows_per_pass)
    return marked.filter(F.size("hit_spans") == 0).select(*_numbered(docs)).toDF(*docs.columns)


def items_digest(items) -> Column:
    """SHA-256 of the listed ids, joined by commas."""
    return F.sha2(F.concat_ws(",", items), 256)
