"""Quality by importance resampling.

Two generative models, bags of hashed words and word pairs, are estimated: one
of target texts (labelled good) and one of all texts. The log weight of a text
is the sum over its n-grams of the log ratio of both models. A text is kept if
its log weight plus Gumbel noise is among the k largest, which samples k texts
without replacement with chances in proportion to the weights.

Both models count in one pass over all documents; the target is every document
whose id is labelled good. The ids are a written and counted table: up to
``BROADCAST_IDS`` they are broadcast, so that no text moves; more are joined by
shuffling the texts once, with the same result. Noise is a hash of id and text, so
a repeated task draws the same. The k-th largest value is found by counting in bins
between smallest and largest, again within the bin that holds it, and ordering what
is left, so no task sees all rows.

Defined results: a NULL or word-less text has log weight 0; without words in any
target text all log weights are 0, which samples evenly; an id that is labelled
good more than once, or that no document has, changes nothing; rows equal in id and text
have the same noise and fall on the same side of the cut, also if that keeps
more than k; an empty table gives no rows; columns named like a result are
replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import with_new_columns, written

BUCKETS = 10_000
SMOOTHING = 1.0
KEPT_SHARE = 0.5
SEED = 17
ROWS_AT_ONCE = 256
# Bins of a histogram, and rows that are ordered without another one.
BINS, FEW = 1 << 14, 10_000
# Good ids that are broadcast, 16 MB of numbers.
BROADCAST_IDS = 2_000_000

_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _bucket(hashes: np.ndarray) -> np.ndarray:
    mixed = (hashes ^ hashes >> np.uint64(31)) * _MIX[1]
    return ((mixed ^ mixed >> np.uint64(29)) % np.uint64(BUCKETS)).astype(np.int64)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Place of the text and bucket of every word and every pair of neighbours."""
    words = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\p{L}\p{M}\p{N}]+", " ")
    words = pc.binary_join_element_wise("", pc.utf8_trim(words, " "), "", " ").cast(pa.large_string())
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    none = np.zeros(0, np.int64)
    if not len(words) or offsets[-1] == offsets[0]:
        return none, none
    data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    letter = data != 32
    starts = np.flatnonzero(letter & ~np.concatenate([[False], letter[:-1]]))
    if not len(starts):
        return none, none
    # Polynomial hash of each word: bytes weighed by their place in the word.
    place = np.flatnonzero(letter)
    first = np.concatenate([[0], np.cumsum(letter[:-1])]).astype(np.int64)[starts]
    within = np.arange(len(place)) - np.repeat(first, np.diff(np.append(first, len(place))))
    powers = np.multiply.accumulate(np.full(int(within.max()) + 1, 0x100000001B3, np.uint64))
    hashes = np.add.reduceat((data[place].astype(np.uint64) + np.uint64(1)) * powers[within], first)
    owner = np.searchsorted(offsets - offsets[0], starts, side="right") - 1
    same = owner[1:] == owner[:-1]
    pairs = (hashes[:-1] * _MIX[0] ^ hashes[1:] * _MIX[2])[same]
    return np.concatenate([owner, owner[1:][same]]), _bucket(np.concatenate([hashes, pairs]))


def log_ratios(docs: DataFrame, good: DataFrame, doc_id: str, text: str) -> np.ndarray:
    """Per bucket the log ratio of the model of texts with good ids to the model of all texts.

    ``good`` has one column of ids; repeats and NULL count for nothing.
    """
    ids = good.toDF("__key").filter("__key IS NOT NULL").distinct()
    ids = written(ids, "good-ids")
    way = "broadcast" if ids.count() <= BROADCAST_IDS else "shuffle_hash"
    ids = ids.withColumn("__target", F.lit(True)).hint(way)
    marked = docs.select(F.col(doc_id).cast("bigint").alias("__key"), F.col(text).alias("__text"))
    marked = marked.join(ids, "__key", "left").select("__text", F.coalesce("__target", F.lit(False)).alias("__target"))

    def count(batches):
        seen = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            target = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                owner, bucket = features(batch.column(0).slice(start, ROWS_AT_ONCE).cast(pa.string()))
                seen[0] += np.bincount(bucket, minlength=BUCKETS)
                seen[1] += np.bincount(bucket[target[start : start + ROWS_AT_ONCE][owner]], minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(seen[0]), pa.array(seen[1])], names=["bucket", "raw", "target"])

    sums = marked.mapInArrow(count, "bucket bigint, raw bigint, target bigint").groupBy("bucket").agg(F.sum("raw"), F.sum("target"))
    counts = np.zeros((2, BUCKETS))
    for bucket, raw, target in sums.collect():  # one row per bucket
        counts[:, bucket] = raw, target
    if not counts[1].any():
        return np.zeros(BUCKETS)
    chances = (counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    return np.log(chances[1]) - np.log(chances[0])


def weighed(docs: DataFrame, ratios: np.ndarray, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Add ``log_weight``."""
    base = with_new_columns(docs, "log_weight")
    kept = [c for c in base.columns if keep_text or c != text]
    place, places = docs.columns.index(text), [docs.columns.index(c) for c in kept]
    schema = base.select(*kept).schema.add("log_weight", "double")
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def weigh(batches):
        ratio = shared.value
        for batch in batches:
            found = [np.zeros(0)]
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.column(place).slice(start, ROWS_AT_ONCE).cast(pa.string())
                owner, bucket = features(some)
                found.append(np.bincount(owner, weights=ratio[bucket], minlength=len(some)))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in places] + [pa.array(np.concatenate(found))], names=[*kept, "log_weight"])

    return docs.mapInArrow(weigh, schema)


def _bin_of(counts: dict[int, int], wanted: int) -> tuple[int, int]:
    """From the top the bin with the wanted row, and which row of the bin it is."""
    for place in sorted(counts, reverse=True):
        if wanted <= counts[place]:
            return place, wanted
        wanted -= counts[place]
    raise ValueError("fewer rows than wanted")


def top_share(df: DataFrame, key: str, ties: list[str], share: float, few: int = FEW) -> DataFrame:
    """Add ``selected`` for the given share of rows with the largest key (ties: smaller first).

    ``df`` should be a written table; it is read a few times. Each round spreads the
    bins between the smallest and the largest key that are left, so no outlier, however
    far off, leaves the others in one bin for good.
    """
    spread = [F.min(key), F.max(key), F.count(F.lit(1))]
    inside, (low, high, rows) = df, df.agg(*spread).first()
    rank = round(rows * share)
    if not rank:
        return df.withColumn("selected", F.lit(False))
    while rows > few and (width := (high - low) / BINS) > 0:
        place = F.least(F.lit(BINS - 1), F.floor((F.col(key) - low) / width)).cast("int")
        counts = {r[0]: r[1] for r in inside.groupBy(place.alias("bin")).count().collect()}  # one row per bin
        bin_of_last, rank = _bin_of(counts, rank)
        inside = inside.filter(place == bin_of_last)
        low, high, rows = inside.agg(*spread).first()
    order = [F.desc(key), *[F.asc_nulls_last(t) for t in ties]]
    last = inside.select(key, *ties).orderBy(*order).offset(rank - 1).first()
    before, equal = F.col(key) > last[key], F.col(key) == last[key]
    for t in ties:
        value = F.lit(last[t])
        smaller = F.col(t) < value if last[t] is not None else F.col(t).isNotNull()
        before, equal = before | (equal & F.coalesce(smaller, F.lit(False))), equal & F.col(t).eqNullSafe(value)
    return df.withColumn("selected", before | equal)


def resample(
    docs: DataFrame,
    labels: DataFrame,
    share: float = KEPT_SHARE,
    doc_id: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    seed: int = SEED,
) -> DataFrame:
    """``doc_id``, ``log_weight``, ``key`` (with noise) and ``selected`` for every document."""
    good = labels.filter(F.col(quality) == 1).select(F.col(doc_id).cast("bigint").alias("__id"))
    ratios = log_ratios(docs, good, doc_id, text)
    rows = docs.select(F.col(doc_id).alias("__doc"), F.col(text).alias("__text"), F.xxhash64(doc_id, text, F.lit(seed)).alias("__tie"))
    # 52 bits of the hash, off 0 and 1, are an even chance; its Gumbel quantile is the noise.
    chance = (F.shiftrightunsigned("__tie", 12).cast("double") + 0.5) / float(1 << 52)
    noise = -F.ln(-F.ln(chance))
    slim = weighed(rows, ratios, "__text", keep_text=False).withColumn("key", F.col("log_weight") + noise)
    marked = top_share(written(slim, "weights"), "key", ["__doc", "__tie"], share)
    return marked.select(F.col("__doc").alias(doc_id), "log_weight", "key", "selected")
