"""Language identification with bit-sliced Bloom filters.

Every language has a Bloom filter of the n-grams that are common in its texts.
The filters lie side by side: row ``r`` of the table is a bitmask of the
languages whose filter has bit ``r`` set. The AND of the few rows that an
n-gram hashes to is the bitmask of all languages that contain it. Per text the
masks are counted per language, the hits that a filter of this fill gives by
chance are taken off, and the language with the largest share of n-grams wins.

N-grams are byte n-grams of the lower-cased letters, words set apart by one
blank. The filters are built from a bounded sample: ``DOCS_PER_LANGUAGE`` texts
of every language, in hash order of the id. Texts are judged whole.

Defined results: ``und`` and score 0 for a text that is NULL or has no letter,
and for all texts if nothing was learned; a text too short for an n-gram, or
without any known one, gets the first language with score 0; ties go to the
language that sorts first; repeated rows are judged alike; rows with a NULL id,
text or language are not learned from; columns named like a result are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import first_by_hash, rows_for_keys, with_new_columns

GRAM_BYTES = 4
DOCS_PER_LANGUAGE = 1000
# An n-gram is common in a language if this share of its sampled texts has it.
COMMON_SHARE = 0.05
BITS_PER_GRAM, ROWS_PER_GRAM = 16, 3
UNKNOWN = "und"
# Share of n-grams below which a text is in none of the learned languages, and
# the n-grams that it takes to say so.
LEAST_SHARE, LEAST_GRAMS = 0.1, 20
ROWS_AT_ONCE, WINDOWS_AT_ONCE = 512, 1 << 18

RESULTS = ("lang_pred", "score", "coverage", "n_grams")

# Odd multipliers of the row hashes.
_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def letters_only(texts: pa.Array) -> pa.Array:
    """Lower-cased letters with one blank around each word; NULL is empty."""
    words = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\p{L}\p{M}]+", " ")
    return pc.binary_join_element_wise("", pc.utf8_trim(words, " "), "", " ")


def grams_of(texts: pa.Array, size: int):
    """Portions of (place of the text, n-gram as a number) over all whole texts."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or offsets[-1] == offsets[0]:
        return
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    mask = np.uint64((1 << (8 * size)) - 1)
    for start in range(0, len(data), WINDOWS_AT_ONCE):
        stop = min(start + WINDOWS_AT_ONCE, len(data))
        part = np.zeros(stop - start + 8, np.uint8)
        some = data[start : stop + 8]
        part[: len(some)] = some
        grams = np.ndarray((stop - start,), "<u8", part.tobytes(), strides=(1,)) & mask
        at = np.arange(start, stop)
        owner = np.searchsorted(offsets, at, side="right") - 1
        inside = at + size <= offsets[owner + 1]
        yield owner[inside], grams[inside]


@dataclass
class Filters:
    """Bit-sliced filters: ``rows`` has one byte per eight languages and row."""

    languages: list[str]
    rows: np.ndarray
    size: int

    @classmethod
    def build(cls, grams: dict[str, np.ndarray], size: int) -> Filters:
        languages = sorted(grams)
        most = max([1, *(len(g) for g in grams.values())])
        bits = max(10, int(np.ceil(np.log2(most * BITS_PER_GRAM))))
        rows = np.zeros((1 << bits, max(1, -(-len(languages) // 8))), np.uint8)
        filters = cls(languages, rows, size)
        for place, language in enumerate(languages):
            for index in filters.places(grams[language]):
                rows[index, place // 8] |= np.uint8(1 << place % 8)
        return filters

    def places(self, grams: np.ndarray):
        shift = np.uint64(64 - int(np.log2(len(self.rows))))
        for mix in _MIX[:ROWS_PER_GRAM]:
            mixed = (grams ^ (grams >> np.uint64(29))) * mix
            yield ((mixed ^ (mixed >> np.uint64(32))) * _MIX[3]) >> shift

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """Bitmask of all languages that (seem to) contain each n-gram."""
        found = None
        for index in self.places(grams):
            rows = self.rows[index]
            found = rows if found is None else found & rows
        return found

    def chance(self) -> np.ndarray:
        """Share of unknown n-grams that each filter takes for known."""
        bits = np.unpackbits(self.rows, axis=1, bitorder="little")[:, : len(self.languages)]
        return bits.mean(axis=0) ** ROWS_PER_GRAM

    def shares(self, texts: pa.Array) -> np.ndarray:
        """Per text and language the share of n-grams contained, chance hits taken
        off, and per text the number of n-grams."""
        n, width = len(texts), self.rows.shape[1]
        totals, hits = np.zeros(n), np.zeros((n, 8 * width))
        bit = ((np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1).astype(float)
        for owner, grams in grams_of(texts, self.size):
            totals += np.bincount(owner, minlength=n)
            masks = self.masks(grams)
            for byte in range(width):
                seen = np.bincount(owner * 256 + masks[:, byte], minlength=256 * n).reshape(n, 256)
                hits[:, 8 * byte : 8 * byte + 8] += seen @ bit
        chance = self.chance()
        share = hits[:, : len(self.languages)] / np.maximum(totals, 1)[:, None]
        return np.clip((share - chance) / np.maximum(1 - chance, 1e-9), 0, 1), totals


def learn(docs: DataFrame, allowed: Column, doc_id="doc_id", text="text", lang="lang", size=GRAM_BYTES) -> Filters:
    """Filters from a bounded sample of the rows with a language that are allowed."""
    spark = docs.sparkSession
    labelled = docs.filter(allowed & F.col(lang).isNotNull() & F.col(doc_id).isNotNull() & F.col(text).isNotNull())
    labelled = labelled.select(F.col(doc_id).cast("bigint").alias("__id"), F.col(lang).alias("__lang"), F.col(text).alias("__text"))
    picked = first_by_hash(labelled, ["__lang"], "__id", DOCS_PER_LANGUAGE)
    ids = sorted({row["__id"] for row in picked.select("__id").collect()})
    sample = rows_for_keys(spark, labelled, "__id", ids)

    def count(batches):
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                texts = letters_only(batch.column(2).slice(start, ROWS_AT_ONCE))
                names = langs[start : start + ROWS_AT_ONCE]
                number = {name: i for i, name in enumerate(sorted(set(names)))}
                of = np.array([number[name] for name in names])
                parts = [(o, g) for o, g in grams_of(texts, size)]
                if not parts:
                    continue
                pairs = np.stack([np.concatenate([o.astype(np.uint64) for o, _ in parts]), np.concatenate([g for _, g in parts])])
                pairs = np.unique(pairs, axis=1)  # once per text
                keyed = np.stack([of[pairs[0].astype(np.int64)].astype(np.uint64), pairs[1]])
                keyed, times = np.unique(keyed, axis=1, return_counts=True)
                named = sorted(number)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([named[int(i)] for i in keyed[0]]), pa.array(keyed[1].view(np.int64)), pa.array(times, pa.int64())],
                    names=["lang", "gram", "n"],
                )

    counts = sample.select("__id", "__lang", "__text").mapInArrow(count, "lang string, gram bigint, n bigint")
    texts = {r[0]: r[1] for r in sample.groupBy("__lang").count().collect()}
    least = F.create_map(*[F.lit(x) for k, v in texts.items() for x in (k, COMMON_SHARE * v)]) if texts else None
    grams: dict[str, list[int]] = {name: [] for name in texts}
    if texts:
        # At most (n-grams of a text) / COMMON_SHARE per language are common.
        common = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= least[F.col("lang")])
        for row in common.select("lang", "gram").collect():
            grams[row[0]].append(row[1])
    return Filters.build({k: np.array(v, np.int64).view(np.uint64) for k, v in grams.items()}, size)


def identify(docs: DataFrame, filters: Filters, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Add ``lang_pred``, ``score`` (share of the evidence that is for it),
    ``coverage`` (share of the n-grams that the language contains) and ``n_grams``."""
    base = with_new_columns(docs, *RESULTS)
    kept = [c for c in base.columns if keep_text or c != text]
    place, places = docs.columns.index(text), [docs.columns.index(c) for c in kept]
    schema = base.select(*kept).schema
    for name, kind in zip(RESULTS, ("string", "double", "double", "long"), strict=True):
        schema = schema.add(name, kind)
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def judge(texts: pa.Array):
        model = shared.value
        known = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        if not model.languages:
            known = np.zeros(len(texts), bool)
            share, grams = np.zeros((len(texts), 1)), np.zeros(len(texts))
        else:
            share, grams = model.shares(letters_only(texts))
        best = share.argmax(axis=1)
        cover = np.where(known, share[np.arange(len(share)), best], 0.0)
        total = share.sum(axis=1)
        score = np.where(known & (total > 0), cover / np.where(total > 0, total, 1), 0.0)
        names = np.array([*model.languages, UNKNOWN], object)[np.where(known, best, len(model.languages))]
        return names.tolist(), score, cover, grams.astype(np.int64)

    def run(batches):
        for batch in batches:
            names, numbers = [], []
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                some, *rest = judge(batch.column(place).slice(start, ROWS_AT_ONCE).cast(pa.string()))
                names += some
                numbers.append(rest)
            new = [np.concatenate(x) for x in zip(*numbers, strict=True)] or [np.zeros(0)] * 3
            new = [pa.array(x, t) for x, t in zip(new, (pa.float64(), pa.float64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in places] + [pa.array(names, pa.string()), *new], names=[*kept, *RESULTS]
            )

    return docs.mapInArrow(run, schema)


def foreign(lang_pred: Column, coverage: Column, n_grams: Column) -> Column:
    """Without a letter or, by enough n-grams, in none of the learned languages."""
    return (lang_pred == UNKNOWN) | ((coverage < LEAST_SHARE) & (n_grams >= LEAST_GRAMS))
