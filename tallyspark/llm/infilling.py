"""Fill-in-the-middle forms of documents, and the way back.

A text is cut into units: runs of ASCII letters, every other character alone.
Two drawn numbers of units part it into prefix, middle and suffix, which are
written in one of two orders behind marks, or the text stays plain. All draws
come from a hash of the id, so a repeated task draws the same.

Each batch is a pipeline of Arrow kernels: texts become lists of units, the lists
are flattened with the index of their text, every unit gets its ordinal and from
the two cuts its role, units of one role are filtered and put back into lists,
and the lists are joined to pieces and the pieces to the form. Units are views of
the batch's own characters. A batch is worked off in slices of ``SLICE_BYTES``,
one text at least, so memory grows with the longest text only.

Defined results: a NULL text counts as empty; an empty text and one that holds a
mark stay plain; a NULL id draws like an id of no digits; rows equal in id and
text give equal forms; an empty table gives no rows; columns named like a result
are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.common import with_new_columns

# The marks, and the shares of plain texts and of suffix-first forms in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ANY_MARK = "<[PSM]>"
PLAIN_FROM, SUFFIX_FIRST_BELOW = 90, 20
SEED = 1
SLICE_BYTES = 4 << 20
DRAWS = ["__h1", "__h2", "__h3", "__h4"]
RESULTS = ["n", "form", "prefix_chars", "middle_chars", "output"]


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers from the id: the first hex digits of a SHA-256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint").alias(name) for i, name in enumerate(DRAWS)]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Places and lengths of runs of rows of at most ``limit`` bytes, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start, used = 0, 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, used + limit, side="right")))
        yield start, stop - start
        start, used = stop, int(ends[stop - 1])


def units(texts: pa.StringArray) -> pa.ListArray:
    """Every text as the list of its units. Texts must not be NULL."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32, texts.offset + len(texts) + 1)[texts.offset :]
    data = texts.buffers()[2] or pa.py_buffer(b"")
    first, last = int(offsets[0]), int(offsets[-1])
    characters = np.frombuffer(data, np.uint8)[first:last]
    letter = (characters | 32) - np.uint8(97) < 26
    begins = characters & 0xC0 != 0x80  # not in the middle of a character
    begins[1:] &= ~(letter[1:] & letter[:-1])
    begins[offsets[:-1][np.diff(offsets) > 0] - first] = True
    starts = np.append(np.flatnonzero(begins) + first, last).astype(np.int32)
    flat = pa.StringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), data)
    lists = np.searchsorted(starts[:-1], offsets).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(lists), flat)


def pieces(listed: pa.ListArray, low: np.ndarray, high: np.ndarray) -> list[pa.Array]:
    """Prefix, middle and suffix of every list, cut before the units ``low`` and ``high``."""
    parents, flat = pc.list_parent_indices(listed), pc.list_flatten(listed)
    ordinals = pc.subtract(pa.array(np.arange(len(flat))), pc.take(listed.offsets.cast(pa.int64()), parents))
    passed = [pc.greater_equal(ordinals, pc.take(pa.array(cut), parents)).cast(pa.int8()) for cut in (low, high)]
    roles = pc.add(*passed)
    out = []
    for role in range(3):
        chosen = pc.equal(roles, role)
        counts = np.bincount(parents.filter(chosen).to_numpy(), minlength=len(listed))
        ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        out.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), flat.filter(chosen)), ""))
    return out


def infill(texts: pa.StringArray, drawn: list[np.ndarray]) -> list[pa.Array]:
    """The result columns of some texts and their four draws."""
    texts = pc.fill_null(texts, "")
    listed = units(texts)
    n = pc.list_value_length(listed).to_numpy().astype(np.int64)
    h1, h2, h3, h4 = drawn
    low, high = np.minimum(h1 % (n + 1), h2 % (n + 1)), np.maximum(h1 % (n + 1), h2 % (n + 1))
    prefix, middle, suffix = pieces(listed, low, high)
    plain = pc.or_(pc.match_substring_regex(texts, ANY_MARK), pa.array((n == 0) | (h3 % 100 >= PLAIN_FROM)))
    suffix_first = pa.array(h4 % 100 < SUFFIX_FIRST_BELOW)
    ordered = pc.if_else(
        suffix_first,
        pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, ""),
        pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, ""),
    )
    none = pa.scalar(None, pa.int64())
    return [
        pa.array(n),
        pc.if_else(plain, "plain", pc.if_else(suffix_first, "spm", "psm")),
        pc.if_else(plain, none, pc.utf8_length(prefix).cast(pa.int64())),
        pc.if_else(plain, none, pc.utf8_length(middle).cast(pa.int64())),
        pc.if_else(plain, texts, ordered),
    ]


def rebuilt(outputs: pa.StringArray, forms: pa.StringArray) -> pa.Array:
    """The texts that these outputs were made of."""
    moved = pc.not_equal(forms, "plain")
    parts = pc.split_pattern_regex(outputs.filter(moved), ANY_MARK)
    one, two, middle = (pc.list_element(parts, i) for i in (1, 2, 3))
    suffix_first = pc.equal(forms.filter(moved), "spm")
    prefix, suffix = pc.if_else(suffix_first, two, one), pc.if_else(suffix_first, one, two)
    return pc.replace_with_mask(outputs, moved, pc.binary_join_element_wise(prefix, middle, suffix, ""))


def transform(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, keep_text: bool = True
) -> DataFrame:
    """Documents with ``n`` (units), ``form`` (plain, psm or spm), ``prefix_chars``, ``middle_chars`` and ``output``."""
    base = with_new_columns(docs, *RESULTS, *DRAWS)
    kept = [c for c in base.columns if keep_text or c != text]
    places = [docs.columns.index(c) for c in kept]
    place, first = docs.columns.index(text), len(docs.columns)
    schema = T.StructType([base.schema[c] for c in kept])
    for name, kind in zip(RESULTS, ("long", "string", "long", "long", "string"), strict=True):
        schema = schema.add(name, kind)

    def run(batches):
        for batch in batches:
            for start, length in slices(batch.column(place)):
                part = batch.slice(start, length)
                drawn = [part.column(first + i).to_numpy(zero_copy_only=False) for i in range(len(DRAWS))]
                new = infill(part.column(place), drawn)
                yield pa.RecordBatch.from_arrays([part.column(i) for i in places] + new, names=[*kept, *RESULTS])

    names = [f"__{i}" for i in range(first)]
    numbered = docs.toDF(*names)
    return numbered.select(*names, *draws(F.col(names[docs.columns.index(doc_id)]), seed)).mapInArrow(run, schema)


def restore(made: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """Add ``restored``, the text rebuilt from output and form alone.

    No piece holds a mark, and marks neither overlap each other nor arise where
    pieces meet, so the marks found are those that were written.
    """
    base = with_new_columns(made, "restored")
    kept = base.columns
    places = [made.columns.index(c) for c in kept]
    at, kind = made.columns.index(output), made.columns.index(form)

    def run(batches):
        for batch in batches:
            for start, length in slices(batch.column(at)):
                part = batch.slice(start, length)
                new = rebuilt(part.column(at), part.column(kind))
                yield pa.RecordBatch.from_arrays([part.column(i) for i in places] + [new], names=[*kept, "restored"])

    return made.mapInArrow(run, T.StructType([base.schema[c] for c in kept]).add("restored", "string"))
