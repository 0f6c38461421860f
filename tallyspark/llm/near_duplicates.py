"""SimHash near-duplicates through Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into three segments. If two fingerprints differ
in at most four bits, either two of the segments differ in at most one bit
each, or one segment is equal and both others differ in two bits.

* First case: with x and y one bit apart in segments i and j, the home codeword
  of x in i is near y, and the home codeword of y in j is near x. So every
  fingerprint gets the keys (home in i, each near one in j) and (each near one
  in i, home in j); both share the key (home of x, home of y).
* Second case: the equal segment together with each third of the next segment,
  of which at least one is equal.

That is 42 keys at most. Fingerprints that share a key are compared exactly, so
keys only decide what is compared and no link within four bits is lost.

Equal fingerprints are one node. Within a key, links are found by a search that
compares each fingerprint only to those not reached yet and emits one link per
fingerprint reached, never all pairs. A key with very many fingerprints is cut
into chunks, and each pair of chunks is searched by a task of its own.

Defined results: a text that is NULL or without words has the fingerprint zero,
linked like any other; a text of fewer words than a shingle is one shingle;
repeated rows count as copies; a NULL doc_id is no candidate for the smallest
id, and the id is NULL where a component has no other; columns named like a
result are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import with_new_columns, written
from tallyspark.llm.components import components
from tallyspark.llm.golay import NEAR, Golay

SEED = 42
MOST_BITS = 4
# Bits of the segments, from the lowest; and of the thirds of each.
SEGMENTS = (22, 21, 21)
# Rows of a key beyond which it is split; runs up to SHORT are compared pairwise.
CHUNK = 20_000
SHORT = 8
ROWS_AT_ONCE = 512
CELLS = 1 << 22

_BITS_OF_BYTE = ((np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1).astype(np.int64)


def shingle_digests(text: bytes | None, words: int) -> bytes:
    """Hashes of all word shingles, repeats included, 8 bytes each.

    Only A-Z are lower-cased and words end at ASCII white space, which is what
    ``lower`` and ``split`` of bytes do.
    """
    parts = text.lower().split() if text else []
    if not parts:
        return b""
    digest = xxhash.xxh64_digest
    if len(parts) <= words:
        return digest(b" ".join(parts), SEED)
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = np.concatenate([[0], ends[:-words]]).tolist()
    ends = (ends[words - 1 :] - 1).tolist()
    return b"".join([digest(joined[s:e], SEED) for s, e in zip(starts, ends, strict=True)])


def majorities(digests: list[bytes]) -> np.ndarray:
    """Per text the bits that over half of its hashes have."""
    counts = np.array([len(d) // 8 for d in digests])
    hashes = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8)
    owner = np.repeat(np.arange(len(digests)), counts) * 256
    out = np.zeros(len(digests), np.uint64)
    for place in range(8):  # the digest is big-endian
        seen = np.bincount(owner + hashes[:, place], minlength=len(digests) * 256).reshape(-1, 256)
        bits = (2 * (seen @ _BITS_OF_BYTE) > counts[:, None]).astype(np.uint64)
        byte = bits @ (np.uint64(1) << np.arange(8, dtype=np.uint64))
        out |= byte << np.uint64(8 * (7 - place))
    return out


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 4, keep_text: bool = True) -> DataFrame:
    """Add ``fingerprint``, the 64 bits as a (signed) long."""
    base = with_new_columns(docs, "fingerprint")
    kept = [c for c in base.columns if keep_text or c != text]
    place, places = docs.columns.index(text), [docs.columns.index(c) for c in kept]
    schema = base.select(*kept).withColumn("fingerprint", F.lit(0).cast("bigint")).schema

    def run(batches):
        for batch in batches:
            column, found = batch.column(place).cast(pa.binary()), []
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                texts = column.slice(start, ROWS_AT_ONCE).to_pylist()
                found.append(majorities([shingle_digests(t, shingle) for t in texts]).view(np.int64))
            new = pa.array(np.concatenate(found) if found else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in places] + [new], names=[*kept, "fingerprint"]
            )

    return docs.mapInArrow(run, schema)


def hex_of(fingerprint) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def golay_keys(values: np.ndarray, code: Golay) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints and for each key the place of its fingerprint."""
    rows = np.arange(len(values))
    segments, at = [], 0
    for bits in SEGMENTS:
        segments.append(((values >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64))
        at += bits
    near = [code.near(s) for s in segments]
    keys, owners = [], []
    for kind, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        (ci, ni), (cj, nj) = near[i], near[j]
        home_i, home_j = ci[:, 0].astype(np.int64), cj[:, 0].astype(np.int64)
        for n in range(NEAR):
            some = rows[n < nj]
            keys.append(kind << 24 | home_i[some] << 12 | cj[some, n])
            owners.append(some)
            some = rows[(n < ni) & (n > 0)]  # both homes together are there already
            keys.append(kind << 24 | ci[some, n].astype(np.int64) << 12 | home_j[some])
            owners.append(some)
    for i in range(3):
        j = (i + 1) % 3
        third = -(-SEGMENTS[j] // 3)
        for part in range(3):
            piece = (segments[j] >> (part * third)) & ((1 << third) - 1)
            keys.append((3 + 3 * i + part) << 40 | segments[i] << 8 | piece)
            owners.append(rows)
    return np.concatenate(keys), np.concatenate(owners)


def _keyed(nodes: DataFrame, words: list[str], keyed_by: list[str]) -> DataFrame:
    """A row with the words of the fingerprint for every key of the keyed ones."""
    names, places = nodes.columns, [nodes.columns.index(w) for w in words]

    def run(batches):
        code = Golay()
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in places]
            for number, name in enumerate(keyed_by):
                values = batch.column(names.index(name)).to_numpy(zero_copy_only=False)
                keys, owners = golay_keys(values.view(np.uint64), code)
                keys |= number << 56
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), *[pa.array(c[owners]) for c in columns]], names=["key", *words]
                )

    return nodes.mapInArrow(run, "key bigint, " + ", ".join(f"{w} bigint" for w in words))


def _close(a: np.ndarray, b: np.ndarray, most_bits: int) -> np.ndarray:
    """Whether fingerprints (last axis: their words) differ in few enough bits."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64) <= most_bits


def reached_links(values: np.ndarray, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among fingerprints, as pairs of places.

    Each one is compared, when its turn comes, to those that no link has
    reached yet; so a dense group costs little more than its size.
    """
    left, waiting = np.arange(1, len(values)), [0]
    a, b = [], []
    while len(left):
        if not waiting:
            waiting, left = [left[0]], left[1:]
            continue
        some = np.array(waiting[: max(1, CELLS // max(1, values.shape[1] * len(left)))])
        waiting = waiting[len(some) :]
        close = _close(values[some][:, None], values[left][None, :], most_bits)
        hit = close.any(axis=0)
        if hit.any():
            a.append(some[close[:, hit].argmax(axis=0)])
            b.append(left[hit])
            waiting += left[hit].tolist()
            left = left[~hit]
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def nearest_links(values: np.ndarray, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links in which every link is as short as can be.

    Whatever two fingerprints are connected by links of up to some number of
    bits, they are also connected by links of the forest of up to as many.
    """
    left = np.arange(1, len(values))
    parent = np.zeros(len(left), np.int64)
    bits = np.bitwise_count(values[left] ^ values[0]).sum(axis=-1, dtype=np.int64)
    a, b = [], []
    while len(left):
        at = int(bits.argmin())
        if bits[at] <= most_bits:
            a.append(parent[at])
            b.append(left[at])
        new = left[at]
        left[at], parent[at], bits[at] = left[-1], parent[-1], bits[-1]
        left, parent, bits = left[:-1], parent[:-1], bits[:-1]
        own = np.bitwise_count(values[left] ^ values[new]).sum(axis=-1, dtype=np.int64)
        nearer = own < bits
        parent[nearer], bits[nearer] = new, own[nearer]
    return np.array(a, np.int64), np.array(b, np.int64)


def links_between(values: np.ndarray, most_bits: int, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All links between members of different groups."""
    none = np.zeros(0, np.int64)
    a, b = [none], [none]
    rows = max(1, CELLS // max(1, values.size))
    for start in range(0, len(values), rows):
        some = values[start : start + rows]
        close = _close(some[:, None], values[None, start:], most_bits)
        close &= groups[start : start + rows, None] != groups[None, start:]
        first, second = np.nonzero(close)
        once = first < second
        a.append(first[once] + start)
        b.append(second[once] + start)
    return np.concatenate(a), np.concatenate(b)


def _links_of_runs(
    keys: np.ndarray,
    values: np.ndarray,
    most_bits: int,
    nodes: np.ndarray | None = None,
    groups: np.ndarray | None = None,
    search: Callable = reached_links,
) -> np.ndarray:
    """Pairs of nodes (the first words if not given) linked within runs of equal keys.

    Rows are sorted by key and node. With groups only what links different ones counts.
    """
    nodes = values[:, 0] if nodes is None else nodes
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
    keys, values, nodes = keys[fresh], values[fresh], nodes[fresh]
    groups = None if groups is None else groups[fresh]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    sizes = np.diff(np.append(starts, len(keys)))
    length = np.repeat(sizes, sizes)
    found = [np.zeros((0, 2), np.uint64)]
    short = np.flatnonzero((length > 1) & (length <= SHORT))
    for step in range(1, min(SHORT, len(short))):
        first = short[: len(short) - step]
        second = short[step:]
        same = keys[first] == keys[second]
        first, second = first[same], second[same]
        good = _close(values[first], values[second], most_bits)
        if groups is not None:
            good &= groups[first] != groups[second]
        found.append(np.stack([nodes[first[good]], nodes[second[good]]], axis=1))
    for start, size in zip(starts[sizes > SHORT], sizes[sizes > SHORT], strict=True):
        run = slice(start, start + size)
        if groups is None:
            a, b = search(values[run], most_bits)
        else:
            a, b = links_between(values[run], most_bits, groups[run])
        found.append(np.stack([nodes[start + a], nodes[start + b]], axis=1))
    pairs = np.sort(np.concatenate(found), axis=1)
    return np.unique(pairs, axis=0).view(np.int64) if len(pairs) else pairs.view(np.int64)


def links(
    nodes: DataFrame,
    most_bits: int = MOST_BITS,
    chunk: int = CHUNK,
    words: tuple[str, ...] = ("node",),
    keyed_by: tuple[str, ...] = ("node",),
    node: str = "node",
    group: str | None = None,
    search: Callable = reached_links,
) -> DataFrame:
    """Links ``a``, ``b`` that connect what is linked among distinct fingerprints.

    The fingerprint that counts is made of ``words``; ``node`` tells nodes apart,
    and the keys come from ``keyed_by``. If all are the same single fingerprint, the result is complete up to ``MOST_BITS`` bits.
    With a column ``group`` the result is all links between different groups.
    ``nodes`` should be a written table; it is read twice.
    """
    words = list(words)
    carried = [node, *(w for w in words if w != node), *([group] if group else [])]
    keyed = _keyed(nodes, carried, list(keyed_by))
    # Keys with more rows than a chunk: first count coarse classes of keys, which
    # are so many that an ordinary class stays below the size of a chunk.
    classes = max(64, -(-nodes.count() * len(keyed_by) * 42 * 4 // chunk))
    key_class = F.pmod(F.xxhash64("key"), F.lit(classes))
    heavy = keyed.groupBy(key_class.alias("class")).count().filter(F.col("count") > chunk)
    if heavy.isEmpty():
        dealt = keyed.withColumns({"lo": F.lit(0), "hi": F.lit(0)})
    else:
        hot = written(
            keyed.withColumn("class", key_class)
            .join(heavy.select("class"), "class", "left_semi")
            .groupBy("key")
            .count()
            .filter(F.col("count") > chunk)
            .select("key", F.ceil(F.col("count") / chunk).cast("int").alias("chunks")),
            "hot-keys",
        )
        own = F.pmod(F.xxhash64(node), F.col("chunks")).cast("int")
        others = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
        dealt = (
            keyed.join(hot, "key", "left")
            .fillna(1, ["chunks"])
            .withColumns({"own": own, "other": others})
            .select("key", *carried, F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
        )

    def run(batches):
        held: list[pa.RecordBatch] = []
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

        def found(table: pa.Table):
            key, lo, hi = (table.column(n).to_numpy() for n in ("key", "lo", "hi"))
            values = np.stack([table.column(w).to_numpy().view(np.uint64) for w in words], axis=1)
            # one number per (key, chunks): the place of the first row of the run
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
            groups = table.column(group).to_numpy() if group else None
            ids = table.column(node).to_numpy().view(np.uint64)
            both = _links_of_runs(np.cumsum(new), values, most_bits, ids, groups, search)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            first = [batch.column(n)[0].as_py() for n in ("key", "lo", "hi")]
            last = [batch.column(n)[batch.num_rows - 1].as_py() for n in ("key", "lo", "hi")]
            if first == last:  # one run only: it may go on
                if held and [held[-1].column(n)[held[-1].num_rows - 1].as_py() for n in ("key", "lo", "hi")] != first:
                    yield found(pa.Table.from_batches(held))
                    held = []
                held.append(batch)
                continue
            same = np.ones(batch.num_rows, bool)
            for n, value in zip(("key", "lo", "hi"), last, strict=True):
                same &= batch.column(n).to_numpy() == value
            cut = int(np.argmax(same))
            yield found(pa.Table.from_batches([*held, batch.slice(0, cut)]))
            held = [batch.slice(cut)]
        if held:
            yield found(pa.Table.from_batches(held))

    return (
        dealt.repartition("key", "lo", "hi")
        .sortWithinPartitions("key", "lo", "hi", node)
        .mapInArrow(run, "a bigint, b bigint")
    )


def _classes(marked: DataFrame, node: str, least: Column, linked: DataFrame) -> DataFrame:
    """Per node the smallest value of ``least`` in its component, as ``component``."""
    nodes = marked.groupBy(F.col(node).alias("node")).agg(F.min(least).alias("__least"))
    roots = components(linked)
    rooted = nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "__least")
    rooted = written(rooted, "rooted")
    smallest = rooted.groupBy("root").agg(F.min("__least").alias("component"))
    return written(rooted.join(smallest, "root").select(F.col("node").alias(node), "component"), "classes")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 4,
    most_bits: int = MOST_BITS,
) -> DataFrame:
    """Per document its id, ``fingerprint`` and ``component_id``, the smallest id reachable."""
    if not 0 <= most_bits <= MOST_BITS:
        raise ValueError(f"the keys are complete up to {MOST_BITS} bits")
    marked = written(
        fingerprints(docs.select(doc_id, text), text, shingle, keep_text=False), "fingerprints"
    )
    nodes = written(marked.select(F.col("fingerprint").alias("node")).distinct(), "nodes")
    classes = _classes(marked, "fingerprint", F.col(doc_id), links(nodes, most_bits))
    return marked.join(classes, "fingerprint").select(
        doc_id, "fingerprint", F.col("component").alias("component_id")
    )


# Near copies by similarity: fingerprints find candidates, the sets of shingles decide.
SHINGLE_WORDS, SIMILARITY = 5, 0.8
WIDE, KEYED = 3, 4
# Standard errors of the estimate that a candidate may be off: 0.6 % of the pairs
# that are just similar enough are further off.
MARGIN = 2.5
# Room for errors of doubles where counts of hashes are compared.
SLACK = 1e-6
_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def bits_for(similarity: float, bits: int = 64 * WIDE) -> int:
    """Bits in which texts of this Jaccard similarity differ, and ``MARGIN`` standard errors more.

    The cosine of the two sets is 2s / (1 + s), and a bit differs with the
    chance angle / pi.
    """
    share = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    return int(bits * share + MARGIN * np.sqrt(bits * share * (1 - share)))


def _several(hashes: list[np.ndarray], number: int) -> list[np.ndarray]:
    """Fingerprints from the given hashes and from further mixed ones, per text."""
    out = []
    for mix in _MIX[:number]:
        mixed = [(h ^ h >> np.uint64(31)) * mix for h in hashes]
        out.append(majorities([(m ^ m >> np.uint64(29)).astype(">u8").tobytes() for m in mixed]))
    return out


def shingle_set(text: bytes | None, shingle: int) -> np.ndarray:
    """The different hashes of the word shingles, in ascending order."""
    return np.unique(np.frombuffer(shingle_digests(text, shingle), ">u8").astype(np.uint64))


def wide_fingerprints(docs: DataFrame, text: str = "__text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """Replace the text by ``own_set``, a hash of its set of word shingles, ``w0`` to ``w2``,
    a fingerprint of 192 bits of that set, and ``k0`` to ``k3``, four of its set of words."""
    place, kept = docs.columns.index(text), [c for c in docs.columns if c != text]
    names = ["own_set", *(f"w{i}" for i in range(WIDE)), *(f"k{i}" for i in range(KEYED))]
    schema = docs.select(*kept).schema
    for name in names:
        schema = schema.add(name, "long")

    def run(batches):
        for batch in batches:
            column, found = batch.column(place).cast(pa.binary()), []
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                texts = column.slice(start, ROWS_AT_ONCE).to_pylist()
                sets = [shingle_set(t, shingle) for t in texts]
                digest = xxhash.xxh64_digest
                words = [
                    np.frombuffer(b"".join([digest(w, SEED) for w in set((t or b"").lower().split())]), ">u8").astype(np.uint64)
                    for t in texts
                ]
                own = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64)
                found.append(np.stack([own, *_several(sets, WIDE), *_several(words, KEYED)]).view(np.int64))
            new = np.concatenate(found, axis=1) if found else np.zeros((len(names), 0), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(docs_places[c]) for c in kept] + [pa.array(n) for n in new], names=[*kept, *names]
            )

    docs_places = {c: docs.columns.index(c) for c in kept}
    return docs.mapInArrow(run, schema)


def _sets(rows: DataFrame, shingle: int) -> DataFrame:
    """``node`` and its ``grams``, the set of hashes, for rows of ``node`` and ``__text``."""

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t, shingle) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            ends = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
            grams = pa.array(np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(ends, grams)], names=["node", "grams"]
            )

    return rows.select("node", "__text").mapInArrow(run, "node bigint, grams array<bigint>")


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a``, ``b`` of nodes with ``good``: whether the Jaccard similarity of
    their sets is at least this."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("__of_a")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("grams").alias("__of_b")), "b"
    )
    shared = F.size(F.array_intersect("__of_a", "__of_b"))
    either = F.size("__of_a") + F.size("__of_b") - shared
    return both.select("a", "b", (shared >= F.lit(similarity) * either - 1e-9).alias("good"))


def links_between_parts(members: DataFrame, sets: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Certain links, and the candidates that stay, between the parts of each ``root``.

    ``members`` has ``root``, ``part``, ``node`` and ``degree``. A node is seen by what its
    set and that of the hub (the node of most links) do not share. Two sets of sizes s and t are
    similar enough if they differ in at most a share of s + t, so with ``far``, the difference from the
    hub less that share of the own size, two nodes are

    * linked for certain if the sum of both is not above zero. Then all such nodes are linked to
      the one with the smallest ``far``, so one link of each part says all; these parts are the middle;
    * linked otherwise only if their differences share at least half of that sum. Then they also share
      one of the rarest of them, so far into both that as many are left. Only nodes that meet there are candidates.
    """
    share = (1 - similarity) / (1 + similarity)
    hubs = members.groupBy("root").agg(F.max_by("node", F.struct("degree", "node")).alias("node"))
    hubs = hubs.join(sets, "node").select("root", F.col("grams").alias("__hub"))
    off = F.concat(F.array_except("grams", "__hub"), F.array_except("__hub", "grams"))
    held = members.join(sets, "node").join(hubs, "root")
    held = held.select("root", "part", "node", F.size("grams").alias("size"), off.alias("off"))
    held = held.withColumns({"n_off": F.size("off"), "far": F.size("off") - F.lit(share) * F.col("size")})
    held = written(held, "differences")

    least = F.min(F.struct("far", "node"))
    middles = held.groupBy("root").agg(least.alias("middle"))
    parts = held.groupBy("root", "part").agg(least.alias("least")).join(middles, "root")
    parts = written(parts.withColumn("in_middle", F.col("least.far") + F.col("middle.far") <= 1e-9), "torn-parts")
    certain = parts.filter("in_middle AND least.node <> middle.node")
    certain = certain.select(F.col("least.node").alias("a"), F.col("middle.node").alias("b"))

    outside = parts.filter("NOT in_middle").groupBy("root").agg(F.min("least.far").alias("least_outside"))
    searched = parts.join(outside, "root").select("part", "in_middle", F.col("middle.far").alias("least_far"), "least_outside")
    searched = written(held.join(searched, "part"), "searched")
    grams = written(searched.select("root", "node", F.explode("off").alias("gram")), "grams-off")
    holders = grams.groupBy("root", "gram").agg(F.count(F.lit(1)).alias("holders")).filter("holders > 1")
    # How many of a difference are left, this one included, when the rarest come first.
    rest = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("holders"), F.desc("gram")))
    meeting = grams.join(holders, ["root", "gram"]).select("node", "gram", rest.alias("left"))

    def useful(other) -> Column:
        return 2 * F.col("left") >= F.col("far") + other - SLACK

    meeting = meeting.join(searched.drop("off"), "node")
    meeting = meeting.filter(useful(F.when(F.col("in_middle"), F.col("least_outside")).otherwise(F.col("least_far"))))
    meeting = written(meeting, "meeting")
    middle, others = meeting.filter("in_middle"), meeting.filter("NOT in_middle")
    both = others.filter(useful(F.col("least_outside")))

    def met(one: DataFrame, other: DataFrame, which: str) -> DataFrame:
        found = one.alias("x").join(
            other.alias("y"),
            F.expr(
                f"x.root = y.root AND x.gram = y.gram AND x.part <> y.part AND {which}"
                f" AND 2 * least(x.left, y.left) >= x.far + y.far - {SLACK}"
                f" AND abs(x.n_off - y.n_off) <= {share!r} * (x.size + y.size) + {SLACK}"
            ),
        )
        return found.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))

    candidates = met(middle, others, "true").union(met(both, both, "x.node < y.node")).distinct()
    return certain, written(candidates, "candidates")


def similar_links(
    nodes: DataFrame,
    texts_of: Callable[[DataFrame], DataFrame],
    similarity: float = SIMILARITY,
    shingle: int = SHINGLE_WORDS,
) -> DataFrame:
    """Links among ``nodes`` (a written table of different sets, with their fingerprints)
    that connect whatever is connected by candidates of at least this similarity.

    Candidates share a key and differ in few enough bits. First a forest of the
    nearest candidates is confirmed by the sets themselves. A forest that loses
    no link says all. Where it does, all links between parts that fell apart are
    found by the sets alone, so a refused link never hides another one.
    ``texts_of`` gives ``node`` and ``__text`` for a frame of nodes, repeats allowed.
    """
    words, keyed_by = tuple(f"w{i}" for i in range(WIDE)), tuple(f"k{i}" for i in range(KEYED))
    most_bits = bits_for(similarity)

    near = written(links(nodes, most_bits, words=words, keyed_by=keyed_by, search=nearest_links).distinct(), "near")
    ends = near.select(F.explode(F.array("a", "b")).alias("node"))
    needed = written(ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree")), "linked-nodes")
    # A node outside of all candidates is needed by no later step either.
    sets = written(_sets(texts_of(needed.select("node")), shingle).dropDuplicates(["node"]), "shingle-sets")
    first = written(confirmed(near, sets, similarity), "confirmed")
    good = first.filter("good").select("a", "b")
    refused = first.filter(~F.col("good"))
    if refused.isEmpty():
        return good
    # Refused links between different parts say which parts may have to be searched.
    parts = needed.join(components(good).withColumnRenamed("root", "part"), "node", "left")
    parts = written(parts.select("node", "degree", F.coalesce("part", "node").alias("part")), "parts")
    of_a, of_b = (parts.select(F.col("node").alias(c), F.col("part").alias(f"part_{c}")) for c in "ab")
    between = refused.select("a", "b").join(of_b, "b").select("a", "part_b").distinct().join(of_a, "a")
    between = between.filter("part_a <> part_b").select(F.col("part_a").alias("a"), F.col("part_b").alias("b"))
    torn = components(between).withColumnRenamed("node", "part")
    certain, candidates = links_between_parts(written(parts.join(torn, "part"), "torn"), sets, similarity)
    found = confirmed(candidates, sets, similarity).filter("good").select("a", "b")
    return written(good.union(certain).union(found), "similar")


def without_near_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """The documents with one of each group of near copies, the one of the smallest id.

    Two texts are linked if the Jaccard similarity of their sets of five-word
    shingles is at least this, and a group is what links connect. Candidates
    come from Golay keys of four fingerprints of the different words: a changed
    word changes one of them, but as many shingles as a shingle has words, so
    near copies differ in few of these bits. They are cut by a fingerprint of
    the shingles, and all that stay are compared by the sets themselves.
    Of rows equal in id and text one stays; a NULL id is the largest; texts
    without words are copies of each other.
    """
    own = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.col(doc_id).alias("__id"), own.alias("__hash"), F.col(text).alias("__text"))
    marked = written(wide_fingerprints(rows), "fingerprints")
    same = ["own_set", *(f"w{i}" for i in range(WIDE)), *(f"k{i}" for i in range(KEYED))]
    least = F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__hash").alias("hash"))
    # Rows of the same set are one node.
    nodes = marked.groupBy(*same).agg(F.min(least).alias("__first"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    def texts_of(some: DataFrame) -> DataFrame:
        firsts = nodes.join(some, "node", "left_semi").select("node", "__first.id", "__first.hash")
        found = rows.join(firsts, (F.col("__hash") == F.col("hash")) & F.col("__id").eqNullSafe(F.col("id")))
        return found.select("node", "__text")

    linked = similar_links(nodes.drop("__first"), texts_of, similarity)
    classes = _classes(nodes, "node", F.col("__first"), linked)
    stays = classes.select("component.*").distinct().select(F.col("id").alias("__id"), F.col("hash").alias("__hash"))
    # How often the row that stays is in the input: it may be repeated.
    counted = (
        marked.join(stays, [marked["__id"].eqNullSafe(stays["__id"]), marked["__hash"] == stays["__hash"]], "left_semi")
        .groupBy("__id", "__hash")
        .agg(F.count(F.lit(1)).alias("__copies"))
    )
    counted = written(counted.withColumnsRenamed({"__id": "__i", "__hash": "__h"}), "stays")
    kept = docs.withColumn("__own", own).join(
        counted, (F.col("__own") == F.col("__h")) & F.col(doc_id).eqNullSafe(F.col("__i"))
    )
    once = kept.filter("__copies = 1").select(*docs.columns)
    repeated = kept.filter("__copies > 1")
    if counted.filter("__copies > 1").isEmpty():
        return once
    return once.unionByName(repeated.dropDuplicates(["__i", "__h"]).select(*docs.columns))
