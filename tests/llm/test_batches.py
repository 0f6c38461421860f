"""Infilling forms, repeated lines, overlap of filters: against plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from conftest import plan
from llm_odd import no_docs, odd_docs, odd_texts  # noqa: F401

from tallyspark.llm import filter_audit, infilling, line_dedup

# --- infilling ----------------------------------------------------------------------------------

HARD = ["", "a", "ab", "é", "a é1\n\n\x00b", "ab<P>c", "<S", "x<", "日本 go!", "<M>", "word " * 3000, "𝒳𝒳abc", "x" * 70_000]


def plain_infill(doc_id, text, seed=1):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:low], units[low:high], units[high:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_infilling_equals_plain_python_and_can_be_undone(spark):
    rows = [(i, HARD[i % len(HARD)]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    made = infilling.restore(infilling.transform(docs)).collect()
    assert len(made) == 400
    for r in made:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_infill(r.doc_id, r.text)
        assert r.restored == r.text
    assert {r.form for r in made} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("limit", [1, 100, 1 << 20])
def test_slices_cover_every_row_once(limit):
    column = pa.array(["a" * 60, None, "", "b" * 200, "c", "d" * 99, "e"]).slice(1)
    parts = list(infilling.slices(column, limit))
    assert [s + i for s, n in parts for i in range(n)] == list(range(6))
    assert all(n == 1 or sum(len(v or "") for v in column.slice(s, n).to_pylist()) <= limit for s, n in parts)


def test_units_of_a_slice_are_views_of_its_own_texts():
    texts = pa.array(["skipped", "ab1", "", "é x", "zz"])
    got = infilling.units(texts.slice(1)).to_pylist()
    assert got == [["ab", "1"], [], ["é", " ", "x"], ["zz"]]


def test_infilling_of_odd_documents(spark, odd_docs, no_docs):
    made = infilling.restore(infilling.transform(odd_docs)).collect()
    assert len(made) == len(odd_texts())
    for r in made:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_infill(r.doc_id, r.text)
        assert r.restored == (r.text or "")
    assert infilling.restore(infilling.transform(no_docs)).count() == 0
    clash = odd_docs.withColumnRenamed("score", "Form").withColumnRenamed("ids", "restored").withColumnRenamed("items", "__h1")
    assert infilling.restore(infilling.transform(clash)).columns.count("form") == 1
    other = infilling.transform(spark.createDataFrame([(7, "one two")], "Text_id int, body string"), "Text_id", "body", seed=2)
    assert tuple(other.first())[2:] == plain_infill(7, "one two", 2)


# --- repeated lines -----------------------------------------------------------------------------


def plain_lines(rows, min_chars=20, min_docs=3):
    """(n_lines, n_dropped, kept text) of every row."""
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(table)
    number = lambda i: -(1 << 63) if i is None else i
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(number(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        gone = [len(holders[key(x)]) >= min_docs and max(holders[key(x)]) != number(i) for x in lines]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def line_rows(seed, n=300):
    """Documents over a few lines of very different frequency, some repeated within a document."""
    rng = np.random.default_rng(seed)
    lines = [f"  Line number {i} is long enough{' É' * (i % 3)} " for i in range(60)] + ["short", "", "x" * 19, "y" * 20, "é" * 20, "é" * 19]
    weights = 1 / np.arange(1, len(lines) + 1)
    rows = []
    for i in range(n):
        count = int(rng.integers(0, 12))
        chosen = [lines[j] for j in rng.choice(len(lines), count, p=weights / weights.sum())]
        rows.append((int(rng.integers(0, n)) if i % 7 else i, "\n".join(c.upper() if rng.random() < 0.3 else c for c in chosen)))
    return rows + [(None, rows[3][1]), (None, None), (5, rows[5][1]), rows[6]]


def dedup(docs, **more):
    kept = line_dedup.without_repeated_lines(docs, line_dedup.keep_bitmaps(docs, **more))
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in kept.collect()), key=repr)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_repeated_lines_equal_plain_python_over_few_and_many_ranges(spark, parts):
    rows = line_rows(4)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert dedup(docs) == plain_lines(rows)
        assert dedup(docs, min_docs=5, min_chars=30) == plain_lines(rows, 30, 5)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
@pytest.mark.parametrize("min_docs", [2, 3, 4])
def test_stream_decides_alike_however_ranges_and_batches_are_cut(size, min_docs):
    rng = np.random.default_rng(size * 10 + min_docs)
    rows = sorted({(int(k), 0, -int(d), int(p)) for k, d, p in zip(rng.geometric(0.2, 400), rng.integers(0, 40, 400), rng.integers(0, 3, 400), strict=True)})
    holders = defaultdict(set)
    for k, _, d, _ in rows:
        holders[k].add(-d)
    want = {(k, -d, p) for k, _, d, p in rows if len(holders[k]) >= min_docs and -d != max(holders[k])}
    # Ranges are cut between (hash, document), as the range partitioning does it.
    cuts = [0] + sorted({int(c) for c in rng.integers(0, len(rows), 12)}) + [len(rows)]
    cuts = [next((j for j in range(c, len(rows)) if j == 0 or rows[j][:3] != rows[j - 1][:3]), len(rows)) for c in cuts]
    dropped, undecided, edges = set(), [], defaultdict(list)
    for start, stop in zip(cuts, cuts[1:], strict=False):
        part = rows[start:stop]
        columns = [[r[0] for r in part], [0] * len(part), [-r[2] for r in part], [0] * len(part)]
        arrays = [pa.array(c, pa.int64()) for c in columns] + [pa.array([0] * len(part), pa.int32()), pa.array([r[3] for r in part], pa.int32())]
        batch = pa.RecordBatch.from_arrays(arrays, names=line_dedup.LINE)
        found = [r for out in line_dedup.stream_first((batch.slice(i, size) for i in range(0, len(part), size)), min_docs) for r in out.to_pylist()]
        assert sum(r["state"] == line_dedup.EDGE for r in found) <= 2
        for r in found:
            if r["state"] == line_dedup.EDGE:
                edges[r["h1"]].append((r["docs"], r["doc"]))
            elif r["state"] == line_dedup.OPEN:
                undecided.append((r["h1"], r["doc"], r["pos"]))
            else:
                dropped.add((r["h1"], r["doc"], r["pos"]))
    for k, d, p in undecided:
        if sum(n for n, _ in edges[k]) >= min_docs and d != max(m for _, m in edges[k]):
            dropped.add((k, d, p))
    assert dropped == want


def test_bitmaps_are_small_and_say_which_lines_stay(spark):
    rows = [(i, "\n".join(["the same long line in all of them"] * 5 + [f"an own long line of document {i}"] * 3)) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    maps = line_dedup.keep_bitmaps(docs).collect()
    assert sorted((r.doc, r.n_lines, r.n_dropped) for r in maps) == [(i, 8, 5) for i in range(3)]
    assert all(line_dedup.unpacked(r.keep, r.n_lines).tolist() == [False] * 5 + [True] * 3 for r in maps)
    assert len(line_dedup.packed(1_000_000, np.arange(0, 500_000))) < 1000


def test_repeated_lines_of_odd_documents(spark, odd_docs, no_docs):
    assert dedup(odd_docs) == plain_lines(odd_texts())
    assert dedup(no_docs) == []
    clash = odd_docs.withColumnsRenamed({"score": "Keep", "ids": "row", "items": "doc", "shard": "n_lines"})
    made = line_dedup.without_repeated_lines(clash, line_dedup.keep_bitmaps(clash))
    assert made.count() == len(odd_texts()) and {"row", "doc", "kept_text"} <= set(made.columns)
    assert [c.lower() for c in made.columns].count("keep") == 1


# --- overlap of filters -------------------------------------------------------------------------


def plain_fails(rows):
    """(id, part, words, distinct, failed filters) of every row."""
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    out = []
    for i, text, part in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
        fails += "C" * (100 * len(re.findall("[A-Z]", text)) > 3 * len(text)) + "D" * bool(re.search(r"[#$%&*|]", text))
        fails += "E" * (i is not None and i > first[text])
        out.append((i, part or "", len(words), len(set(words)), fails))
    return out


def plain_audit(fails, labels):
    good, bad = ({i for i, *mark in labels if mark[at] == 1 and i is not None} for at in (0, 1))
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    out = {(p, "".join(o), s): dict.fromkeys(names, 0) for _, p, *_ in fails for o in permutations("ABCDE") for s in range(1, 6)}
    for order in permutations("ABCDE"):
        for i, part, _, _, failed in fails:
            gone = False
            for step, letter in enumerate(order, 1):
                cell = out[part, "".join(order), step]
                fits = letter in failed
                cell["removed"] += fits and not gone
                cell["redundant"] += fits and gone
                cell["unique_fails"] += failed == letter
                cell["good_lost"] += fits and not gone and i in good
                cell["toxic_lost"] += fits and not gone and i in bad
                gone = gone or fits
                cell["kept"] += not gone
    shapley = defaultdict(int)
    for (part, order, step), cell in out.items():
        shapley[part, order[step - 1]] += cell["removed"]
    for (part, order, step), cell in out.items():
        cell["shapley"] = shapley[part, order[step - 1]]
    return out


def audit_rows(seed=3, n=250):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Capital", "ALL", "é", "50%", "a|b", "x\x1cy", "　", " "]
    rows = []
    for i in range(n):
        words = rng.choice(vocabulary[: rng.integers(5, len(vocabulary))], rng.integers(0, 500)).tolist()
        rows.append((i, str(rng.choice([" ", "\n", "\t "])).join(words), ["en", "de", None, ""][i % 4]))
    return rows + [(n + i, rows[i % 5][1], "en") for i in range(60)] + [(None, rows[0][1], "fr"), (3, rows[3][1], "de"), (None, None, None)]


@pytest.mark.parametrize("shard_bytes", [1, 20_000, 1 << 30])
def test_failed_filters_equal_plain_python(spark, shard_bytes):
    rows = audit_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, part string").repartition(4)
    got = [tuple(r) for r in filter_audit.failures(docs, shard_bytes).select("doc_id", "part", "words", "distinct", "fails").collect()]
    assert sorted(got, key=repr) == sorted(plain_fails(rows), key=repr)


def test_matrix_has_global_columns_and_the_counts_of_the_words(spark):
    rows = audit_rows(n=60)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, part string").repartition(3)
    found, _ = filter_audit.numbered_words(filter_audit.local_shards(docs, 30_000))
    words = {r.word: r.term for r in found.collect()}
    assert sorted(words.values()) == list(range(len(words)))
    assert set(words) == {w.decode() for _, t, _ in rows for w in (t or "").encode().split()}
    texts = defaultdict(list)
    for i, text, _ in rows:
        texts[i].append(text or "")
    for shard in filter_audit.csr_shards(docs, 30_000).collect():
        indptr, indices, counts = (filter_audit.unpacked(bytes(p)) for p in (shard.indptr, shard.indices, shard.counts))
        for at, row in enumerate(shard.rows):
            span = slice(indptr[at], indptr[at + 1])
            have = dict(zip(indices[span].tolist(), counts[span].tolist(), strict=True))
            plain = [{words[w]: t.encode().split().count(w.encode()) for w in {b.decode() for b in t.encode().split()}} for t in texts[row.doc_id]]
            assert have in plain


def test_audit_equals_plain_python_in_every_order(spark):
    rows = audit_rows(7, 120)
    labels = [(i, int(i % 3 == 0), int(i % 5 == 0)) for i in range(0, 150, 2)] + [(0, 0, 0), (7, None, 1), (None, 1, 1), (9999, 1, 1)]
    docs = spark.createDataFrame([(i, t, p, "x", "y") for i, t, p in rows], "doc_id bigint, text string, lang string, rows string, part string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    want = plain_audit(plain_fails(rows), labels)
    made = filter_audit.audit(docs, marks)
    got = {(r.part, r.filter_order, r.step): r.asDict() for r in made.collect()}
    assert set(got) == set(want) and len(got) == 600 * len({p or "" for _, _, p in rows})
    for key, cell in want.items():
        assert {n: got[key][n] for n in cell} == {n: int(v) for n, v in cell.items()}, key
    assert "Cartesian" not in plan(made) and "NestedLoop" not in plan(made)


def test_audit_of_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (8, None, 1), (8, 1, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    got = filter_audit.audit(odd_docs, labels).collect()
    rows = [(r.doc_id, r.text, r.lang) for r in odd_docs.collect()]
    want = plain_audit(plain_fails(rows), [(1, 1, 0), (8, 1, 1)])
    assert {(r.part, r.filter_order, r.step): r.removed for r in got} == {k: int(v["removed"]) for k, v in want.items()}
    assert {(r.part, r.filter_order, r.step): r.good_lost for r in got} == {k: int(v["good_lost"]) for k, v in want.items()}
    assert filter_audit.audit(no_docs, labels).count() == 0
    assert filter_audit.audit(odd_docs, labels.filter("1 = 0")).agg({"toxic_lost": "sum"}).first()[0] == 0
