"""Fixity audit, url filter, top-k, sharding, near duplicates, components, pipeline, twins."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict
from itertools import combinations, product

import numpy as np
import pytest
import xxhash
from conftest import SMALL, plan
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from check import connect, difference
from llm_odd import ENGLISH, no_docs, odd_docs, odd_texts  # noqa: F401
from tallyspark.llm import fixity, near_duplicates, queries, sharding, top_k, url_filter
from tallyspark.llm.common import written
from tallyspark.llm.components import components
from tallyspark.llm.golay import Golay


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_result_as_sql(spark, duck, name):
    assert difference(entry_points.queries()[name](spark, SMALL), duck.sql(queries.ORACLE_SQL[name])) is None


def test_there_is_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= {*entry_points.queries()}


@pytest.mark.parametrize("name", ["op4_url_filter", "op8_hilbert_sharding"])
def test_native_operators_run_no_python(spark, name):
    text = plan(entry_points.queries()[name](spark, SMALL))
    assert not [bad for bad in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop") if bad in text]


# --- fixity -------------------------------------------------------------------------------------

ARCHIVE = "file bigint, offset bigint, length bigint, digest string, id bigint"


def archive(spark, rows):
    return spark.createDataFrame(rows, ARCHIVE).repartition(3)


def test_audit_finds_exactly_the_damage(spark):
    rng = np.random.default_rng(5)
    rows = []
    for file in range(3):
        at = 0
        for i in range(400):
            size = int(rng.integers(1, 60_000))
            rows.append((file, at, size, hashlib.sha256(f"{file}.{i}".encode()).hexdigest(), 1000 * file + i))
            at += size
    other, want = [], set()
    for n, (file, at, size, digest, i) in enumerate(rows):
        if n % 101 == 0:
            other.append((file, at, size, "0" * 64, i))
            want.add((file, at, "changed"))
        elif n % 103 == 0:
            want.add((file, at, "missing"))
        elif n % 107 == 0:
            other += [(file, at, size, digest, i)] * 2  # a copy too many
            want.add((file, at, "changed"))
        elif n % 109 == 0:
            other.append((file, at + 1, size, digest, i))
            want |= {(file, at, "missing"), (file, at + 1, "extra")}
        else:
            other.append((file, at, size, digest, i))
    other.append((9, 0, 1, None, 1))
    want.add((9, 0, "extra"))
    found = fixity.audit(archive(spark, rows), archive(spark, other), "id").collect()
    assert {(r.file, r.offset, r.status) for r in found} == want and len(found) == len(want)
    assert len(fixity.trees(written(fixity._leaves(archive(spark, rows), archive(spark, other), "id"), "x"))) > 2


def test_audit_of_odd_archives(spark):
    rows = [(None, 0, 1, "a", 1), (1, None, 1, "a", 1), (1, 0, None, None, None), (1, 5, 1, "b", 2), (1, 5, 1, "b", 2)]
    same = archive(spark, rows)
    assert fixity.audit(same, same, "id").count() == 0
    assert fixity.audit(same, same.filter("1 = 0"), "id").count() == 2
    assert fixity.audit(same.filter("1 = 0"), same.filter("1 = 0"), "id").count() == 0
    # The order of copies at one place does not matter, what they are does.
    a = archive(spark, [(1, 0, 1, d, 1) for d in ("x", "y", "z")])
    b = archive(spark, [(1, 0, 1, d, 1) for d in ("z", "x", "y")])
    c = archive(spark, [(1, 0, 1, d, 1) for d in ("x", "x", "z")])
    assert fixity.audit(a, b, "id").count() == 0 and fixity.audit(a, c, "id").count() == 1


def test_offsets_follow_the_lengths(spark):
    df = spark.createDataFrame([(1, i, 10 * i) for i in range(1, 5)], "file int, id int, length bigint")
    assert [r.offset for r in fixity.placed(df, "file", ["id"]).orderBy("id").collect()] == [0, 10, 30, 60]


# --- url filter ---------------------------------------------------------------------------------

URLS = [
    None,
    "",
    "no url",
    "http://",
    "HTTP://WWW.Example.COM/en/1",
    "http://example.com",
    "http://example.com?x=/en/",
    "https://a.b.example.com/en/x#y",
    "https://notexample.com/en/x",
    "https://com/a",
    "https://x.net/es/1?u=http://a.com/",
    "https://x.net/es",
    "https://x.net/fr/1",
    "https://x.net/fr/1",
    "https://ÄÖ.com/É",
    "https://q.org/" + "a" * 3000,
    "x://y.org/\nen",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:end], rest[end:]
    cut = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail[:cut]


def by_rule(host, path):
    fits = [
        r for r in queries.URL_RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fits, key=lambda r: len(r.name), default=None)


def plain_scores(urls):
    """The ratio of both models, with dictionaries; all sequences kept."""
    texts = {u: (u or "") + url_filter.END for u in urls}
    marked = {texts[u]: by_rule(*parts(u)) for u in urls}
    return texts, {t: r.verdict == "allow" for t, r in marked.items() if r is not None}


def test_urls_by_rule_and_by_model(spark):
    made = [f"https://h{i % 7}.example.{t}/{p}/{i}" for i in range(120) for t in ("com", "net", "org") for p in ("en", "fr", "de")]
    urls = URLS + made
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id int, url string, Host string")
    rows = sorted(url_filter.judge(pages.repartition(4), queries.URL_RULES).collect(), key=lambda r: r.page_id)
    assert [(r.host, r.path) for r in rows] == [parts(u) for u in urls]
    for row in rows:
        rule = by_rule(row.host, row.path)
        assert row.rule == (rule.name if rule else None)
        assert row.verdict in ("allow", "block") and (rule is None or row.verdict == rule.verdict)
    texts, examples = plain_scores(urls)
    back = {r[0] for r in spark.createDataFrame([(t,) for t in examples], "t string").filter(
        F.pmod(F.xxhash64("t"), F.lit(url_filter.HELD_BACK)) == 0).collect()}
    counts = {True: Counter(), False: Counter()}
    for text, accepted in examples.items():
        if text not in back:
            for at in range(len(text)):
                counts[accepted].update(text[max(0, at - k + 1) : at + 1] for k in range(1, min(at + 1, url_filter.ORDER) + 1))
    totals = {v: defaultdict(int) for v in counts}
    for v, c in counts.items():
        for gram, n in c.items():
            totals[v][(len(gram), gram[:-1])] += n

    def chance(v, gram):
        lower = chance(v, gram[1:]) if len(gram) > 1 else 1 / url_filter.ALPHABET
        return (counts[v][gram] + lower) / (totals[v][(len(gram), gram[:-1])] + 1)

    for row in rows:
        text, total = texts[row.url], 0.0
        for at in range(len(text)):
            gram = text[max(0, at + 1 - url_filter.ORDER) : at + 1]
            total += math.log(chance(True, gram)) - math.log(chance(False, gram))
        assert abs(row.score - total / len(text)) < 1e-9
    # Both are models: after any context, known or not, the chances of all characters add up to one.
    alphabet = {c for t in examples for c in t}
    unseen = url_filter.ALPHABET - len(alphabet)
    for context in ("", "e", "tt", "htt", "/en", "qqq", "e\x00"):
        for v in counts:
            others = unseen * chance(v, context + "\uffff")
            assert abs(sum(chance(v, context + c) for c in alphabet) + others - 1) < 1e-9
    free = [r for r in rows if r.rule is None and r.url in made]
    assert {r.verdict for r in free if "net/de" in r.url} and len({r.verdict for r in free}) == 2


@pytest.mark.parametrize("frequent", [1 << 16, 100])
def test_urls_are_scored_by_every_sequence_of_the_examples(spark, monkeypatch, frequent):
    monkeypatch.setattr(url_filter, "FREQUENT", frequent, raising=False)
    rng = np.random.default_rng(4)
    tails = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz0123456789"), 20)) for _ in range(600)]
    urls = [f"https://x.{t}/fr/{tail}" for tail, t in zip(tails, ["com", "net", "org"] * 200, strict=True)]
    urls += [f"https://y.org/{tail}" for tail in tails[:200]] + urls[:3]
    pages = spark.createDataFrame([(u,) for u in urls], "url string").withColumn(
        "back", F.pmod(F.xxhash64(F.concat("url", F.lit(url_filter.END))), F.lit(url_filter.HELD_BACK)) == 0
    )
    rows = url_filter.judge(pages, queries.URL_RULES).collect()
    assert sorted(r.url for r in rows) == sorted(urls)
    order, counts, totals = url_filter.ORDER, {True: Counter(), False: Counter()}, {True: Counter(), False: Counter()}
    grams = lambda text, at: [text[at - k + 1 : at + 1] for k in range(min(at + 1, order), 0, -1)]
    for url, rule in {(r.url, r.rule) for r in rows if r.rule and not r.back}:
        for at in range(len(text := url + url_filter.END)):
            counts[rule == "com/"].update(grams(text, at))
            totals[rule == "com/"].update((len(g), g[:-1]) for g in grams(text, at))

    def chance(v, gram):
        lower = chance(v, gram[1:]) if len(gram) > 1 else 1 / url_filter.ALPHABET
        return (counts[v][gram] + lower) / (totals[v][(len(gram), gram[:-1])] + 1)

    for row in rows:
        text = row.url + url_filter.END
        longest = [grams(text, at)[0] for at in range(len(text))]
        total = sum(math.log(chance(True, g)) - math.log(chance(False, g)) for g in longest)
        assert abs(row.score - total / len(text)) < 1e-9


def test_urls_without_examples(spark):
    pages = spark.createDataFrame([(1, "a://b.org/c"), (2, None)], "page_id int, url string")
    assert {r.verdict for r in url_filter.judge(pages, queries.URL_RULES).collect()} == {"allow"}
    assert url_filter.judge(pages.filter("1 = 0"), queries.URL_RULES).count() == 0


# --- top-k --------------------------------------------------------------------------------------


def test_top_k_of_odd_vectors(spark):
    rng = np.random.default_rng(2)
    same = [0.5, -0.25, 1.0]
    rows = [(i, same if i % 3 == 0 else rng.normal(0, 1, 3).tolist()) for i in range(260)]
    rows += [(300, None), (301, [None, 1.0, 2.0]), (302, [float("nan"), 0.0, 0.0]), (303, [float("inf"), 0.0, 0.0])]
    rows += [(400, [2.0]), (500, []), (100, [9.0, 9.0, 9.0]), (200, rows[200][1]), (None, [3.0, 3.0, 3.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<float>, rank string").repartition(4)
    q = []
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            ints = [math.floor(1024 * float(np.float32(x))) for x in v]
            q.append((i, np.array([*ints, 0, 0, 0][:3])))
    want = []
    for n_own, (i, a) in enumerate(q):
        if i is not None and i % 100 == 0:
            scored = [(-int(a @ b), math.inf if j is None else j, j) for n, (j, b) in enumerate(q) if n != n_own]
            want += [(i, n, j, -s) for n, (s, _, j) in enumerate(sorted(scored, key=lambda x: x[:2])[:10], 1)]
    for block in (4096, 40):
        got = top_k.top_k(df, F.col("vec_id") % 100 == 0, vectors_per_block=block).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert top_k.top_k(df.filter("1 = 0"), F.col("vec_id") % 100 == 0).count() == 0


def test_every_equal_and_nearly_equal_row_is_a_candidate(spark):
    rows = [(100, [1.0, 2.0])] * 3 + [(100, [1.0 + 2**-20, 2.0]), (1, [1.0, 1.0])] + [(2, [1.0, 1.5])] * 15 + [(200, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    got = [tuple(r) for r in top_k.top_k(df, F.col("vec_id") % 100 == 0).collect()]
    q = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    want = []
    for own, (i, a) in enumerate(q):
        if i % 100 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), j) for n, (j, b) in enumerate(q) if n != own)
            want += [(i, n, j, -s) for n, (s, j) in enumerate(scored[:10], 1)]
    assert sorted(got) == sorted(want)


def test_scores_beyond_doubles_are_exact_and_beyond_64_bits_an_error(spark):
    rows = [(0, [2.0**17, 3.0]), (1, [2.0**18, 1.0]), (2, [2.0**18, -5.0]), (3, [-(2.0**19), 7.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = [(r.vec_id, r.score) for r in top_k.top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == sorted(((i, 1024 * 1024 * (int(v[0]) * 2**17 + int(v[1]) * 3)) for i, v in rows[1:]), key=lambda x: -x[1])
    huge = spark.createDataFrame([(0, [1e15]), (1, [1e15])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        top_k.top_k(huge, F.col("vec_id") == 0).collect()


def test_bounds_enclose_scores_and_tighten():
    rng = np.random.default_rng(4)
    vectors, query = rng.integers(-50, 50, (200, 8)).astype(float), rng.integers(-50, 50, 8).astype(float)
    block, sides = top_k.Block(vectors), np.concatenate([np.maximum(query, 0), np.minimum(query, 0)])
    gaps = []
    for depth in (1, 50, 120, 200):
        most, least = (b @ sides for b in block.bounds(depth))
        assert (least <= vectors @ query).all() and (vectors @ query <= most).all()
        gaps.append((most - least).sum())
    assert gaps == sorted(gaps, reverse=True) and gaps[-1] == 0


# --- sharding -----------------------------------------------------------------------------------


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 3), (4, 2)])
def test_the_curve_visits_neighbours(dims, bits):
    cells = sorted(product(range(1 << bits), repeat=dims), key=lambda p: sharding.hilbert_index(p, bits))
    assert sorted(sharding.hilbert_index(p, bits) for p in cells) == list(range(1 << bits * dims))
    assert all(sum(abs(a - b) for a, b in zip(p, q, strict=True)) == 1 for p, q in zip(cells, cells[1:], strict=False))


def check_shards(rows, texts):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts
    )
    counts = Counter(r["shard"] for r in rows)
    assert {*counts} <= {*range(16)} and max(counts.values()) - min(counts[s] for s in range(16)) <= 1
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r["shard"]].append(r)
    assert all(sorted(r.slot for r in rs) == list(range(len(rs))) for rs in by_shard.values())
    runs = [(min(r.hilbert for r in by_shard[s]), max(r.hilbert for r in by_shard[s])) for s in sorted(by_shard)]
    assert all(a[1] <= b[0] for a, b in zip(runs, runs[1:], strict=False))


def test_shards_of_odd_documents(spark, odd_docs, no_docs):
    rows = sharding.assign(odd_docs).collect()
    check_shards(rows, odd_texts())
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    assert sharding.assign(no_docs).count() == 0


def test_shards_of_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assigned = written(sharding.assign(docs), "assigned")
    check_shards(assigned.collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert sum(r["rows"] for r in sharding.manifest(assigned).collect()) == docs.count()
    sharding.write_shards(assigned, str(tmp_path / "shards"), rows_per_file=7)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(r.doc_id for r in back.collect()) == sorted(r.doc_id for r in docs.collect())


# --- near duplicates ----------------------------------------------------------------------------


def test_golay_code_is_perfect():
    code = Golay()
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 23, 3000)
    near, count = code.near(values)
    assert {*count.tolist()} <= {1, 6}
    # The homes of the code itself: an index is the upper 12 bits of its codeword.
    words = {}
    for v in range(1 << 12):
        for w in [v << 11 | c for c in [int(code.low[(v << 11) & 0xFFF] ^ code.high[v >> 1])]]:
            words[v] = w
    for value, row, n in zip(values.tolist(), near.tolist(), count.tolist(), strict=True):
        far = [(value ^ words[i]).bit_count() for i in row[:n]]
        assert far[0] <= 3 and all(f == 4 for f in far[1:])
    assert min((a ^ b).bit_count() for a, b in combinations(list(words.values())[:200], 2)) >= 7


def test_keys_meet_for_all_fingerprints_within_four_bits():
    code, rng = Golay(), np.random.default_rng(1)
    x = rng.integers(0, 2**64, 5000, dtype=np.uint64)
    y = x.copy()
    for n in range(len(x)):
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            y[n] ^= np.uint64(1) << np.uint64(b)
    sides = []
    for side in (x, y):
        keys, owners = near_duplicates.golay_keys(side, code)
        own = [set() for _ in side]
        for k, o in zip(keys.tolist(), owners.tolist(), strict=True):
            own[o].add(k)
        sides.append(own)
    assert all(a & b for a, b in zip(*sides, strict=True))


def plain_fingerprint(text, words=4):
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(parts[i : i + words]), 42) for i in range(max(1, len(parts) - words + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_near_duplicates_of_odd_documents(spark, odd_docs, no_docs):
    rows = near_duplicates.near_duplicates(odd_docs).collect()
    prints = [(i, plain_fingerprint(t)) for i, t in odd_texts()]
    assert Counter((r.doc_id, r.fingerprint % 2**64) for r in rows) == Counter(prints)
    values = {f for _, f in prints}
    component = roots(values, [(a, b) for a, b in combinations(values, 2) if (a ^ b).bit_count() <= 4])
    least = defaultdict(list)
    for i, f in prints:
        least[component[f]].append(math.inf if i is None else i)
    for r in rows:
        assert r.component_id == min(least[component[r.fingerprint % 2**64]])
    assert near_duplicates.near_duplicates(no_docs).count() == 0
    assert near_duplicates.without_near_copies(no_docs).count() == 0


@pytest.mark.parametrize("chunk", [near_duplicates.CHUNK, 40])
def test_links_connect_dense_groups_and_chains(spark, chunk):
    """A group around one fingerprint, a chain of steps of four bits, and strangers."""
    rng = np.random.default_rng(6)
    one = int(rng.integers(0, 2**63))
    dense = {one ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for _ in range(400)}
    chain, at = set(), int(rng.integers(0, 2**63))
    for step in range(15):
        chain.add(at)
        at ^= 0b1111 << 4 * step
    values = sorted({*dense, *chain, *rng.integers(0, 2**63, 300).tolist()})
    nodes = written(spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "node bigint"), "n")
    found = components(near_duplicates.links(nodes, chunk=chunk))
    got = {r.node % 2**64: r.root % 2**64 for r in found.collect()}
    a = np.array(values, np.uint64)
    pairs = [(values[i], values[j]) for i in range(len(a)) for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 4) if j > i]
    want = roots(values, pairs)
    groups = lambda of: {frozenset(n for n in values if of.get(n, n) == r) for r in {of.get(n, n) for n in values}}
    assert groups(got) == groups(want)


def test_near_copies_leave_one_of_each_group(spark, odd_docs):
    kept = near_duplicates.without_near_copies(odd_docs)
    assert kept.schema == odd_docs.schema
    # 1 stays for 8 (twice) and the copy in capitals; 3 for the empty ones.
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 6, 7, 9, 10, 11, 12]
    rng = np.random.default_rng(8)
    vocabulary = [f"{a}{b}" for a in "abcdefgh" for b in ("ra", "to", "mi", "ne", "lu")]
    base = [rng.choice(vocabulary, 300).tolist() for _ in range(40)]
    rows = []
    for n, words in enumerate(base):
        rows.append((10 * n, " ".join(words)))
        for copy in range(1, 4):  # up to three changed words of 300: a similarity of 0.9 or more
            changed = list(words)
            for place in rng.choice(300, copy, replace=False):
                changed[place] = "changed"
            rows.append((10 * n + copy, " ".join(changed)))
    copies = near_duplicates.without_near_copies(spark.createDataFrame(rows, "doc_id bigint, text string"))
    ids = [r.doc_id for r in copies.collect()]
    assert {i for i in ids if i % 10 == 0} == {10 * n for n in range(40)} and len(ids) <= 42
    same = spark.createDataFrame([(5, ENGLISH)] * 3 + [(None, ENGLISH)], "doc_id bigint, text string")
    assert [r.doc_id for r in near_duplicates.without_near_copies(same).collect()] == [5]


def changed_copy(words, kind, share, rng):
    """The words with about this share of them cut off, appended, inserted as a block, or changed here and there."""
    n = max(1, round(share * len(words)))
    block = [f"new{rng.integers(1 << 40)}" for _ in range(n)]
    if kind == "cut":
        return words[: len(words) - n]
    if kind == "appended":
        return words + block
    if kind == "inserted":
        at = int(rng.integers(len(words)))
        return words[:at] + block + words[at:]
    out = list(words)
    for place, word in zip(rng.choice(len(words), max(1, n // 5), replace=False), block, strict=False):
        out[place] = word
    return out


def exact_sets(texts):
    return [
        {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := t.lower().split()) else set() for t in texts
    ]


def test_links_of_near_copies_against_an_exact_join(spark):
    """No link below the similarity, nearly all above it, for all ways of change."""
    rng = np.random.default_rng(12)
    pages = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()
    base = [r.text.split() for r in pages if 60 <= len((r.text or "").split()) <= 2000][:400]
    kinds = ["cut", "appended", "inserted", "scattered"]
    texts = [" ".join(w) for w in base]
    texts += [" ".join(changed_copy(w, kinds[i % 4], 0.02 + 0.3 * rng.random(), rng)) for i, w in enumerate(base)]
    sets = exact_sets(texts)
    holders = defaultdict(list)
    for i, grams in enumerate(sets):
        for gram in grams:
            holders[gram].append(i)
    meeting = Counter(p for found in holders.values() for p in combinations(found, 2))
    exact = {p for p, n in meeting.items() if n >= 0.8 * (len(sets[p[0]] | sets[p[1]]))}
    docs = spark.createDataFrame(list(enumerate(texts)), "__id bigint, __text string").repartition(6)
    marked = written(near_duplicates.wide_fingerprints(docs), "f")
    nodes = written(marked.withColumnRenamed("__id", "node"), "n")
    texts_of = lambda some: docs.withColumnRenamed("__id", "node").join(some, "node")
    linked = {(min(r), max(r)) for r in near_duplicates.similar_links(nodes, texts_of).collect()}
    assert linked <= exact
    group = roots(range(len(texts)), linked)
    reached = [group[a] == group[b] for a, b in exact]
    assert len(exact) > 200 and sum(reached) >= 0.95 * len(reached)


def test_fingerprints_alone_make_no_copies(spark, monkeypatch):
    """Equal fingerprints of different texts: only the sets decide, and a refused link hides no other."""
    words = [f"w{i}" for i in range(100)]
    texts = {1: words, 2: [f"x{i}" for i in range(100)], 3: words[:95], 4: words[:60], 5: words[:57], 6: [f"y{i}" for i in range(100)]}
    known = near_duplicates.wide_fingerprints

    def alike(rows, *rest):
        same = {c: F.lit(0).cast("bigint") for c in ("w0", "w1", "w2", "k0", "k1", "k2", "k3")}
        return known(rows, *rest).withColumns(same)

    monkeypatch.setattr(near_duplicates, "wide_fingerprints", alike)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id bigint, text string")
    assert sorted(r.doc_id for r in near_duplicates.without_near_copies(docs).collect()) == [1, 2, 4, 6]
    many = docs.union(spark.createDataFrame([(i, f"strange text number {i}") for i in range(10, 40)], docs.schema))
    assert sorted(r.doc_id for r in near_duplicates.without_near_copies(many).collect()) == [1, 2, 4, 6, *range(10, 40)]


def test_copies_too_far_from_each_other_are_no_candidates(spark, monkeypatch):
    """Copies of one text, most pairs of them near 0.7, and smaller groups around some: few pairs are compared, none is lost."""
    rng = np.random.default_rng(21)
    base = [f"w{i}" for i in range(220)]

    def spoilt(words, changes):
        out = list(words)
        for place in rng.choice(len(words), changes, replace=False):
            out[place] = f"new{rng.integers(1 << 40)}"
        return out

    copies = [base, *(spoilt(base, int(rng.integers(2, 9))) for _ in range(400))]
    copies += [spoilt(copies[i], 2) for i in range(1, 60) for _ in range(3)]
    texts = [" ".join(words) for words in copies]
    sets = exact_sets(texts)
    exact = [p for p in combinations(range(len(texts)), 2) if len(sets[p[0]] & sets[p[1]]) >= 0.8 * len(sets[p[0]] | sets[p[1]])]
    docs = spark.createDataFrame(list(enumerate(texts)), "__id bigint, __text string").repartition(6)
    nodes = written(written(near_duplicates.wide_fingerprints(docs), "f").withColumnRenamed("__id", "node"), "n")
    texts_of = lambda some: docs.withColumnRenamed("__id", "node").join(some, "node")
    known, compared = near_duplicates.confirmed, []

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return known(pairs, *rest)

    monkeypatch.setattr(near_duplicates, "confirmed", counted)
    linked = {(min(r), max(r)) for r in near_duplicates.similar_links(nodes, texts_of).collect()}
    assert linked <= set(exact)
    assert roots(range(len(texts)), linked) == roots(range(len(texts)), exact)
    # All pairs of different parts are some 100,000 here.
    assert len(compared) == 2 and compared[1] < 5 * len(texts)


def test_the_nearest_forest_connects_at_every_number_of_bits():
    rng = np.random.default_rng(5)
    start = rng.integers(0, 2**63, (1, 3)).astype(np.uint64)
    flips = rng.integers(0, 2**63, (120, 3)).astype(np.uint64)
    for _ in range(3):
        flips &= rng.integers(0, 2**63, (120, 3)).astype(np.uint64)
    values = start ^ flips
    bits = np.bitwise_count(values[:, None] ^ values[None]).sum(axis=-1)
    a, b = near_duplicates.nearest_links(values, 30)
    for most in (5, 10, 15, 20, 25, 30):
        pairs = np.argwhere((bits <= most) & (np.arange(120)[:, None] < np.arange(120)))
        kept = [(x, y) for x, y in zip(a.tolist(), b.tolist(), strict=True) if bits[x, y] <= most]
        assert roots(range(120), pairs.tolist()) == roots(range(120), kept)
    groups = rng.integers(0, 3, 120)
    between = {tuple(p) for p in np.stack(near_duplicates.links_between(values, 20, groups), axis=1).tolist()}
    assert between == {(i, j) for i, j in combinations(range(120), 2) if bits[i, j] <= 20 and groups[i] != groups[j]}


def test_components_of_a_random_graph(spark):
    rng = np.random.default_rng(9)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint").repartition(3)
    got = {r.node: r.root for r in components(df).collect()}
    want = roots({n for p in pairs for n in p}, pairs)
    assert got == {n: r for n, r in want.items() if any(n in p and p[0] != p[1] for p in pairs)}
    assert components(df.filter("1 = 0")).count() == 0


# --- pipeline -----------------------------------------------------------------------------------


def test_stages_keep_columns_of_odd_and_empty_documents(spark, odd_docs, no_docs):
    assert len(corpus_pipeline.STAGES) == 5
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        kept, none = stage(spark, odd_docs, SMALL), stage(spark, no_docs, SMALL)
        assert none.count() == 0, name
        if n < 4:
            assert kept.columns == odd_docs.columns and dict(kept.dtypes) == dict(odd_docs.dtypes), name
        assert kept.count() <= odd_docs.count()
    letters = corpus_pipeline.language_identification(spark, odd_docs, SMALL)
    assert sorted(r.doc_id or 0 for r in letters.collect()) == [0, 1, 2, 6, 7, 8, 8, 10, 11]


def test_pipeline_runs_the_stages_one_after_the_other(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    ids = [r.doc_id for r in rows]
    assert len(ids) == len(set(ids)) and 0.5 * len(docs) < len(ids) < len(docs)
    assert all(r.text == docs[r.doc_id].text for r in rows)
    marked = entry_points.queries()["op10_decontamination"](spark, SMALL).filter("contaminated").collect()
    assert not {r.doc_id for r in marked} & {*ids}
    classes = entry_points.queries()["op9_simhash_golay"](spark, SMALL).collect()
    component = {r.doc_id: r.component_id for r in classes}
    assert len({component[i] for i in ids}) == len(ids)  # of exact copies one stays
