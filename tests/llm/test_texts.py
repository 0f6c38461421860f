"""Decontamination, pieces, language identification, toxicity, importance."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_odd import ENGLISH, FRENCH, no_docs, odd_docs, odd_texts  # noqa: F401
from tallyspark.llm import decontamination, importance, language_id, pieces, recurrent, toxicity
from tallyspark.llm.common import bounded_keys

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)


def naive_hits(words, windows):
    return sorted((i, w) for w in windows for i in range(len(words) - len(w) + 1) if tuple(words[i : i + len(w)]) == w)


@given(
    st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60),
    st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=1, max_size=5).map(tuple), max_size=6),
)
def test_search_finds_what_comparing_everywhere_finds(words, windows):
    found = []
    for searcher in decontamination.searchers_for([(w, n) for n, w in enumerate(windows)]):
        found += [(i, tuple(words[i : i + searcher.length])) for i, _ in searcher.find(words)]
    assert sorted(found) == naive_hits(words, set(windows))


def brute_contamination(text, items):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit, found = set(), set()
    for item, item_text in items:
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), item_text or ""))
        size = min(10, len(own))
        for at in range(len(own) - size + 1 if own else 0):
            for start in range(len(words) - size + 1):
                if words[start : start + size] == own[at : at + size]:
                    hit.update(range(start, start + size))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


ITEMS = [
    (1, " ".join(ENGLISH.split()[3:15])),
    (2, "chat ET le"),
    (2, "sont dans la"),
    (10, ENGLISH),
    (3, None),
    (4, "..."),
    (5, "nowhere to be seen"),
]


@pytest.mark.parametrize("per_pass", [decontamination.WINDOWS_PER_PASS, 4])
def test_contamination_of_odd_documents(spark, odd_docs, per_pass):
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    rows = decontamination.contamination(odd_docs, benchmark, windows_per_pass=per_pass).collect()
    assert len(rows) == len(odd_texts())
    for row in rows:
        if row.text is None or len(row.text) < 10_000:
            assert (row.n_words, row.n_hit, row["items"]) == brute_contamination(row.text, ITEMS)
    long = next(r for r in rows if r.doc_id == 7)
    assert long.n_words == 2500 * 23 and long.n_hit == 2500 * 22 and long["items"] == ["1", "10"]


def test_many_portions_mark_what_one_portion_marks_in_one_scan(spark):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    pasted = items.select((F.col("item_id") + 10**6).alias("doc_id"), F.concat(F.lit("so it goes: "), "text").alias("text"))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").union(pasted)
    windows = decontamination.benchmark_windows(items).count()
    assert windows > 1_000
    one = decontamination.contamination(docs, items)
    many = decontamination.contamination(docs, items, windows_per_pass=-(-windows // 1_000))
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("documents.parquet") == 1
    want = {(r.doc_id, r.n_hit, tuple(r["items"])) for r in one.collect()}
    assert want == {(r.doc_id, r.n_hit, tuple(r["items"])) for r in many.collect()}
    assert sum(n_hit > 0 for _, n_hit, _ in want) >= pasted.filter("text != ''").count() - 5


def test_windows_are_distinct_and_know_their_items(spark):
    rows = [(2, "A b"), (1, "a, B"), (None, "a b"), (2, "a b"), (3, " ".join("w%d" % i for i in range(12))), (4, None), (5, "-")]
    got = decontamination.benchmark_windows(spark.createDataFrame(rows, "item_id bigint, text string")).collect()
    assert {r.window: r["items"] for r in got} == {
        "a b": ["1", "2"],
        **{" ".join("w%d" % i for i in range(at, at + 10)): ["3"] for at in range(3)},
    }
    assert len(got) == 4


def test_clashing_names_of_documents_are_kept_or_replaced(spark):
    docs = spark.createDataFrame([("a b", "x", 7, "y")], "text string, c0 string, N_HIT bigint, __items string")
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    (row,) = decontamination.contamination(docs, items).collect()
    assert row.asDict() == {
        "text": "a b", "c0": "x", "__items": "y", "n_words": 2, "n_hit": 2, "hit_spans": [(0, 2)], "items": ["1"]
    }
    assert decontamination.clean_documents(docs, items.filter("item_id = 2")).collect() == docs.collect()


def test_decontamination_keeps_rows_and_columns(spark, odd_docs, no_docs):
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    kept = decontamination.clean_documents(odd_docs, benchmark)
    assert kept.schema == odd_docs.schema
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 4, 5, 6, 9, 10, 11, 12]
    assert decontamination.clean_documents(no_docs, benchmark).count() == 0
    assert decontamination.clean_documents(odd_docs, benchmark.filter("1=0")).count() == odd_docs.count()


TEXTS = st.text(alphabet=st.sampled_from(list("abcdehinorst .,\n\t▁é日𝒳́\x00\r AB")), max_size=40)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_encoding_equals_the_library(text):
    codec = pieces.codec_of(open(MODEL, "rb").read())
    ids = np.frombuffer(codec.encode(text), "<u4").tolist()
    assert ids == LIBRARY.encode(text, add_bos=True, add_eos=True)
    assert codec.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 2), st.integers(3, 258), st.integers(259, 31_999)), max_size=8))
def test_decoding_of_any_ids_equals_the_library(ids):
    assert pieces.codec_of(open(MODEL, "rb").read()).decode(ids) == LIBRARY.decode(ids)


def test_round_trip_of_odd_documents(odd_docs, no_docs):
    rows = pieces.round_trip(odd_docs, MODEL).collect()
    assert len(rows) == len(odd_texts())
    for row in rows:
        want = LIBRARY.encode(row.text or "", add_bos=True, add_eos=True)
        assert np.frombuffer(bytes(row.ids), "<u4").tolist() == want
        assert row.decoded == LIBRARY.decode(want)
    assert pieces.round_trip(no_docs, MODEL, packed=False).collect() == []
    listed = pieces.round_trip(odd_docs.filter("doc_id = 2"), MODEL, packed=False).first()
    assert listed.ids == LIBRARY.encode(FRENCH, add_bos=True, add_eos=True)


@pytest.mark.parametrize("run", ["的是日本ます", "ภาษาไทย", "😀🎉", "的" * 7 + "x", "x"])
def test_long_runs_without_spaces_equal_the_library(run):
    codec = pieces.Codec(open(MODEL, "rb").read())
    text = (run * (100_000 // len(run) + 1))[:100_000]
    for whole in (text, "a " + text + ". b\n" + text[:2_000]):
        ids = np.frombuffer(codec.encode(whole), "<u4").tolist()
        assert ids == [LIBRARY.bos_id(), *LIBRARY.encode(whole), LIBRARY.eos_id()]
        assert codec.decode(ids) == whole


def test_other_models_are_refused():
    with pytest.raises(ValueError, match="merge models"):
        pieces.Codec(b"")


def test_bloom_filters_hold_all_grams_and_few_others():
    rng = np.random.default_rng(1)
    grams = {name: rng.integers(0, 1 << 32, 3000, dtype=np.uint64) for name in [f"l{i}" for i in range(11)]}
    filters = language_id.Filters.build(grams, 4)
    for place, name in enumerate(sorted(grams)):
        masks = filters.masks(grams[name])
        assert (masks[:, place // 8] >> (place % 8) & 1).all()
    other = filters.masks(rng.integers(0, 1 << 32, 20_000, dtype=np.uint64))
    wrong = np.unpackbits(other, axis=1, bitorder="little")[:, :11].mean(axis=0)
    assert np.abs(wrong - filters.chance()).max() < 0.01


def test_gram_shares_are_those_of_plain_sets():
    texts = [t for _, t in odd_texts() if t and len(t) < 500]
    plain = [(" " + re.sub(r"[\W\d_]+", " ", t.lower()).strip() + " ").encode() for t in texts]
    owner, grams = next(iter(language_id.grams_of(language_id.letters_only(pa.array(texts)), 4)))
    for place, text in enumerate(plain):
        want = [int.from_bytes(text[i : i + 4], "little") for i in range(len(text) - 3)]
        if text.isascii():
            assert grams[owner == place].tolist() == want


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    found = language_id.identify(docs, language_id.learn(docs, ~held)).filter(held).collect()
    assert len(found) > 20 and np.mean([r.lang == r.lang_pred for r in found]) >= 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_languages_of_odd_documents(spark, odd_docs, no_docs):
    learned = language_id.learn(odd_docs, F.lit(True))
    rows = language_id.identify(odd_docs, learned).collect()
    assert len(rows) == len(odd_texts())
    for row in rows:
        letters = row.text is not None and any(c.isalpha() for c in row.text)
        assert (row.lang_pred == "und") == (not letters) and 0 <= row.score <= 1
    nothing = language_id.learn(no_docs, F.lit(True))
    assert {r.lang_pred for r in language_id.identify(odd_docs, nothing).collect()} == {"und"}
    assert language_id.identify(no_docs, learned).count() == 0


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    net = recurrent.Network.fresh(3)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64) * 3
    words = [b"ab", b"xyzw", b"hello", b"q", b"longerword"]
    ids = rng.integers(-1, 5, (6, 4))
    ids[:, 3] = -1  # an empty window
    labels = np.array([1, 0, 1, 0.0])
    _, grads = net.gradients(words, ids, labels)
    for k, g in grads.items():
        for at in [tuple(i) for i in np.argwhere(np.abs(g) > 1e-3)[:3]]:
            old, sides = net.p[k][at], []
            for step in (1e-3, -1e-3):
                net.p[k][at] = old + step
                sides.append(net.gradients(words, ids, labels)[0])
            net.p[k][at] = old
            assert (sides[0] - sides[1]) / 2e-3 == pytest.approx(g[at], rel=0.05, abs=2e-4), k


@pytest.mark.parametrize("n", [0, 1, 16, 31, 32, 33, 48, 49, 1000])
def test_windows_overlap_and_cover_every_word(n):
    windows, owner = toxicity.windows_of([np.arange(n)])
    seen = np.bincount(windows[windows >= 0], minlength=n)
    assert (owner == 0).all() and (seen >= 1).all()
    inner = seen[toxicity.STEP_WORDS : max(toxicity.STEP_WORDS, n - toxicity.WINDOW_WORDS)]
    assert (inner == 2).all()


def made_texts(n, seed):
    """Clean texts, and toxic ones with a few words of a small list and odd endings."""
    rng = np.random.default_rng(seed)
    clean = [f"{a}{b}" for a in ("be", "lo", "ta", "ri", "mu", "so") for b in ("ran", "tel", "ning", "os", "ak")]
    texts, labels = [], []
    for i in range(n):
        words = rng.choice(clean, rng.integers(20, 200)).tolist()
        if i % 3 == 0:
            for _ in range(3):
                words.insert(rng.integers(len(words)), rng.choice(["zgrok", "vlimp"]) + rng.choice(["", "ed", "ing", "os"]))
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    return texts, labels


def test_toxicity_is_learned_and_the_same_again():
    texts, labels = made_texts(240, 1)
    model = toxicity.train(texts, labels)
    texts, labels = made_texts(120, 2)
    scores = toxicity.Scorer(model).scores(texts)
    assert np.mean((scores >= 0.7) == np.array(labels)) > 0.95
    long = " ".join(["beran"] * 5000 + ["zgroked", "vlimp", "zgrok"] + ["taos"] * 5000)
    whole = toxicity.Scorer(model).scores([long, long.replace("zgrok", "ta").replace("vlimp", "ri")])
    assert whole[0] >= 0.7 > whole[1]


def test_toxicity_of_odd_documents(spark, odd_docs, no_docs):
    rows = [(1, 1), (2, 0), (8, 1), (8, 0), (3, 1), (6, 0), (7, 0), (99, 1), (None, 1), (4, None)]
    labels = spark.createDataFrame(rows, "doc_id bigint, toxic int")
    model = toxicity.learn(odd_docs, labels, F.lit(True))
    found = toxicity.score(odd_docs, model).collect()
    assert len(found) == len(odd_texts())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found)
    assert len({r.score for r in found if r.doc_id == 8}) == 1
    none = toxicity.learn(odd_docs, labels.filter("1 = 0"), F.lit(True))
    assert {r.score for r in toxicity.score(odd_docs, none).collect()} == {0.0}
    assert toxicity.score(no_docs, model).count() == 0
    assert toxicity.learn(no_docs, labels, F.lit(True)).network is None


def test_importance_counts_what_plain_counting_gives():
    texts = [t for _, t in odd_texts() if t is not None and len(t) < 1000]
    owner, bucket = importance.features(pa.array(texts))
    for place, text in enumerate(texts):
        words = re.sub(r"[^\w]|_", " ", text.lower()).split()
        if text.isascii():
            assert (owner == place).sum() == max(0, 2 * len(words) - 1)
    one = [importance.features(pa.array([t]))[1].tolist() for t in texts]
    assert all(sorted(bucket[owner == i]) == sorted(b) for i, b in enumerate(one))  # alone or beside others
    a, b = importance.features(pa.array(["good word here", "good word gone"]))[1][[0, 1]], importance.features(pa.array(["good word gone"]))[1][[0, 1]]
    assert a.tolist() == b.tolist()


def test_importance_of_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(2, 1), (1, 0), (7, None), (None, 1), (2, 1)], "doc_id bigint, quality int")
    rows = importance.resample(odd_docs, labels, share=0.4).collect()
    assert len(rows) == len(odd_texts())
    weights = {r.doc_id: r.log_weight for r in rows}
    assert weights[3] == weights[4] == weights[5] == 0 and weights[2] > 0 > weights[1]
    ordered = sorted(rows, key=lambda r: -r.key)
    assert sum(r.selected for r in rows) == round(0.4 * len(rows))
    assert all(r.selected for r in ordered[: round(0.4 * len(rows))])
    assert importance.resample(no_docs, labels).count() == 0
    even = importance.resample(odd_docs, labels.filter("1 = 0"))
    assert {r.log_weight for r in even.collect()} == {0.0}


def plain_buckets(text):
    """Buckets of words and of pairs of neighbours, in Python's own integers."""
    full = (1 << 64) - 1
    mix = [int(m) for m in importance._MIX]
    hashes = []
    for word in re.sub(r"[^\w]|_", " ", (text or "").lower()).split():
        hashes.append(sum((b + 1) * pow(0x100000001B3, at, 1 << 64) for at, b in enumerate(word.encode(), 1)) & full)
    pairs = [(a * mix[0] & full) ^ (b * mix[2] & full) for a, b in zip(hashes, hashes[1:])]
    mixed = [(h ^ h >> 31) * mix[1] & full for h in hashes + pairs]
    return [(m ^ m >> 29) % importance.BUCKETS for m in mixed]


@pytest.mark.parametrize("broadcast", [importance.BROADCAST_IDS, 0])
def test_importance_weights_are_those_of_plain_counting(spark, monkeypatch, broadcast):
    monkeypatch.setattr(importance, "BROADCAST_IDS", broadcast)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").filter("doc_id % 5 = 0")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality")
    absent = spark.createDataFrame([(-1, 1), (None, 1)], "doc_id bigint, quality int")
    rows = docs.collect()
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    raw, target = np.zeros(importance.BUCKETS), np.zeros(importance.BUCKETS)
    buckets = {r.doc_id: plain_buckets(r.text) for r in rows}
    for doc_id, found in buckets.items():
        np.add.at(raw, found, 1)
        if doc_id in good:
            np.add.at(target, found, 1)
    assert target.any() and (raw > target).any()
    ratios = np.log((target + 1) / (target.sum() + len(target))) - np.log((raw + 1) / (raw.sum() + len(raw)))
    got = importance.resample(docs, labels.union(labels).union(absent)).collect()
    assert len(got) == len(rows)
    for row in got:
        assert row.log_weight == pytest.approx(sum(ratios[b] for b in buckets[row.doc_id]), abs=1e-7)
    none = importance.resample(docs, absent)  # no document has these ids
    assert {r.log_weight for r in none.collect()} == {0.0}


@pytest.mark.parametrize("few", [1, 40])
def test_top_share_narrows_to_few_rows_beside_outliers(spark, few):
    keys = [1e300, -1e300, 3e9] + [float(k) for k in np.random.default_rng(4).normal(0, 1, 400)] + [0.5] * 60
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key double, id bigint")
    for share in (0.002, 0.3, 0.6):
        got = {r.id for r in importance.top_share(df, "key", ["id"], share, few=few).filter("selected").collect()}
        want = sorted(range(len(keys)), key=lambda i: (-keys[i], i))[: round(len(keys) * share)]
        assert got == set(want)


def test_top_share_is_exact_with_ties(spark):
    rng = np.random.default_rng(3)
    keys = [float(k) for k in np.concatenate([rng.normal(0, 1e-6, 300), rng.normal(0, 1e5, 200), np.zeros(500)])]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key double, id bigint").repartition(5, "id")
    for share in (0.0, 0.001, 0.3, 0.5, 0.77, 1.0):
        got = {r.id for r in importance.top_share(df, "key", ["id"], share).filter("selected").collect()}
        want = sorted(range(1000), key=lambda i: (-keys[i], i))[: round(1000 * share)]
        assert got == set(want)


def test_bounded_keys_are_few_and_do_not_depend_on_partitions(spark):
    df = spark.range(1000).unionByName(spark.range(500))
    first = bounded_keys(df.repartition(7), "id", 50)
    assert len(set(first)) == 50 and set(first) == set(bounded_keys(df.coalesce(1), "id", 50))


def test_split_by_crc_is_the_known_checksum(spark):
    from tallyspark.llm.common import in_remainder

    rows = spark.range(50).withColumn("held", in_remainder("id", 4, 2)).collect()
    assert all(r.held == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)
    assert spark.sql("SELECT CAST(NULL AS BIGINT) AS id").select(in_remainder("id", 4, 2)).first()[0] is False


def test_item_digest(spark):
    df = spark.createDataFrame([(["1", "10", "2"],), ([],)], "items array<string>")
    got = [r[0] for r in df.select(decontamination.items_digest("items")).collect()]
    assert got == [hashlib.sha256(x).hexdigest() for x in (b"1,10,2", b"")]
