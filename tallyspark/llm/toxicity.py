"""Toxicity scores by a recurrent network over all overlapping windows.

A text is lower-cased and cut into words of letters; windows of
``WINDOW_WORDS`` words start every ``STEP_WORDS`` words, so every word of a text
lies in two windows (in one at the ends). The score of a text is the largest
window score, made a probability by two numbers fitted on texts that the
network was not trained on.

Training sees labels of whole texts only. The first round takes every window of
a text for what the text is; later rounds take the most suspicious windows of a
toxic text and the most suspicious and some other windows of a clean one.

The sample is bounded: at most ``DOCS_PER_CLASS`` texts of each label, in hash
order of the id; training runs in numpy on the driver. Scoring is a map.

Defined results: a NULL or word-less text is one empty window and scores like
any other; without labels of both kinds every text scores the share of toxic
labels (0 if there is none); labels other than 0 and 1 count as missing; of
several labels of one text the largest counts; repeated rows score alike;
columns named like a result are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import bounded_keys, rows_for_keys, with_new_columns
from tallyspark.llm.recurrent import HIDDEN, Adam, Network

SCORE_DIGITS = 5
WINDOW_WORDS, STEP_WORDS = 32, 16
DOCS_PER_CLASS = 1500
ROUNDS, BATCH, RATE = 6, 128, 0.01
# Windows of a training round, of which as many are of toxic as of clean texts;
# few windows are used several times.
ROUND_WINDOWS, LEADING = 8192, 2
TOXIC_FROM = 0.7
WORDS_KEPT = 150_000
WINDOWS_AT_ONCE, ROWS_AT_ONCE = 2048, 256

WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def window_starts(words: int) -> np.ndarray:
    """Starts of the overlapping windows; the last one reaches the end."""
    return np.arange(0, max(1, words - WINDOW_WORDS + STEP_WORDS), STEP_WORDS)


def windows_of(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All windows of texts as (window, word) with -1 for padding, and their texts."""
    flat = np.concatenate([*ids, np.zeros(0, np.int64)]).astype(np.int64)
    ends = np.cumsum([len(x) for x in ids])
    starts = [window_starts(len(x)) for x in ids]
    owner = np.repeat(np.arange(len(ids)), [len(s) for s in starts])
    begin = np.concatenate([s + e - len(x) for s, e, x in zip(starts, ends, ids, strict=True)])
    at = begin[:, None] + np.arange(WINDOW_WORDS)[None, :]
    inside = at < ends[owner][:, None]
    if not len(flat):
        return np.full(at.shape, -1), owner
    return np.where(inside, flat[np.minimum(at, len(flat) - 1)], -1), owner


@dataclass
class Model:
    network: Network | None
    slope: float
    offset: float  # without a network the score itself


class _Known(dict):
    """Numbers of words in order of appearance."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class Scorer:
    """Scores texts; remembers what a bounded number of words add to the gates."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.known, self.gates = _Known(), np.zeros((0, 6 * HIDDEN), np.float32)
        self.room = 0

    def _numbers(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.known) > WORDS_KEPT:
            self._forget()
        before = len(self.known)
        ids = [np.array([self.known[w] for w in words_of(t)], np.int64) for t in texts]
        if len(self.known) > before:
            fresh = [w.encode() for w in list(self.known)[before:]] if before else [w.encode() for w in self.known]
            network = self.model.network
            new = network.projected(network.inputs(fresh))
            if len(self.known) > len(self.gates):
                grown = np.zeros((max(2 * len(self.gates), len(self.known), 1 << 12), 6 * HIDDEN), np.float32)
                grown[:before] = self.gates[:before]
                self.gates = grown
            self.gates[before : len(self.known)] = new
        return ids

    def logits(self, texts: list[str | None]) -> np.ndarray:
        """Largest window logit of each text."""
        windows, owner = windows_of(self._numbers(texts))
        out = np.full(len(texts), -np.inf)
        order = np.argsort(-(windows >= 0).sum(axis=1), kind="stable")  # full windows together
        for start in range(0, len(order), WINDOWS_AT_ONCE):
            some = order[start : start + WINDOWS_AT_ONCE]
            ids = np.ascontiguousarray(windows[some].T)
            ids = ids[: max(1, int((ids >= 0).any(axis=1).sum()))]
            gates = self.gates[np.maximum(ids, 0)] if len(self.gates) else np.zeros((*ids.shape, 6 * HIDDEN), np.float32)
            np.maximum.at(out, owner[some], self.model.network.forward(gates, ids >= 0))
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.model.network is None:
            return np.full(len(texts), self.model.offset)
        x = self.model.slope * self.logits(texts) + self.model.offset
        # Products of matrices of other shapes differ in the last bits: equal texts get equal scores in any batch.
        return np.round(1 / (1 + np.exp(-np.clip(x, -50, 50))), SCORE_DIGITS)


def _fitted(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset that make logits probabilities (damped Newton steps)."""
    # Targets off 0 and 1, as usual for this fit, keep separable texts finite.
    yes, no = (labels > 0).sum(), (labels == 0).sum()
    target = np.where(labels > 0, (yes + 1) / (yes + 2), 1 / (no + 2))
    centre, spread = logits.mean(), logits.std() + 1e-6
    x = np.stack([(logits - centre) / spread, np.ones(len(logits))], axis=1)
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (target - p) - 1e-3 * w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    slope = max(w[0], 1e-3) / spread
    return float(slope), float(w[1] - slope * centre)


def train(texts: list[str], labels: list[int], seed: int = 7) -> Model:
    """A model from labelled texts, the same for the same texts in the same order."""
    y = np.array(labels, np.float32)
    if len(set(labels)) < 2:
        return Model(None, 0.0, float(y.mean()) if len(y) else 0.0)
    rng = np.random.default_rng(seed)
    aside = rng.random(len(y)) < 0.25
    for value in (0, 1):  # both labels on both sides, where there are two texts of it
        of = np.flatnonzero(y == value)
        if len(of) > 1:
            aside[of[0]], aside[of[1]] = False, True
        else:
            aside[of] = False
    known = _Known()
    ids = [np.array([known[w] for w in words_of(t)], np.int64) for t in texts]
    words = [w.encode() for w in known]
    network = Network.fresh(seed)
    adam = Adam(network, RATE)
    taught = np.flatnonzero(~aside)
    windows, owner = windows_of([ids[i] for i in taught])
    truth = y[taught][owner]
    toxic, clean = np.flatnonzero(truth > 0), np.flatnonzero(truth == 0)
    half = ROUND_WINDOWS // 2
    for turn in range(ROUNDS):
        if turn:
            gates = network.projected(network.inputs(words)) if words else np.zeros((1, 6 * HIDDEN), np.float32)
            suspicion = np.concatenate(
                [
                    network.forward(gates[np.maximum(w.T, 0)], w.T >= 0)
                    for w in (windows[s : s + WINDOWS_AT_ONCE] for s in range(0, len(windows), WINDOWS_AT_ONCE))
                ]
            )
            order = np.lexsort((-suspicion, owner))
            first = np.concatenate([[True], owner[order][1:] != owner[order][:-1]])
            rank = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
            leading = order[rank < LEADING]
            of_toxic, of_clean = leading[truth[leading] > 0], leading[truth[leading] == 0]
            picked = [rng.choice(of_toxic, half), rng.choice(of_clean, half // 2), rng.choice(clean, half // 2)]
        else:
            picked = [rng.choice(toxic, half), rng.choice(clean, half)]
        picked = np.concatenate(picked)
        picked = rng.permutation(picked)
        for start in range(0, len(picked), BATCH):
            some = picked[start : start + BATCH]
            used, ids_now = np.unique(windows[some].T, return_inverse=True)
            ids_now = ids_now.reshape(WINDOW_WORDS, len(some))
            if used[0] < 0:
                used, ids_now = used[1:], ids_now - 1
            if len(used):
                adam.update(network.gradients([words[i] for i in used], ids_now, truth[some], rng)[1])
    judge = Scorer(Model(network, 1.0, 0.0))
    held = np.flatnonzero(aside)
    held = held if len(set(y[held])) == 2 else np.arange(len(y))
    logits = np.concatenate([judge.logits([texts[i] for i in held[s : s + 64]]) for s in range(0, len(held), 64)])
    return Model(network, *_fitted(logits, y[held]))


def learn(docs: DataFrame, labels: DataFrame, allowed: Column, doc_id="doc_id", text="text", toxic="toxic") -> Model:
    """A model from the allowed rows that have a label; ``allowed`` is about the id."""
    judged = (
        labels.filter(F.col(toxic).isin(0, 1) & allowed)
        .groupBy(F.col(doc_id).cast("bigint").alias("__id"))
        .agg(F.max(toxic).alias("__toxic"))
        .join(docs.select(F.col(doc_id).cast("bigint").alias("__id")).distinct(), "__id", "left_semi")
    )
    chosen = {}
    for value in (0, 1):
        for key in bounded_keys(judged.filter(F.col("__toxic") == value), "__id", DOCS_PER_CLASS):
            chosen[key] = value
    if not chosen:
        return Model(None, 0.0, 0.0)
    texts = docs.select(F.col(doc_id).cast("bigint").alias("__id"), F.col(text).alias("__text"))
    sample = rows_for_keys(docs.sparkSession, texts, "__id", list(chosen))
    sample = sample.groupBy("__id").agg(F.min("__text").alias("__text"))  # repeated rows once
    rows = sorted((row[0], row[1]) for row in sample.toLocalIterator() if row[1] is not None)
    return train([r[1] for r in rows], [chosen[r[0]] for r in rows])


def score(docs: DataFrame, model: Model, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Add ``score`` and ``predicted``."""
    base = with_new_columns(docs, "score", "predicted")
    kept = [c for c in base.columns if keep_text or c != text]
    place, places = docs.columns.index(text), [docs.columns.index(c) for c in kept]
    schema = base.select(*kept).schema.add("score", "double").add("predicted", "integer")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            found = [np.zeros(0)]
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                found.append(scorer.scores(batch.column(place).slice(start, ROWS_AT_ONCE).to_pylist()))
            scores = np.concatenate(found)
            new = [pa.array(scores, pa.float64()), pa.array((scores >= TOXIC_FROM).astype(np.int32), pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in places] + new, names=[*kept, "score", "predicted"])

    return docs.mapInArrow(run, schema)
