"""A bidirectional gated recurrent network with attention pooling, in numpy.

Each word of a window enters as the sum of two inputs: a vector of the word
itself and the vectors of its character n-grams, both from hashed tables. Two
gated recurrent layers read the window forwards and backwards, attention weighs
the positions, and one output unit judges the pooled state.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WORD_ROWS, GRAM_ROWS = 1 << 13, 1 << 15
GRAM_SIZES = (3, 4, 5)
WIDTH, HIDDEN = 8, 8
FEATURES_AT_ONCE = 1 << 19


def features_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of each word, rows of its character n-grams, and where each word's begin.

    Characters are the bytes of the word between a start and an end mark; a word
    too short for the longest sizes has at least the n-grams of three bytes.
    """
    data = b"".join([b"\x02" + w + b"\x03" for w in words])
    sizes = np.array([len(w) + 2 for w in words])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    padded = data + b"\0" * 8
    raw = np.ndarray((len(data),), "<u8", padded, strides=(1,))
    owner = np.repeat(np.arange(len(words)), sizes)
    room = np.repeat(starts + sizes, sizes) - np.arange(len(data))
    owners, rows = [], []
    for size in GRAM_SIZES:
        inside = room >= size
        gram = raw[inside] & np.uint64((1 << 8 * size) - 1)
        mixed = (gram ^ np.uint64(size << 56)) * np.uint64(0x9E3779B97F4A7C15)
        rows.append(((mixed ^ mixed >> np.uint64(29)) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(49)).astype(np.int64))
        owners.append(owner[inside])
    owners, rows = np.concatenate(owners), np.concatenate(rows) % GRAM_ROWS
    order = np.argsort(owners, kind="stable")
    counts = np.bincount(owners, minlength=len(words))
    # a word's own row: the sum of its mixed bytes by place, which is a hash of the whole word
    place = np.arange(len(data)) - np.repeat(starts, sizes)
    value = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    powers = np.multiply.accumulate(np.full(int(sizes.max(initial=1)), 0x100000001B3, np.uint64))
    whole = np.add.reduceat(value * powers[place], starts) if len(words) else np.zeros(0, np.uint64)
    own = ((whole ^ whole >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(51)).astype(np.int64)
    return own % WORD_ROWS, rows[order], np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)


def _sigmoid(x):
    return 0.5 + 0.5 * np.tanh(0.5 * x)  # cannot overflow


@dataclass
class Network:
    """The parameters, all 32-bit floats."""

    p: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)

        def draw(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        p = {"word": draw(WORD_ROWS, WIDTH, scale=0.1), "gram": draw(GRAM_ROWS, WIDTH, scale=0.1)}
        for side in "fb":
            p[f"W{side}"] = draw(2 * WIDTH, 3 * HIDDEN, scale=0.3)
            p[f"U{side}"] = draw(HIDDEN, 3 * HIDDEN, scale=0.3)
            p[f"b{side}"] = np.zeros(3 * HIDDEN, np.float32)
        p["A"] = draw(2 * HIDDEN, HIDDEN, scale=0.3)
        p["a"] = draw(HIDDEN, scale=0.3)
        p["o"] = draw(2 * HIDDEN, scale=0.3)
        p["c"] = np.zeros(1, np.float32)
        return cls(p)

    def inputs(self, words: list[bytes]) -> np.ndarray:
        """Input vectors of words: the word's own and its character n-grams'."""
        out = []
        for start in range(0, len(words), 1 << 14):
            own, grams, begins = features_of(words[start : start + (1 << 14)])
            counts = np.diff(np.append(begins, len(grams)))
            summed = np.add.reduceat(self.p["gram"][grams], begins, axis=0) / np.sqrt(counts)[:, None]
            out.append(np.concatenate([self.p["word"][own], summed.astype(np.float32)], axis=1))
        return np.concatenate(out) if out else np.zeros((0, 2 * WIDTH), np.float32)

    def projected(self, inputs: np.ndarray) -> np.ndarray:
        """What each input adds to the gates of both directions."""
        both = [inputs @ self.p[f"W{s}"] + self.p[f"b{s}"] for s in "fb"]
        return np.concatenate(both, axis=1)

    def _direction(self, side: str, gates: np.ndarray, real: np.ndarray, keep: list | None):
        """States after each step; gates (time, window, 3 * HIDDEN), real (time, window, 1)."""
        recurrent, n = self.p[f"U{side}"], HIDDEN
        state = np.zeros((gates.shape[1], n), np.float32)
        states = np.empty((*gates.shape[:2], n), np.float32)
        times = range(len(gates)) if side == "f" else range(len(gates) - 1, -1, -1)
        for t in times:
            own, back = gates[t], state @ recurrent
            zr = _sigmoid(own[:, : 2 * n] + back[:, : 2 * n])
            z, r = zr[:, :n], zr[:, n:]
            new = np.tanh(own[:, 2 * n :] + r * back[:, 2 * n :])
            step = (1 - z) * (new - state) * real[t]
            if keep is not None:
                keep.append((t, state, z, r, new, back[:, 2 * n :]))
            state = state + step
            states[t] = state
        return states

    def forward(self, gates: np.ndarray, real: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of windows; gates (time, window, 6 * HIDDEN), real (time, window) booleans."""
        n, mask = 3 * HIDDEN, real[:, :, None].astype(np.float32)
        kept = {"f": [], "b": []} if keep is not None else {"f": None, "b": None}
        states = np.concatenate(
            [self._direction("f", gates[:, :, :n], mask, kept["f"]), self._direction("b", gates[:, :, n:], mask, kept["b"])],
            axis=2,
        )
        seen = np.tanh(states @ self.p["A"])
        weight = np.where(real, seen @ self.p["a"], np.float32(-1e9))
        weight = np.exp(weight - weight.max(axis=0)) * real
        weight /= np.maximum(weight.sum(axis=0), np.float32(1e-9))  # a window without words pools to nothing
        pooled = (weight[:, :, None] * states).sum(axis=0)
        if keep is not None:
            keep.update(kept=kept, states=states, seen=seen, weight=weight, pooled=pooled, mask=mask)
        return pooled @ self.p["o"] + self.p["c"]

    def gradients(self, words: list[bytes], ids: np.ndarray, labels: np.ndarray, drop=None):
        """Mean logistic loss of windows and its gradients; ids (time, window), -1 pads.

        With a generator ``drop``, half of the words go without their own vector,
        so that their characters have to carry the meaning as well.
        """
        p, n = self.p, HIDDEN
        whole = np.ones(len(words)) if drop is None else drop.random(len(words)) < 0.5
        whole = whole[:, None].astype(np.float32) * (1 if drop is None else 2)
        own, grams, begins = features_of(words)
        counts = np.diff(np.append(begins, len(grams)))
        norm = (1 / np.sqrt(counts)).astype(np.float32)
        x = np.concatenate([p["word"][own] * whole, np.add.reduceat(p["gram"][grams], begins, axis=0) * norm[:, None]], axis=1)
        real = ids >= 0
        gates = self.projected(x)[np.maximum(ids, 0)]
        keep: dict = {}
        logits = self.forward(gates, real, keep)
        chance = _sigmoid(logits)
        loss = -np.mean(np.where(labels > 0, np.log(chance + 1e-9), np.log(1 - chance + 1e-9)))
        g = {k: np.zeros_like(v) for k, v in p.items()}
        d = ((chance - labels) / len(labels)).astype(np.float32)
        g["o"], g["c"] = keep["pooled"].T @ d, d.sum(keepdims=True)
        pooled = d[:, None] * p["o"]
        states, weight, seen = keep["states"], keep["weight"], keep["seen"]
        dstates = weight[:, :, None] * pooled[None]
        dweight = (states * pooled[None]).sum(axis=2)
        dscore = weight * (dweight - (weight * dweight).sum(axis=0))
        g["a"] = np.tensordot(seen, dscore, axes=([0, 1], [0, 1]))
        dseen = dscore[:, :, None] * p["a"] * (1 - seen * seen)
        g["A"] = np.tensordot(states, dseen, axes=([0, 1], [0, 1]))
        dstates = dstates + dseen @ p["A"].T
        dgates = np.zeros_like(gates)
        for side, shift in (("f", 0), ("b", 3 * n)):
            flow = np.zeros((ids.shape[1], n), np.float32)
            recurrent, part = p[f"U{side}"], slice(0, n) if side == "f" else slice(n, 2 * n)
            for t, state, z, r, new, back in reversed(keep["kept"][side]):
                flow = flow + dstates[t][:, part]
                moved = flow * keep["mask"][t]
                dnew = moved * (1 - z) * (1 - new * new)
                dz = moved * (state - new) * z * (1 - z)
                dr = dnew * back * r * (1 - r)
                own_side = np.concatenate([dz, dr, dnew], axis=1)
                back_side = np.concatenate([dz, dr, dnew * r], axis=1)
                dgates[t][:, shift : shift + 3 * n] = own_side
                g[f"U{side}"] += state.T @ back_side
                flow = flow - moved * (1 - z) + back_side @ recurrent.T
        per_word = np.zeros((len(words), 6 * n), np.float32)
        np.add.at(per_word, ids[real], dgates[real])
        dx = np.zeros_like(x)
        for side, shift in (("f", 0), ("b", 3 * n)):
            some = per_word[:, shift : shift + 3 * n]
            g[f"W{side}"], g[f"b{side}"] = x.T @ some, some.sum(axis=0)
            dx += some @ p[f"W{side}"].T
        np.add.at(g["word"], own, dx[:, :WIDTH] * whole)
        np.add.at(g["gram"], grams, np.repeat(dx[:, WIDTH:] * norm[:, None], counts, axis=0))
        return loss, g


class Adam:
    def __init__(self, network: Network, rate: float):
        self.network, self.rate, self.step = network, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in network.p.items()}
        self.square = {k: np.zeros_like(v) for k, v in network.p.items()}

    def update(self, gradients: dict[str, np.ndarray]) -> None:
        self.step += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        for k, g in gradients.items():
            m, s = self.mean[k], self.square[k]
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            self.network.p[k] -= (scale * m / (np.sqrt(s) + 1e-8)).astype(np.float32)
