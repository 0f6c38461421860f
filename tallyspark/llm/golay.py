"""Keys for numbers that differ in few bits, from the perfect Golay code.

The binary Golay code of 23 bits has 4,096 codewords; every 23-bit number lies
within three bits of exactly one, its *home*. Most numbers lie at distance
three, and then five more codewords are four bits away. Two numbers that differ
in one bit at most each have the home of the other among these *near* ones.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

# Fixed value: the generator polynomial of the code, bit i for the power i.
GENERATOR = 0b110001110101
BITS, CHECK_BITS = 23, 11
NEAR = 6


def _remainder(word: int) -> int:
    for at in range(BITS - 1, CHECK_BITS - 1, -1):
        if word >> at & 1:
            word ^= GENERATOR << (at - CHECK_BITS)
    return word


class Golay:
    def __init__(self):
        powers = [_remainder(1 << i) for i in range(BITS)]

        def syndrome(word: int) -> int:
            out = 0
            for i, power in enumerate(powers):
                if word >> i & 1:
                    out ^= power
            return out

        self.low = np.array([syndrome(x) for x in range(1 << 12)], np.uint32)
        self.high = np.array([syndrome(x << 12) for x in range(1 << CHECK_BITS)], np.uint32)
        self.leader = np.zeros(1 << CHECK_BITS, np.uint32)
        self.others = np.zeros((1 << CHECK_BITS, NEAR - 1), np.uint32)
        self.count = np.ones(1 << CHECK_BITS, np.int64)
        for weight in range(1, 5):
            for bits in combinations(range(BITS), weight):
                error, left = sum(1 << b for b in bits), 0
                for b in bits:
                    left ^= powers[b]
                if weight < 4:
                    self.leader[left] = error
                else:
                    self.others[left, self.count[left] - 1] = error
                    self.count[left] += 1

    def near(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices of the codewords within four bits, home first, and their number.

        Places beyond the number repeat the home.
        """
        values = values.astype(np.uint32)
        left = self.low[values & np.uint32(0xFFF)] ^ self.high[values >> np.uint32(12)]
        errors = np.concatenate([self.leader[left][:, None], self.others[left]], axis=1)
        count = self.count[left]
        errors = np.where(np.arange(NEAR)[None, :] < count[:, None], errors, errors[:, :1])
        return (values[:, None] ^ errors) >> np.uint32(CHECK_BITS), count
