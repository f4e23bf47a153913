"""Bootstrap draws of a forest: how often each row is taken for each tree.

A row's count for a tree is a Poisson(1) number. The rows of a partition take theirs one
after another, all trees of a row together, from a WELL19937c generator (Panneton,
L'Ecuyer, Matsumoto 2006) seeded by the forest's seed and the partition's number: the
draws that Spark ML's forests make, so a fit keeps its samples whatever grows the trees."""

from __future__ import annotations

import math

import numpy as np

_WORD = 0xFFFFFFFF
_R, _M1, _M2, _M3 = 624, 70, 179, 449
_BLOCKS = 300


class Well19937c:
    """Uniform numbers in [0, 1) of 52 bits, and Poisson numbers made of them, from a seed of 64 bits."""

    def __init__(self, seed: int):
        v = [(seed >> 32) & _WORD, seed & _WORD]
        for i in range(2, _R):
            x = v[i - 2] - (v[i - 2] >> 31 << 32)
            v.append((1812433253 * (x ^ (x >> 30)) + i) & _WORD)
        # The words by age, the oldest first; _M1 steps need no newer word but the last output.
        self.old, self.last, self.left = np.array(v[:0:-1], np.uint32), v[0], []

    def _more(self) -> list[float]:
        """The next numbers, in steps of _M1 words."""
        u = np.concatenate([self.old, np.zeros(_BLOCKS * _M1, np.uint32)])
        z4, last = [], self.last
        n = len(self.old)
        for at in range(n, len(u), _M1):
            def aged(k: int) -> np.ndarray:
                return u[at - k:at - k + _M1]
            b, d = aged(_M1), aged(_M3)
            z2 = (aged(_M2) >> 9) ^ d ^ (d >> 1)
            rest = (aged(n) & 0x80000000) ^ (aged(n - 1) & 0x7FFFFFFF) ^ z2 ^ (z2 << 21)
            z3s = []
            for r, p, q in zip((b ^ (b >> 27)).tolist(), z2.tolist(), rest.tolist()):
                z1 = last ^ (last << 25) & _WORD ^ r
                z3 = z1 ^ p
                last = q ^ z1 ^ (z1 << 9) & _WORD ^ z3 ^ z3 >> 21
                z3s.append(z3)
                z4.append(last)
            u[at:at + _M1] = z3s
        self.old, self.last = u[-n:], last
        out = np.array(z4, np.uint32)
        out ^= (out << 7) & 0xE46E1700
        out ^= (out << 15) & 0x9B868000
        out = (out >> 6).astype(np.int64)
        return ((out[::2] << 26 | out[1::2]) * 2.0 ** -52).tolist()

    def poisson(self, n: int) -> np.ndarray:
        """``n`` Poisson(1) numbers: uniform ones are multiplied until they fall below 1 / e."""
        least, out = math.exp(-1.0), bytearray(n)
        k, product, drawn = 0, 1.0, 0
        while k < n:
            numbers = self.left or self._more()
            self.left = []
            for i, x in enumerate(numbers):
                product *= x
                if product >= least:
                    drawn += 1
                    continue
                out[k] = drawn
                k, product, drawn = k + 1, 1.0, 0
                if k == n:
                    self.left = numbers[i + 1:]
                    break
        return np.frombuffer(bytes(out), np.uint8)
