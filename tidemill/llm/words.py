"""Words as numbers: hashes of words and of fixed-length windows of words."""

from __future__ import annotations

import numpy as np
import xxhash

U = np.uint64
# Entries of a task's memo of word hashes; it is emptied when full.
MEMO = 400_000
# Words hashed in one step; a longer text is taken in overlapping pieces.
PIECE = 1 << 18


class WordHashes(dict):
    """64-bit hash of every word asked for."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), U, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class RollingHash:
    """Rabin-Karp hashes of all windows of a sequence, modulo 2 ** 64.

    The hash of ``x[i : i + window]`` is the sum of ``x[i + j] * base ** j``. Prefix sums of
    ``x[i] * base ** i`` give every window as a difference, shifted back by the inverse of the
    odd base. The result is mixed, so that all bits depend on all words.
    """

    def __init__(self, base: int, window: int):
        self.window = window
        ones = np.ones(PIECE + window, U)
        self.power, self.inverse = ones.copy(), ones
        self.power[1:] = np.cumprod(np.full(len(ones) - 1, base, U))
        self.inverse[1:] = np.cumprod(np.full(len(ones) - 1, pow(base, -1, 1 << 64), U))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        n = max(0, len(x) - self.window + 1)
        out = np.empty(n, U)
        for begin in range(0, n, PIECE):
            part = x[begin : begin + PIECE + self.window - 1]
            sums = np.zeros(len(part) + 1, U)
            np.cumsum(part * self.power[: len(part)], out=sums[1:])
            count = len(part) - self.window + 1
            out[begin : begin + count] = (sums[self.window :] - sums[: -self.window]) * self.inverse[:count]
        return mix(out)
