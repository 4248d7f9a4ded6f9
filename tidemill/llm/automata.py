"""Weighted acyclic automata over words: the counts of a set of phrases.

A path from the root spells a phrase, and the weight of its last transition is the phrase's
count; weight 0 marks a prefix that is not counted here. Phrases come sorted, so all
transitions of a state are neighbors. States without transitions are one state, and states
with a single transition of the same word and weight are one state too, which is where most of
the sharing lies: most pairs of words have one continuation.

A set of phrases is an array of ORDER rows, one column per phrase: the numbers of its words,
from 1, and 0 where it has ended.
"""

from __future__ import annotations

import numpy as np

ORDER = 3
_FINAL = 1


def narrow(x: np.ndarray) -> bytes:
    """Non-negative numbers in the narrowest type that holds them."""
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0)).tobytes()


def widen(data: bytes, count: int) -> np.ndarray:
    found = np.frombuffer(data, f"u{len(data) // count if count else 1}")
    return found.astype(np.int32 if found.itemsize < 4 else np.int64)


def _firsts(new: np.ndarray, n: int) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(new) + 1]) if n else np.empty(0, np.int64)


def summed(phrases: np.ndarray, counts: np.ndarray | None, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct phrases and their summed counts; without ``counts`` each is one."""
    n, bits = phrases.shape[1], max(1, symbols.bit_length())
    if ORDER * bits < 64:
        # Three numbers of at most 21 bits sort as one.
        key = phrases[0].astype(np.int64)
        for row in phrases[1:]:
            key <<= bits
            key |= row
        if counts is None:
            key.sort()
        else:
            order = np.argsort(key)
            key, counts = key[order], counts[order]
            del order
        first = _firsts(key[1:] != key[:-1], n)
        key = key[first]
        phrases = np.stack([(key >> (bits * (ORDER - 1 - k))) & ((1 << bits) - 1) for k in range(ORDER)]).astype(np.int32)
    else:
        order = np.lexsort(phrases[::-1])
        phrases, counts = phrases[:, order], None if counts is None else counts[order]
        first = _firsts((phrases[:, 1:] != phrases[:, :-1]).any(axis=0), n)
        phrases = phrases[:, first]
    if counts is None:
        return phrases, np.diff(first, append=n)
    return phrases, np.add.reduceat(counts, first) if n else counts


class CountAutomaton:
    """Words in byte order; per transition its word (from 1), weight and target, by source state."""

    def __init__(self, words: list[bytes], first: np.ndarray, symbol: np.ndarray, weight: np.ndarray, target: np.ndarray):
        self.words, self.first, self.symbol, self.weight, self.target = words, first, symbol, weight, target

    @classmethod
    def build(cls, words: list[bytes], phrases: np.ndarray, counts: np.ndarray) -> CountAutomaton:
        """From sorted distinct phrases over ``words``; words that no phrase has are left out."""
        if not phrases.shape[1]:
            return cls([], np.zeros(3, np.int64), *(np.empty(0, np.int64),) * 3)
        used = np.zeros(len(words) + 1, bool)
        used[phrases] = True
        used[0] = False
        names = np.cumsum(used)
        names[~used] = 0
        c0, c1, c2 = names.astype(np.int32)[phrases]
        words = [words[i] for i in (np.flatnonzero(used) - 1).tolist()]

        one = np.ones(len(c0), bool)
        one[1:] = c0[1:] != c0[:-1]
        two = one.copy()
        two[1:] |= c1[1:] != c1[:-1]
        two &= c1 > 0
        three = c2 > 0
        n1, n2 = int(one.sum()), int(two.sum())
        of1, of2 = np.cumsum(one) - 1, np.cumsum(two) - 1
        weight1, weight2 = np.zeros(n1, np.int64), np.zeros(n2, np.int64)
        lone = c1 == 0
        weight1[of1[lone]] = counts[lone]
        pairs = ~lone & ~three
        weight2[of2[pairs]] = counts[pairs]
        degree1, degree2 = np.bincount(of1[two], minlength=n1), np.bincount(of2[three], minlength=n2)

        # Continuations of pairs: single ones are shared, the others are states of their own.
        symbol3, weight3 = c2[three], counts[three]
        single = np.repeat(degree2 == 1, degree2)
        many = len(words) + 1
        shared, name = np.unique(weight3[single].astype(np.int64) * many + symbol3[single], return_inverse=True)
        own1, own2 = degree1 > 0, degree2 > 1
        target1, target2 = np.full(n1, _FINAL), np.full(n2, _FINAL)
        after = 2 + int(own1.sum())
        target1[own1] = np.arange(2, after)
        target2[degree2 == 1] = after + name
        target2[own2] = after + len(shared) + np.arange(int(own2.sum()))
        degrees = np.concatenate([[n1, 0], degree1[own1], np.ones(len(shared), np.int64), degree2[own2]])
        return cls(
            words,
            np.concatenate([[0], np.cumsum(degrees)]),
            np.concatenate([c0[one], c1[two], shared % many, symbol3[~single]]),
            np.concatenate([weight1, weight2, shared // many, weight3[~single]]),
            np.concatenate([target1, target2, np.full(len(shared) + int((~single).sum()), _FINAL)]),
        )

    def packed(self) -> tuple[bytes, int, int, bytes, bytes, bytes, bytes]:
        degrees = np.diff(self.first)
        return (b"\n".join(self.words), len(degrees), len(self.symbol), narrow(degrees), narrow(self.symbol), narrow(self.weight), narrow(self.target))

    @classmethod
    def unpacked(cls, words, states, transitions, degrees, symbol, weight, target) -> CountAutomaton:
        first = np.concatenate([[0], np.cumsum(widen(degrees, states))])
        return cls(words.split(b"\n") if words else [], first, *(widen(x, transitions) for x in (symbol, weight, target)))

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """All counted phrases, the shorter ones first, and their counts."""
        prefix, state, found = np.zeros((ORDER, 1), np.int32), np.zeros(1, np.int64), []
        for level in range(ORDER):
            degree = self.first[state + 1] - self.first[state]
            stop = np.cumsum(degree)
            at = np.repeat(self.first[state] - (stop - degree), degree) + np.arange(stop[-1] if len(stop) else 0)
            prefix = np.repeat(prefix, degree, axis=1)
            prefix[level] = self.symbol[at]
            state, counts = self.target[at], self.weight[at]
            counted = counts > 0
            found.append((prefix[:, counted], counts[counted]))
        return np.concatenate([f[0] for f in found], axis=1), np.concatenate([f[1] for f in found])

    def phrases(self) -> tuple[np.ndarray, np.ndarray]:
        """All counted phrases in order, and their counts."""
        return summed(*self.paths(), len(self.words))

    def counts_of(self, phrases: list[list[bytes]]) -> np.ndarray:
        """The automaton composed with each phrase: its count, 0 where there is no path."""
        count = np.zeros(len(phrases), np.int64)
        if not len(self.symbol):
            return count
        number = {w: i for i, w in enumerate(self.words, 1)}
        symbols = np.array([[number.get(w, -1) for w in p] + [0] * (ORDER - len(p)) for p in phrases], np.int64).reshape(-1, ORDER)
        base = len(self.words) + 1
        key = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first)) * base + self.symbol
        state, alive = np.zeros(len(symbols), np.int64), np.ones(len(symbols), bool)
        for level in range(ORDER):
            going = symbols[:, level] != 0
            wanted = state * base + symbols[:, level]
            at = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
            met = alive & (symbols[:, level] > 0) & (key[at] == wanted)
            count = np.where(going, np.where(met, self.weight[at], 0), count)
            state = np.where(met, self.target[at], state)
            alive &= met | ~going
        return count


def union(automata: list[CountAutomaton], least: int = 1) -> CountAutomaton:
    """The automaton of all phrases with summed counts of at least ``least``."""
    words = sorted(set().union(*(a.words for a in automata)))
    number = {w: i for i, w in enumerate(words, 1)}
    parts = [a.paths() for a in automata]
    ends = np.cumsum([0, *(len(counts) for _, counts in parts)]).tolist()
    phrases, counts = np.empty((ORDER, ends[-1]), np.int32), np.empty(ends[-1], np.int64)
    for a, b, e in zip(automata, ends, ends[1:]):
        own, counts[b:e] = parts.pop(0)
        phrases[:, b:e] = np.fromiter((0, *map(number.__getitem__, a.words)), np.int32, len(a.words) + 1)[own]
    del number
    phrases, counts = summed(phrases, counts, len(words))
    kept = counts >= least
    return CountAutomaton.build(words, phrases[:, kept], counts[kept])
