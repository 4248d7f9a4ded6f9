"""Minimal perfect hash of a bounded set of keys, as arrays.

Level by level every key left takes one position in a bit array of ``SPARE`` positions per key;
keys alone at their position stay there, the others go to the next level. The number of set
bits before a key's bit is its slot, so n keys have the slots 0 to n - 1. A lookup tests one bit
per level, a constant number on average. A key that is not in the set ends at some slot or at
none; the fingerprint stored there tells it apart, up to one in 2 ** 32.
"""

from __future__ import annotations

import json
import struct

import numpy as np

MAGIC = b"TMPHIDX1"
SPARE = 1.5
LEVELS = 64
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _position(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys + _U((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) % _U(size)).astype(np.int64)


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ _U(0xA0761D6478BD642F)) >> _U(32)).astype(np.uint32)


class PerfectHash:
    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.starts = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(bits, dtype=np.int64)))

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """For distinct 64-bit keys."""
        sizes, parts, left = [], [], keys
        while len(left):
            if len(sizes) == LEVELS:
                raise ValueError("two keys are equal")
            size = max(8, int(len(left) * SPARE))
            place = _position(left, len(sizes), size)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            parts.append(alone)
            left = left[~alone[place]]
        return cls(sizes, np.concatenate(parts) if parts else np.zeros(0, bool))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of every key, -1 where no level has it."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            place = self.starts[level] + _position(keys[open_], level, size)
            hit = self.bits[place]
            out[open_[hit]] = self.before[place[hit]]
            open_ = open_[~hit]
            if not len(open_):
                break
        return out


def packed(keys: np.ndarray, columns: dict[str, np.ndarray]) -> bytes:
    """A file: header, bit array, fingerprints and value columns in slot order."""
    table = PerfectHash.of(keys)
    order = np.argsort(table.slots(keys))
    arrays = {"bits": np.packbits(table.bits), "fingerprint": fingerprint(keys)[order]}
    arrays |= {name: values[order] for name, values in columns.items()}
    head = {"sizes": table.sizes, "arrays": [[n, a.dtype.str, len(a)] for n, a in arrays.items()]}
    text = json.dumps(head).encode()
    return b"".join([MAGIC, struct.pack("<Q", len(text)), text, *(a.tobytes() for a in arrays.values())])


class Index:
    """What ``packed`` wrote, for lookups."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not an index file")
        (size,) = struct.unpack_from("<Q", data, 8)
        head = json.loads(data[16 : 16 + size])
        at, arrays = 16 + size, {}
        for name, kind, n in head["arrays"]:
            arrays[name] = np.frombuffer(data, np.dtype(kind), n, at)
            at += arrays[name].nbytes
        bits = np.unpackbits(arrays.pop("bits"))[: sum(head["sizes"])].astype(bool)
        self.table = PerfectHash(head["sizes"], bits)
        self.fingerprints = arrays.pop("fingerprint")
        self.columns = arrays

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Which keys are there, and the values of those."""
        slots = self.table.slots(keys)
        there = slots >= 0
        there[there] = self.fingerprints[slots[there]] == fingerprint(keys[there])
        return there, {name: values[slots[there]] for name, values in self.columns.items()}
