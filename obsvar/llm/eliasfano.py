"""Elias-Fano sequences and a two-level n-gram trie over them, in memory-mapped arrays."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Sequence

import numpy as np

_ONE = np.uint64(1)
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def mapped(arrays: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The arrays as read-only maps of one temporary file, which has no name any more."""
    handle, path = tempfile.mkstemp(prefix="trie-")
    out, at = {}, {}
    with os.fdopen(handle, "wb") as file:
        for name, array in arrays.items():
            file.write(b"\0" * (-file.tell() % 64))
            at[name] = file.tell()
            file.write(np.ascontiguousarray(array).tobytes())
        file.write(b"\0" * 64)
    try:
        for name, array in arrays.items():
            out[name] = np.memmap(path, array.dtype, "r", at[name], array.shape) if array.size else array
    finally:
        os.unlink(path)  # the maps keep the pages; nothing stays behind, however the task ends
    return out


class EliasFano:
    """A sorted sequence of distinct or equal 64-bit numbers in about 2 + log(universe / n) bits each.

    Low bits are packed; the high part of element i sets bit (high + i) of a bit vector, with the
    number of zeros before each of its words as the directory.
    """

    def __init__(self, parts: dict[str, np.ndarray], n: int, low_bits: int, name: str):
        self.n, self.low_bits = n, low_bits
        self.low, self.high, self.zeros = (parts[f"{name}.{p}"] for p in ("low", "high", "zeros"))

    @staticmethod
    def encode(values: np.ndarray, name: str) -> tuple[dict[str, np.ndarray], int, int]:
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        bits = max(0, (top // max(1, n)).bit_length() - 1)
        low = np.zeros((n * bits >> 6) + 2, np.uint64)
        if bits and n:
            part = values & ((_ONE << np.uint64(bits)) - _ONE)
            place = np.arange(n, dtype=np.uint64) * np.uint64(bits)
            word, shift = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            np.bitwise_or.at(low, word, part << shift)
            over = shift + np.uint64(bits) > np.uint64(64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        upper = (values >> np.uint64(bits)).astype(np.int64) if bits < 64 else np.zeros(n, np.int64)
        length = (int(upper[-1]) if n else 0) + n + 2
        flags = np.zeros((length + 63) // 64 * 64, np.uint8)
        flags[upper + np.arange(n)] = 1
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(high).astype(np.int64)
        zeros = np.concatenate(([0], np.cumsum(64 - ones))).astype(np.int64)
        return {f"{name}.low": low, f"{name}.high": high, f"{name}.zeros": zeros}, n, bits

    def low_of(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        place = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
        value = self.low[word] >> shift
        spill = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return (value | spill) & (_FULL >> np.uint64(64 - self.low_bits))

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Position of the k-th zero of the bit vector (from 0)."""
        word = np.searchsorted(self.zeros, k, "right") - 1
        bits = ~self.high[word]
        left = k - self.zeros[word]
        at = np.zeros(len(k), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            part = bits & ((_ONE << np.uint64(width)) - _ONE)
            count = np.bitwise_count(part).astype(np.int64)
            skip = left >= count
            left = np.where(skip, left - count, left)
            at += np.where(skip, width, 0)
            bits = np.where(skip, bits >> np.uint64(width), part)
        return word * 64 + at

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of the first element equal to each number, or -1: a successor search by high part."""
        out = np.full(len(x), -1, np.int64)
        if not self.n:
            return out
        high = (x >> np.uint64(self.low_bits)).astype(np.int64)
        low = x & (_FULL >> np.uint64(64 - self.low_bits)) if self.low_bits else np.zeros(len(x), np.uint64)
        inside = np.flatnonzero(high < int(self.zeros[-1]))
        at = np.where(high[inside] > 0, self._zero(np.maximum(0, high[inside] - 1)) - np.maximum(0, high[inside] - 1), 0)
        end = self._zero(high[inside]) - high[inside]
        while len(inside):
            more = at < end
            inside, at, end = inside[more], at[more], end[more]
            here = self.low_of(at)
            same = here == low[inside]
            out[inside[same]] = at[same]
            onward = here < low[inside]
            inside, at, end = inside[onward], at[onward] + 1, end[onward]
        return out

    def get(self, i: np.ndarray) -> np.ndarray:
        """The elements at the given places."""
        word = np.searchsorted(np.arange(len(self.zeros)) * 64 - self.zeros, i, "right") - 1
        ones = i - (word * 64 - self.zeros[word])
        bits, at = self.high[word], np.zeros(len(i), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            part = bits & ((_ONE << np.uint64(width)) - _ONE)
            count = np.bitwise_count(part).astype(np.int64)
            skip = ones >= count
            ones = np.where(skip, ones - count, ones)
            at += np.where(skip, width, 0)
            bits = np.where(skip, bits >> np.uint64(width), part)
        high = (word * 64 + at - i).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self.low_of(i)


class Codebook:
    """Numbers as one byte each: the nearest of 255 quantiles; equal numbers of few kinds stay exact."""

    @staticmethod
    def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kinds = np.unique(values)
        if len(kinds) > 255:
            kinds = np.unique(np.quantile(values, np.linspace(0, 1, 255)))
        right = np.clip(np.searchsorted(kinds, values), 1, max(1, len(kinds) - 1))
        if len(kinds) < 2:
            return kinds, np.zeros(len(values), np.uint8)
        nearer = np.where(values - kinds[right - 1] <= kinds[right] - values, right - 1, right)
        return kinds, nearer.astype(np.uint8)


class Trie:
    """Contexts, and the successors of each with their log probabilities.

    ``contexts`` are sorted distinct 64-bit hashes. ``owner`` and ``word`` list the successors,
    sorted by the number of their context and then by a 32-bit hash of the word. A successor is
    stored relative to its context: the last value of the context before it is added, so that the
    level is one monotone sequence. A third one points from contexts to their ranges.
    """

    def __init__(self, contexts: np.ndarray, backoff: np.ndarray, owner: np.ndarray, word: np.ndarray, score: np.ndarray):
        size = np.bincount(owner, minlength=len(contexts))
        pointer = np.concatenate(([0], np.cumsum(size))).astype(np.uint64)
        last = word[np.maximum(pointer[1:].astype(np.int64) - 1, 0)] if len(word) else np.zeros(len(contexts), np.uint64)
        base = np.concatenate((np.zeros(1, np.uint64), np.cumsum(last + _ONE, dtype=np.uint64)))
        parts, shapes = {}, {}
        levels = {"contexts": contexts, "pointers": pointer, "words": base[owner] + word, "bases": base}
        for name, values in levels.items():
            found, n, bits = EliasFano.encode(values.astype(np.uint64), name)
            parts |= found
            shapes[name] = (n, bits)
        for name, values in (("backoff", backoff), ("score", score)):
            parts[f"{name}.book"], parts[f"{name}.code"] = Codebook.encode(values)
        self.parts = mapped(parts)
        self.contexts, self.pointers, self.words, self.bases = (EliasFano(self.parts, *shapes[n], n) for n in levels)

    def values(self, name: str, at: np.ndarray) -> np.ndarray:
        return self.parts[f"{name}.book"][self.parts[f"{name}.code"][at]]

    def look_up(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log probability where the successor is known, else the context's backoff, else 0.

        Also tells whether the successor, and whether the context, is known.
        """
        at = self.contexts.find(context)
        known = at >= 0
        seen = np.zeros(len(context), bool)
        out = np.zeros(len(context))
        rows = np.flatnonzero(known)
        first, base = self.pointers.get(at[rows]).astype(np.int64), self.bases.get(at[rows])
        after = self.pointers.get(at[rows] + 1).astype(np.int64)
        place = self.words.find(base + word[rows])
        hit = (place >= first) & (place < after)
        out[rows[hit]] = self.values("score", place[hit])
        out[rows[~hit]] = self.values("backoff", at[rows[~hit]])
        seen[rows[hit]] = True
        return out, seen, known

    def nbytes(self) -> int:
        return sum(p.nbytes for p in self.parts.values())


def joined(arrays: Sequence[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.empty(0, kind)
