"""Words and rolling hashes of Arrow string arrays in numpy, a bounded block of bytes at a time.

A block is a run of whole rows of at most ``BLOCK_BYTES`` of text (or one longer row). Hashes are
polynomials over random byte values modulo 2**64, taken from one running sum per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK_BYTES = 1 << 20
#: Rows of one Arrow batch of texts: with long texts the default would take gigabytes.
BATCH_ROWS = 1_000
_MULT = np.uint64(0x9E3779B97F4A7C15)  # odd, so that powers can be inverted modulo 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_GRAM = np.uint64(0xD6E8FEB86659FD93)
_VALUES = np.random.default_rng(20_240_917).integers(1, 1 << 63, 256, dtype=np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Separators of plain words: space and \x09-\x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Everything in ASCII but letters and digits; bytes of longer code points belong to words.
PUNCT = np.ones(256, dtype=bool)
PUNCT[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the multiplier and of its inverse."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        up, down = np.full(size, _MULT), np.full(size, _INVERSE)
        up[0] = down[0] = 1
        _powers = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Block:
    """Bytes of consecutive rows, with the first row's number and the rows' byte bounds."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, first: int):
        self.data, self.bounds, self.first, self.rows = data, bounds, first, len(bounds) - 1
        self._sums: np.ndarray | None = None

    def words(self, separators: np.ndarray) -> None:
        """Sets ``start``, ``end`` (bytes of each word), ``row`` and ``edge`` (first word of each row)."""
        inside = ~separators[self.data]
        cut = np.zeros(len(self.data) + 1, dtype=bool)
        cut[self.bounds] = True
        before = np.concatenate(([False], inside[:-1])) if len(inside) else inside
        after = np.concatenate((inside[1:], [False])) if len(inside) else inside
        self.start = np.flatnonzero(inside & (~before | cut[:-1]))
        self.end = np.flatnonzero(inside & (~after | cut[1:])) + 1
        self.edge = np.searchsorted(self.start, self.bounds)
        self.counts = np.diff(self.edge)
        self.row = np.repeat(np.arange(self.rows), self.counts)

    def hashes(self, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each byte range; equal bytes give equal hashes in any block."""
        if self._sums is None:
            up, _ = powers(len(self.data) + 1)
            values = _VALUES[LOWER[self.data]] if lower else _VALUES[self.data]
            self._sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * up[:-1], dtype=np.uint64)))
        _, down = powers(len(self.data) + 1)
        return mix((self._sums[end] - self._sums[start]) * down[start] + (end - start).astype(np.uint64))

    def points(self) -> np.ndarray:
        """Code points before each byte position."""
        return np.concatenate(([0], np.cumsum((self.data & 0xC0) != 0x80)))


def grams(word: np.ndarray, n: int) -> np.ndarray:
    """Hashes of ``n`` consecutive word hashes from each position; the last ``n - 1`` mean nothing."""
    rolled = word.copy()
    for i in range(1, n):
        rolled = extend(rolled, word, i)
    return rolled


def extend(rolled: np.ndarray, word: np.ndarray, i: int) -> np.ndarray:
    """The hashes of ``i`` words, made those of ``i + 1``."""
    following = np.zeros_like(word)
    following[: max(0, len(word) - i)] = word[i:]
    return rolled * _GRAM + following


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The rows of a string array as blocks; a null row has no bytes."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    buffers = texts.buffers()
    bounds = np.frombuffer(buffers[1], np.int64, n + 1, texts.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        low, high = bounds[first], bounds[last]
        yield Block(data[low:high], bounds[first : last + 1] - low, first)
        first = last


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session told to send at most ``BATCH_ROWS`` rows to Python at a time.

    A smaller setting stays. Spark has this setting by session only.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key, "10000")) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


def crc_slot(ids: str) -> str:
    """SQL of crc32 over an id written as text; null ids count as the empty text."""
    return f"crc32(encode(coalesce(cast({ids} as string), ''), 'UTF-8'))"
