"""Shingle sets of texts, their frequency sketch, and prefixes under several token orders."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from obsvar.llm import textblocks as tb

#: Buckets of the frequency sketch: its size is fixed, whatever the corpus.
SKETCH_BITS, SLICES = 20, 16
#: Bytes of text that are hashed and sorted at once: some 60 bytes of arrays for each.
BYTES = 1 << 18
#: Values that tell the token orders and the two fingerprints apart.
ORDER_SALTS = (0x0, 0x51ED270B9F3A4C65, 0x2545F4914F6CDD1D)
PRINT_SALTS = (0x7F4A7C15F39CC060, 0x1B873593CC9E2D51)


def shingles(block: tb.Block, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every shingle: ``words`` lower-cased words, or all of a shorter text."""
    block.words(tb.SPACE)
    word = block.hashes(block.start, block.end, lower=True)
    left = block.edge[1:][block.row] - np.arange(len(word))
    first = np.zeros(len(word), bool)
    first[block.edge[:-1][block.counts > 0]] = True
    rolled, found, rows = word, [], []
    for k in range(1, words + 1):
        if k > 1:
            rolled = tb.extend(rolled, word, k - 1)
        take = left >= k if k == words else first & (left == k)
        found.append(tb.mix(rolled[take] + np.uint64(k)))
        rows.append(block.row[take])
    return np.concatenate(found), np.concatenate(rows)


def by_row(key: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The order by row, then by key."""
    order = np.argsort(key)
    small = row[order]
    return order[np.argsort(small.astype(np.uint16) if len(row) and row.max() < 65_536 else small, kind="stable")]


def ranked(hashes: np.ndarray, levels: np.ndarray, salt: int) -> np.ndarray:
    """A sort key: rare tokens first, then by a hash of the token."""
    level = levels[(hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
    return (level << np.uint64(56)) | (tb.mix(hashes ^ np.uint64(salt)) >> np.uint64(8))


def distinct_sets(block: tb.Block, words: int, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in the first token order within each row, their rows, and the set sizes."""
    hashes, row = shingles(block, words)
    order = by_row(ranked(hashes, levels, ORDER_SALTS[0]), row)
    hashes, row = hashes[order], row[order]
    if len(row):
        new = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])))
        hashes, row = hashes[new], row[new]
    return hashes, row, np.bincount(row, minlength=block.rows)


def prefix_sizes(sizes: np.ndarray, percent: int, agree: int = 1) -> np.ndarray:
    """How many first tokens of a set surely hold ``agree`` of any set that is similar enough.

    Where so few tokens make sets similar, ``agree`` is that number.
    """
    enough = -(-percent * sizes // 100)
    return np.where(sizes > 0, sizes - enough + np.minimum(agree, enough), 0)


def cut(values: np.ndarray, sizes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The first ``lengths`` values of each row."""
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(values)) - np.repeat(starts, sizes)
    return values[place < np.repeat(lengths, sizes)]


def lists(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _sums(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Sums by row modulo 2**64; rows are in order."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    ends = np.searchsorted(row, np.arange(rows + 1))
    return total[ends[1:]] - total[ends[:-1]]


def frequency_levels(docs: DataFrame, text: str, words: int) -> np.ndarray:
    """How frequent the tokens of each sketch bucket are, as 0 to 255, from all texts.

    Each partition sends its bucket counts as 16 packed slices, and the driver sees the summed
    sketch of 2**20 counts. The levels only order the tokens: tokens that share a bucket with a
    frequent one come later in the order, which costs nothing but a little selectivity.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for block in tb.blocks(batch.column(0), BYTES):
                hashes, _ = shingles(block, words)
                seen += np.bincount((hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(seen))
        yield packed(dict(enumerate(seen.reshape(SLICES, -1))))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = np.frombuffer(zlib.decompress(counts), np.int64)
                seen[number] = seen[number] + counts if number in seen else counts
        yield packed(seen)

    def packed(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
        data = [zlib.compress(x.tobytes(), 1) for x in parts.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array(data, pa.binary())], ["slice", "counts"])

    kind = "slice int, counts binary"
    summed = docs.select(text).mapInArrow(count, kind).repartition(SLICES, "slice").mapInArrow(add, kind)
    whole = np.zeros((SLICES, (1 << SKETCH_BITS) // SLICES), np.int64)
    for number, counts in summed.collect():
        whole[number] += np.frombuffer(zlib.decompress(counts), np.int64)
    whole = whole.reshape(-1)
    return np.minimum(255, 8 * np.log2(1 + whole / (whole.mean() + 8))).astype(np.uint8)


_LONGS = T.ArrayType(T.LongType())
SIGNATURE = T.StructType(
    [
        *(T.StructField(name, T.LongType()) for name in ("n", "f1", "f2", "mid")),
        T.StructField("prefix", _LONGS),
    ]
)
SETS = T.StructType(
    [
        *(T.StructField(name, T.LongType()) for name in ("n", "f1", "f2")),
        *(T.StructField(name, _LONGS) for name in ("tokens", "second", "third")),
    ]
)


def _prints(hashes: np.ndarray, row: np.ndarray, rows: int) -> list[np.ndarray]:
    return [_sums(tb.mix(hashes ^ np.uint64(salt)), row, rows).view(np.int64) for salt in PRINT_SALTS]


def signatures(words: int, percent: int, levels: np.ndarray, agree: int):
    """A function of the text: set size, two fingerprints of the set, mean level, first prefix."""

    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts: list[list[pa.Array]] = []
            for block in tb.blocks(texts, BYTES):
                hashes, row, sizes = distinct_sets(block, words, levels)
                level = levels[(hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
                mid = _sums(level * np.uint64(1000), row, block.rows).astype(np.int64) // np.maximum(1, sizes)
                lengths = prefix_sizes(sizes, percent, agree)
                columns = [sizes.astype(np.int64), *_prints(hashes, row, block.rows), mid]
                parts.append([*map(pa.array, columns), lists(cut(hashes, sizes, lengths), lengths)])
            yield _struct(parts, SIGNATURE)

    return arrow_udf(sign, SIGNATURE)


def token_sets(words: int, percent: int, levels: np.ndarray, wanted: np.ndarray):
    """A function of (id hash, text): the set and its prefixes under the other orders.

    ``wanted`` is a Bloom filter of one hash, as bits; other rows give null.
    """

    def sets(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for slots, texts in batches:
            slot = slots.to_numpy(zero_copy_only=False)
            take = (wanted[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
            parts: list[list[pa.Array]] = []
            for block in tb.blocks(texts.filter(pa.array(take)), BYTES):
                hashes, row, sizes = distinct_sets(block, words, levels)
                lengths = prefix_sizes(sizes, percent)
                others = []
                for salt in ORDER_SALTS[1:]:
                    order = by_row(ranked(hashes, levels, salt), row)
                    others.append(lists(cut(hashes[order], sizes, lengths), lengths))
                columns = [sizes.astype(np.int64), *_prints(hashes, row, block.rows)]
                parts.append([*map(pa.array, columns), lists(hashes, sizes), *others])
            found = _struct(parts, SETS)
            at = np.cumsum(take) - 1
            yield found.take(pa.array(at, mask=~take))

    return arrow_udf(sets, SETS)


def _struct(parts: list[list[pa.Array]], kind: T.StructType) -> pa.Array:
    names = kind.fieldNames()
    if not parts:
        types = [pa.list_(pa.int64()) if isinstance(f.dataType, T.ArrayType) else pa.int64() for f in kind]
        return pa.StructArray.from_arrays([pa.array([], t) for t in types], names=names)
    columns = [pa.concat_arrays([p[k] for p in parts]) for k in range(len(names))]
    return pa.StructArray.from_arrays(columns, names=names)
