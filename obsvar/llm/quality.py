"""Quality rules by repetition coverage: the share of a text inside repeated n-grams and lines.

Method: rolling hashes of word n-grams of several lengths in numpy. A repeated n-gram begins with a
repeated shorter one, so each length only looks at the places that the length before left over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from obsvar.llm import textblocks as tb

#: Percent of the word characters that repeated n-grams of each length may cover.
LIMITS = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
LINE_LIMIT = 20
BASE_GRAM, BASE_PERCENT, MIN_WORDS = 8, 30, 20
SYMBOLS = b"#*$%&|<>"
COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars")
MEASURES = (*COLUMNS, *(f"dup_{n}_chars" for n in LIMITS))
TYPE = T.StructType([T.StructField(name, T.LongType()) for name in MEASURES])


def _per_row(block: tb.Block, which: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(which, weight, block.rows).astype(np.int64)


def _repeated(key: np.ndarray) -> np.ndarray:
    """Whether each key occurs more than once."""
    order = np.argsort(key, kind="stable")
    same = np.concatenate(([False], key[order][1:] == key[order][:-1], [False]))
    out = np.empty(len(key), bool)
    out[order] = same[1:] | same[:-1]
    return out


def _lines(block: tb.Block, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row: lines with a word that equal an earlier one, and the word characters in them."""
    breaks = np.flatnonzero(block.data == 10)
    start = np.union1d(block.bounds[:-1], breaks + 1)
    start = start[start < len(block.data)]
    end = np.minimum(np.append(start[1:], len(block.data)), len(block.data))
    row = np.searchsorted(block.bounds, start, "right") - 1
    end = end - (block.data[end - 1] == 10)  # the line break itself does not count
    first, last = np.searchsorted(block.start, start), np.searchsorted(block.start, end)
    full = last > first
    start, end, row, first, last = start[full], end[full], row[full], first[full], last[full]
    key = tb.mix(block.hashes(start, end) + tb.mix(row.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), bool)
    again[order[1:]] = key[order][1:] == key[order][:-1]
    size = np.concatenate(([0], np.cumsum(points[block.end] - points[block.start])))
    chars = size[last] - size[first]
    return _per_row(block, row[again]), _per_row(block, row[again], chars[again])


def _measure(block: tb.Block) -> dict[str, np.ndarray]:
    block.words(tb.SPACE)
    points = block.points()
    chars = points[block.end] - points[block.start]
    word = block.hashes(block.start, block.end)
    symbol = np.isin(block.data, np.frombuffer(SYMBOLS, np.uint8))
    out = {
        "n_words": block.counts.astype(np.int64),
        "word_chars": _per_row(block, block.row, chars),
        "n_symbols": np.diff(np.concatenate(([0], np.cumsum(symbol)))[block.bounds]),
    }
    out["n_dup_lines"], out["dup_line_chars"] = _lines(block, points)
    left = block.edge[1:][block.row] - np.arange(len(word))  # words from here to the row's end
    rolled, salt = word.copy(), tb.mix(block.row.astype(np.uint64))
    place, length = np.arange(len(word)), 1
    for n in sorted({*LIMITS, BASE_GRAM}):
        for i in range(length, n):
            rolled = tb.extend(rolled, word, i)
        length = n
        place = place[left[place] >= n]
        place = place[_repeated(tb.mix(rolled[place] + salt[place]))]
        depth = np.bincount(place, minlength=len(word) + 1) - np.bincount(place + n, minlength=len(word) + 1)
        covered = np.cumsum(depth)[:-1] > 0
        if n in LIMITS:
            out[f"dup_{n}_chars"] = _per_row(block, block.row[covered], chars[covered])
        if n == BASE_GRAM:
            out["n_repeat_words"] = _per_row(block, block.row[covered])
    return out


@arrow_udf(TYPE)
def _measures(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        parts = [_measure(block) for block in tb.blocks(texts)]
        yield pa.StructArray.from_arrays(
            [pa.array(np.concatenate([p[n] for p in parts]) if parts else [], pa.int64()) for n in MEASURES],
            names=list(MEASURES),
        )


def repetition(docs: DataFrame, text: str = "text", out: str = "repetition") -> DataFrame:
    """``docs`` with a struct ``out`` of measures and the verdicts ``base_failed`` and ``kept``.

    Every row is judged by itself, so repeated rows get equal verdicts. A null text counts as the
    empty one: no words, ``base_failed``, not kept. Other columns pass through; one already called
    ``out`` is replaced. An empty table gives an empty table.
    """
    measured = tb.small_batches(docs).withColumn(out, _measures(F.col(text)))
    m = F.col(out)
    failed = (m.n_words < MIN_WORDS) | (100 * m.n_repeat_words > BASE_PERCENT * m.n_words)
    clean = 100 * m.dup_line_chars <= LINE_LIMIT * m.word_chars
    for n, percent in LIMITS.items():
        clean &= 100 * m[f"dup_{n}_chars"] <= percent * m.word_chars
    return measured.withColumn(out, m.withField("base_failed", failed).withField("kept", ~failed & clean))
