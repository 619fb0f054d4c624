"""Language identification with error-correcting output codes.

Every language has a codeword; every bit of the codewords splits the languages in two, and one
binary classifier of character n-grams predicts it. A text's margins are compared with all
codewords by a weighted logistic loss: wrong bits of some classifiers are outvoted by the others.
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

#: Hash buckets of byte n-grams (lengths 1 to ``LONGEST``) over words and the blanks between them.
BUCKETS, LONGEST = 1 << 12, 4
SMOOTHING = 0.5
#: All splits of so few languages make the code; with more, hashed splits, so many per doubling.
EXHAUSTIVE, BITS_PER_DOUBLING = 6, 12
AMBIGUOUS = 0.2
ROWS = 512
_GRAM = np.uint64(0xC2B2AE3D27D4EB4F)


def gram_counts(block: tb.Block) -> np.ndarray:
    """Rows by buckets: counts of the n-grams of letters, each word between two blanks."""
    low = tb.LOWER[block.data]
    low = np.where(tb.PUNCT[low] | ((low >= 48) & (low <= 57)), np.uint8(32), low)
    blank = low == 32
    again = blank & np.concatenate(([False], blank[:-1]))  # runs of blanks count once
    keep = np.flatnonzero(~again)
    low = low[keep].astype(np.uint64)
    row = np.searchsorted(block.bounds, keep, "right") - 1
    out = np.zeros(block.rows * BUCKETS, np.float64)
    rolled = np.zeros(len(low), np.uint64)
    for n in range(1, LONGEST + 1):
        head = len(low) - n + 1
        if head <= 0:
            break
        rolled = rolled[:head] * _GRAM + low[n - 1 :] + np.uint64(n)
        inside = row[:head] == row[n - 1 :]
        bucket = (tb.mix(rolled) >> np.uint64(52)).astype(np.int64)
        out += np.bincount((row[:head] * BUCKETS + bucket)[inside], minlength=len(out))
    return out.reshape(block.rows, BUCKETS)


def _parts(texts: pa.Array) -> Iterator[tb.Block]:
    for block in tb.blocks(texts):
        for start in range(0, block.rows, ROWS):
            bounds = block.bounds[start : start + ROWS + 1]
            yield tb.Block(block.data[bounds[0] : bounds[-1]], bounds - bounds[0], block.first + start)


def codewords(n: int) -> np.ndarray:
    """``n`` distinct codewords of +1 and -1, the same for every run."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= EXHAUSTIVE:  # every split of the languages in two, once
        splits = np.arange(1, 1 << (n - 1))
        return np.where((splits[None, :] >> np.arange(n)[:, None]) & 1, 1.0, -1.0)
    bits = BITS_PER_DOUBLING * int(np.ceil(np.log2(n)))
    best, widest = None, -1
    for seed in range(16):
        words = np.random.default_rng(seed).choice((-1.0, 1.0), (n, bits))
        words = words[:, np.abs(words.sum(axis=0)) < n]  # a bit must tell some apart
        apart = (words.shape[1] - words @ words.T) / 2
        least = np.min(apart + np.eye(n) * bits)
        if least > widest:
            best, widest = words, least
    return best


class Model:
    """Codewords, and a linear classifier of n-gram shares for each of their bits."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs, self.code = langs, codewords(len(langs))
        smooth = counts + SMOOTHING
        shares = smooth / smooth.sum(axis=1, keepdims=True)  # languages weigh the same in each side
        sides = [(self.code == s).astype(float).T for s in (1, -1)]
        both = [(side @ shares) / np.maximum(1, side.sum(axis=1, keepdims=True)) for side in sides]
        both = [np.where(side.any(axis=1, keepdims=True), b, 1.0 / counts.shape[1]) for side, b in zip(sides, both, strict=True)]
        self.weights = (np.log(both[0]) - np.log(both[1])).T.astype(np.float64) if len(langs) else np.zeros((counts.shape[1], 0))
        # a classifier weighs as much as it tells its own languages apart
        own = self.code * (shares @ self.weights)
        self.trust = np.maximum(1e-6, own.min(axis=0)) if len(langs) else np.zeros(0)
        self.trust = self.trust / max(1e-12, self.trust.sum())
        self.scale = np.maximum(1e-6, np.abs(own).mean(axis=0)) if len(langs) else np.ones(0)

    def decode(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the nearest codeword, score (0 to 1), and whether a second is about as near."""
        shares = counts / np.maximum(1, counts.sum(axis=1, keepdims=True))
        margins = (shares @ self.weights) / self.scale
        # n-grams of short texts are few: their margins are drawn towards zero
        margins *= (counts.sum(axis=1) / (counts.sum(axis=1) + 40.0))[:, None]
        loss = np.log1p(np.exp(-4.0 * np.clip(margins[:, None, :] * self.code[None], -8, 8))) @ self.trust
        likely = np.exp(-4.0 * (loss - loss.min(axis=1, keepdims=True)))
        likely /= likely.sum(axis=1, keepdims=True)
        ranked = np.sort(likely, axis=1)
        second = ranked[:, -2] if likely.shape[1] > 1 else np.zeros(len(likely))
        return loss.argmin(axis=1), ranked[:, -1], ranked[:, -1] - second < AMBIGUOUS


def fit(docs: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """Learns from all rows of ``docs`` with a language.

    N-gram counts are summed by language within each partition before they are shuffled, so a
    language of most rows is one row of counts per partition and bucket. The driver sees one row
    per language and bucket.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for block in _parts(batch.column(1)):
                counts = gram_counts(block)
                # every text speaks with the same voice, long or short
                counts = counts / np.sqrt(np.maximum(1, counts.sum(axis=1, keepdims=True)))
                here = langs[block.first : block.first + block.rows]
                for name in set(here):
                    seen[name] = seen.get(name, 0) + counts[here == name].sum(axis=0)
        for name, counts in seen.items():
            filled = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(filled), pa.string()), pa.array(filled), pa.array(np.rint(counts[filled] * 1000).astype(np.int64))],
                ["lang", "bucket", "n"],
            )

    rows = tb.small_batches(docs).filter(F.col(lang).isNotNull()).select(F.col(lang).cast("string"), text)
    found = rows.mapInArrow(count, "lang string, bucket bigint, n bigint")
    packed = (
        found.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).groupBy("lang")
        .agg(F.collect_list("bucket").alias("bucket"), F.collect_list("n").alias("n")).collect()
    )
    packed.sort(key=lambda r: r.lang.encode())
    counts = np.zeros((len(packed), BUCKETS))
    for k, row in enumerate(packed):
        counts[k, row.bucket] = np.array(row.n) / 1000
    return Model([r.lang for r in packed], counts)


def identified(docs: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with a struct ``out``: lang, score (0 to 1), ambiguous.

    Texts that are null or have no letter, and all texts if nothing was learned, are ``und`` with
    score 0 and not ambiguous. Equally near codewords go to the smallest language. Every row is
    judged by itself; a column called ``out`` is replaced.
    """
    kind = T.StructType(
        [T.StructField("number", T.IntegerType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]
    )

    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [model.decode(gram_counts(block)) for block in _parts(texts)]
            columns = [np.concatenate([f[k] for f in found]) if found else [] for k in range(3)]
            yield pa.StructArray.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.bool_())],
                names=["number", "score", "ambiguous"],
            )

    spoken = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    und = F.struct(F.lit("und").alias("lang"), F.lit(0.0).alias("score"), F.lit(False).alias("ambiguous"))
    if not model.langs:
        return docs.withColumn(out, und)
    decoded = docs.withColumn(out, arrow_udf(decode, kind)(F.col(text)))
    names = F.array(*map(F.lit, model.langs))
    d = F.col(out)
    named = F.struct(F.element_at(names, d.number + 1).alias("lang"), d.score.alias("score"), d.ambiguous.alias("ambiguous"))
    return decoded.withColumn(out, F.when(spoken, named).otherwise(und))
