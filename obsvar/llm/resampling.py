"""Importance resampling towards a target distribution of hashed word n-grams.

Buckets of hashed features are counted in the raw and in the target texts; the floored log ratio is
a bucket's gain, the mean gain a text's weight, and Gumbel noise drawn from the id makes the
highest scores a sample without replacement. The scores are ranked by a distributed radix sort.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from obsvar.llm import textblocks as tb
from obsvar.llm.radix import Key, radix_sorted
from obsvar.llm.ranges import fresh
from obsvar.session import written

BUCKETS = 10_000
#: Bytes of the longest feature whose checksum is taken column by column; longer ones go one by one.
LONG = 64
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> np.uint32(1)), c >> np.uint32(1))
    return c


_CRC = _crc_table()


def crcs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each byte range, one byte of all ranges at a time."""
    size = end - start
    order = np.argsort(-size, kind="stable")
    order = order[size[order] <= LONG]
    begin, lengths = start[order], size[order]
    state = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for j in range(int(lengths[0]) if len(lengths) else 0):
        live = int(np.searchsorted(-lengths, -j, "left"))  # ranges longer than j stand first
        now = state[:live]
        state[:live] = _CRC[(now ^ data[begin[:live] + j]) & np.uint32(0xFF)] ^ (now >> np.uint32(8))
    found = np.empty(len(start), np.uint32)
    found[order] = ~state
    for k in np.flatnonzero(size > LONG):
        found[k] = zlib.crc32(data[start[k] : end[k]])
    return found


def features(block: tb.Block, runs: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every feature: runs of 1 to ``runs`` lower-cased words joined by one space."""
    block.words(tb.PUNCT)
    data, start, end = tb.LOWER[block.data], block.start, block.end
    if runs > 1:  # the words again, with one space after each
        size = end - start
        begin = np.cumsum(size + 1) - size - 1
        step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        joined = np.full(int((size + 1).sum()), 32, np.uint8)
        joined[np.repeat(begin, size) + step] = data[np.repeat(start, size) + step]
        data, start, end = joined, begin, begin + size
    rows, found = [], []
    for n in range(1, runs + 1):
        last = np.arange(n - 1, len(start))
        first = last - (n - 1)
        same = block.row[first] == block.row[last]
        rows.append(block.row[first[same]])
        found.append(crcs(data, start[first[same]], end[last[same]]) % np.uint32(buckets))
    return np.concatenate(rows), np.concatenate(found).astype(np.int64)


def bucket_counts(texts: DataFrame, text: str = "text", runs: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows; one array a task, of which only the sums reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for block in tb.blocks(batch.column(0)):
                counts += np.bincount(features(block, runs, buckets)[1], minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])

    found = tb.small_batches(texts).select(text).mapInArrow(run, "bucket bigint, n bigint")
    total = np.zeros(buckets, np.int64)
    for bucket, n in found.groupBy("bucket").agg(F.sum("n")).collect():  # at most one row a bucket
        total[bucket] = n
    return total


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed bucket shares, target to raw, rounded down."""
    b, s, t = len(raw), float(raw.sum()), float(target.sum())
    ratio = (target + 1.0) * (s + b) / ((raw + 1.0) * (t + b))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigher(gain: np.ndarray, runs: int = 1) -> Callable[[Column], Column]:
    """A column function: words, features and floored mean gain of a text."""
    fields = [T.StructField(c, T.LongType()) for c in ("words", "features", "weight")]

    @arrow_udf(T.StructType(fields))
    def weigh(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = [[np.empty(0, np.int64)] for _ in fields]
            for block in tb.blocks(texts):
                row, bucket = features(block, runs, len(gain))
                order = np.argsort(row, kind="stable")
                edge = np.searchsorted(row[order], np.arange(block.rows + 1))
                n = np.diff(edge)
                sums = np.diff(np.concatenate(([0], np.cumsum(gain[bucket[order]])))[edge])
                out[0].append(block.counts.astype(np.int64))
                out[1].append(n)
                out[2].append(sums // np.maximum(1, n))
            arrays = [pa.array(np.concatenate(c)) for c in out]
            yield pa.StructArray.from_arrays(arrays, names=[f.name for f in fields])

    return weigh


def noise(id: str, seed: int) -> Column:
    """Thousandths of Gumbel noise that follows from the id alone; a null id counts as empty text."""
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(said.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    min_words: int = 20,
    runs: int = 1,
    buckets: int = BUCKETS,
    seed: int = 2024,
    id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    **sort: int,
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every row of ``docs``.

    Of the rows with at least ``min_words`` words, ``percent`` in a hundred (rounded down) with the
    highest scores are drawn: rank 1 is the highest, others have none. Ties go to the smaller id, a
    null id last; rows that share id and score are ranked in the order they were read. Ids are
    whole numbers (else TypeError). A null text has no word. An empty ``docs`` gives an empty
    table, an empty ``target`` weighs by the raw counts alone. Other columns are not read.

    Only ids and numbers are written and sorted: texts are read once to count and once to weigh.
    The first table is kept in the shared folder, as the result is read from it.
    """
    kind = docs.schema[id].dataType
    if not isinstance(kind, _WHOLE):
        raise TypeError(f"ids must be whole numbers, not {kind.simpleString()}")
    gain = gains(bucket_counts(docs, text, runs, buckets), bucket_counts(target, target_text, runs, buckets))
    weighed = tb.small_batches(docs.select(F.col(id).alias("id"), F.col(text).alias("text"))).select(
        "id", weigher(gain, runs)(F.col("text")).alias("w")
    )
    scored = weighed.select(
        "id",
        F.col("w.words").alias("n_words"),
        F.col("w.features").alias("n_features"),
        F.col("w.weight").alias("weight"),
        (F.col("w.weight") + noise("id", seed)).alias("score"),
        F.monotonically_increasing_id().alias("place"),
    )
    scored, _ = written(scored, "scores")
    able = scored.filter(F.col("n_words") >= min_words)
    n, low, high, nulls, worst, best = able.agg(
        F.count("*"), F.min("id"), F.max("id"), F.count_if(F.col("id").isNull()), F.min("score"), F.max("score")
    ).first()
    if not n:
        return _named(scored.withColumn("rank", F.lit(None).cast("bigint")), id)
    low, high = (0, 0) if low is None else (low, high)
    if high - low < 1 << 63:
        by_id, bits = F.col("id").cast("bigint") - F.lit(low).cast("bigint"), (high - low).bit_length()
    else:  # the distance of the ids has no long: their bits with the sign turned sort as unsigned
        by_id, bits = F.col("id").cast("bigint").bitwiseXOR(F.lit(-(1 << 63))), 64
    keys = [Key("by_id", bits), Key("by_null", int(bool(nulls))), Key("by_score", (best - worst).bit_length())]
    able = able.withColumns(
        {
            "by_id": F.coalesce(by_id, F.lit(0).cast("bigint")),
            "by_null": F.col("id").isNull().cast("bigint"),
            "by_score": F.lit(best).cast("bigint") - F.col("score"),
        }
    )
    if not any(k.bits for k in keys):  # equal rows only
        keys[1] = Key("by_null", 1)
    placed, _ = radix_sorted(able, keys, "place", **sort)
    drawn = F.when(F.col("place") < percent * n // 100, F.col("place") + 1)
    rest = scored.filter(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("bigint"))
    columns = ["id", "n_words", "n_features", "weight", "score", "rank"]
    return _named(placed.withColumn("rank", drawn).select(columns).union(rest.select(columns)), id)


def _named(rows: DataFrame, id: str) -> DataFrame:
    return rows.select(F.col("id").alias(id), "n_words", "n_features", "weight", "score", "rank")


def resampled(docs: DataFrame, target: DataFrame, id: str = "doc_id", **options) -> DataFrame:
    """The drawn rows of ``docs``, all their columns kept; of rows that share an id all stay if one is drawn."""
    name = fresh("_drawn", docs)
    drawn = ranked(docs, target, id=id, **options).filter("rank is not null").select(F.col(id).alias(name)).distinct()
    return docs.join(drawn, F.col(id).eqNullSafe(F.col(name)), "left_semi")
