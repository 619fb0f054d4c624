"""Mixes sources to target weights with Efraimidis-Spirakis keys.

Every document draws an exponential key divided by its quality weight. Within a source documents
are taken in the order of the keys until their running size reaches the source's target; a target
beyond the source's size first takes complete epochs, and the keys choose the remaining fraction.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from obsvar.llm import textblocks as tb
from obsvar.llm.ranges import fresh, ordered_sums

LEAST_WEIGHT = 0.05
#: Sources up to this number are broadcast (some 100 bytes each); more are joined by a shuffle.
BROADCAST_SOURCES = 50_000
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


@arrow_udf(T.StructType([T.StructField("words", T.LongType()), T.StructField("weight", T.DoubleType())]))
def words_and_weight(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Number of words, and the share of letters in their bytes as the quality weight."""
    for texts in batches:
        words, weights = [np.empty(0, np.int64)], [np.empty(0)]
        for block in tb.blocks(texts):
            block.words(tb.SPACE)
            words.append(block.counts.astype(np.int64))
            letters = np.concatenate(([0], np.cumsum(_LETTER[block.data])))
            filled = np.concatenate(([0], np.cumsum(~tb.SPACE[block.data])))
            part = np.diff(letters[block.bounds]) / np.maximum(1, np.diff(filled[block.bounds]))
            weights.append(np.maximum(LEAST_WEIGHT, part))
        yield pa.StructArray.from_arrays(
            [pa.array(np.concatenate(words)), pa.array(np.concatenate(weights))], names=["words", "weight"]
        )


def _drawn(docs: DataFrame, id: str, text: str, seed: int, out: str) -> DataFrame:
    """Adds ``out``: size, key and a tie breaker; all follow from id, text and seed alone."""
    seen = F.xxhash64(F.col(id), F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")), F.lit(seed))
    even = (F.shiftrightunsigned(seen, 11).cast("double") + 0.5) / float(1 << 53)
    m = fresh("_m", docs)
    measured = tb.small_batches(docs).withColumn(m, words_and_weight(F.col(text)))
    drawn = F.struct(
        F.col(f"{m}.words").alias("size"), (-F.log(even) / F.col(f"{m}.weight")).alias("key"), seen.alias("tie")
    )
    return measured.withColumn(out, drawn).drop(m)


def source_targets(sizes: DataFrame, weights: Sequence[int], cap: int) -> tuple[DataFrame, int]:
    """Per source its weight, its running start and its target; the number of sources.

    ``sizes`` has ``source`` and ``source_size``. Sources in code point order, null last, weigh
    ``weights`` in turn and share the sum of all sizes. A target stops at ``cap`` times the
    source's size; the excess is shared anew by weight until none is above. The level of the
    others rises from round to round, and only its two sums reach the driver.
    """
    ranked, totals = ordered_sums(
        sizes, [F.col("source").asc_nulls_last()], {"source_size": "start"}, "place"
    )
    turn = F.array(*(F.lit(int(w)) for w in weights))
    ranked = ranked.withColumn("weight", F.element_at(turn, (F.col("place") % len(weights) + 1).cast("int")))
    total, full, level = totals["source_size"] or 0, F.col("source_size") * cap, 0.0
    while total:
        under = full > F.lit(level) * F.col("weight")
        stopped, share = ranked.agg(
            F.sum(F.when(~under, full).otherwise(0)), F.sum(F.when(under, F.col("weight")).otherwise(0))
        ).first()
        if not share or (total - stopped) / share <= level:
            break
        level = (total - stopped) / share
    target = F.least(full.cast("double"), F.lit(level) * F.col("weight"))
    return ranked.withColumn("target", target), totals["rows"]


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    cap: int = 3,
    split_last: bool = True,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 8,
) -> DataFrame:
    """``docs`` with a struct ``mix``: size, source_size, target, epochs, taken (words).

    A size is the number of words (null: 0). With ``split_last`` the document in which a source
    reaches its target is taken in part; else it is taken if more than half of it fits. Rows that
    repeat id and text share one key: at the end of a source they are taken in equal parts. The
    result follows from rows and seed alone, so reruns and lost executors do not change it. A null
    source is a source, and a null id is an id. An empty table gives an empty table. A column
    already called ``mix`` is replaced; any other stays, whatever its name.
    """
    docs = docs.drop("mix")
    own, at, found = (fresh(name, docs) for name in ("_mix", "_at_source", "_found"))
    drawn = _drawn(docs, id, text, seed, own)
    narrow = drawn.select(F.col(source).alias("source"), f"{own}.*")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets, n = source_targets(sizes, weights, cap)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("epochs", epochs.cast("bigint")).withColumn(
        "rest", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("bigint")
    )
    small = F.broadcast if n <= BROADCAST_SOURCES else (lambda df: df)
    lookup = targets.select(F.col("source").alias("_source"), "source_size", "target", "epochs", "rest", "start")

    order = [F.col("source").asc_nulls_last(), F.col("key"), F.col("tie")]
    placed, _ = ordered_sums(narrow, order, {"size": "before"}, "place")
    placed = placed.join(small(lookup), F.col("source").eqNullSafe(F.col("_source")))
    inside = F.col("before") - F.col("start")
    reached = placed.filter((inside < F.col("rest")) & (F.col("size") > 0))
    last = reached.groupBy("_source").agg(F.max(F.struct("key", "tie")).alias("last"))
    lasts = last.withColumnRenamed("_source", "_at")
    ends = placed.join(small(lasts), F.col("_source").eqNullSafe(F.col("_at")))
    at_end = F.struct("key", "tie") == F.col("last")
    shares = (
        ends.filter(at_end)
        .groupBy("_source", "last")
        .agg(((F.first("rest") - F.min(inside)) / F.sum("size")).alias("share"))
        .withColumnRenamed("_source", "_cut")
    )
    lookup = lookup.join(shares, F.col("_source").eqNullSafe(F.col("_cut")), "left").drop("_cut", "start")

    # what is known of a source goes to its rows as one column, whatever their own are called
    known = F.struct("source_size", "target", "epochs", "last", "share").alias(found)
    joined = drawn.join(small(lookup.select(F.col("_source").alias(at), known)), F.col(source).eqNullSafe(F.col(at)), "left")
    size, mine, last = F.col(f"{own}.size"), F.struct(f"{own}.key", f"{own}.tie"), F.col(f"{found}.last")
    share = F.least(F.lit(1.0), F.col(f"{found}.share"))
    if not split_last:
        share = F.when(share >= 0.5, 1.0).otherwise(0.0)
    more = F.when(mine < last, size).when(mine == last, F.round(size * share)).otherwise(0)
    epochs = F.col(f"{found}.epochs")
    picked = F.struct(
        size.alias("size"),
        F.col(f"{found}.source_size").alias("source_size"),
        F.col(f"{found}.target").alias("target"),
        epochs.alias("epochs"),
        (epochs * size + more.cast("bigint")).alias("taken"),
    )
    return joined.withColumn("mix", picked).select(*docs.columns, "mix")


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus itself: each row as often as the mix takes it, documents kept whole."""
    mixed = mix(docs, split_last=False, **options)
    m = F.col("mix")
    times = F.when(m.size > 0, F.floor(m.taken / m.size)).otherwise(0).cast("int")
    copy = fresh("_copy", docs)
    kept = [c for c in docs.columns if c.lower() != "mix"]
    return mixed.select(*kept, F.explode(F.array_repeat(F.lit(1), times)).alias(copy)).drop(copy)
