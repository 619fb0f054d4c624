"""Contiguous shards of nearly equal bytes, cut from a global prefix sum of sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsvar.llm.ranges import fresh, ordered_sums


def text_size(text: str = "text") -> Column:
    """UTF-8 bytes of the text, none for null, and one for the record's end."""
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("bigint")


def text_crc(text: str = "text") -> Column:
    return F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).cast("bigint")


def balanced_shards(df: DataFrame, size: str, order: Sequence[Column], shards: int = 16) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards - 1``) and ``slot`` (gapless from 0 in each shard).

    Rows in the global ``order`` go to the shard in which the middle of their bytes falls, if all
    bytes are cut at equal targets: shards are contiguous and differ by about one row's size. A
    group of equal rows is cut like any other stretch. Rows tied in ``order`` keep the read order.
    Sizes must be positive whole numbers; a null one counts as 1. Columns ``shard`` and ``slot``
    of the input are replaced. An empty table gives an empty table.
    """
    kept = df.drop("shard", "slot")
    weight = fresh("_weight", kept)
    before, place = fresh("_before", kept), fresh("_place", kept)
    sized = kept.withColumn(weight, F.coalesce(F.col(size), F.lit(1)).cast("bigint"))
    rows, totals = ordered_sums(sized, order, {weight: before}, place)
    total = max(1, totals[weight] or 0)
    middle = f"(2 * `{before}` + `{weight}`)"
    # quotient and remainder apart: the product of all bytes and the shards need not fit 64 bits
    cut = F.expr(f"cast(({middle} * cast({shards} as decimal(20,0))) div {2 * total} as int)")
    rows = rows.withColumn("shard", F.least(cut, F.lit(shards - 1)))
    firsts = {r[0]: r[1] for r in rows.groupBy("shard").agg(F.min(place)).collect()}  # one row a shard
    starts = F.array(*(F.lit(firsts.get(s, 0)).cast("bigint") for s in range(shards)))
    slot = F.col(place) - F.element_at(starts, F.col("shard") + 1)
    return rows.withColumn("slot", slot).drop(weight, before, place)
