"""Distributed list ranking: the position of every element of one linked list.

Elements are first joined to runs inside blocks of neighbouring numbers, each block in one bounded
task. Of what is left, random mates are spliced out until one block holds the rest; the spliced
elements are then put back in reverse. Every step stores what the way back needs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsvar.session import discard, written

#: Elements of one block, and of the list that is finished in one task.
BLOCK = 1 << 18
_RUN = "arc bigint, next bigint, weight bigint, head bigint, offset bigint"


def _runs(rows: pa.Table) -> pa.Table:
    """Head and distance from it for every element, following links inside ``rows`` alone."""
    rows = rows.select(["arc", "next", "weight"]).sort_by("arc")
    arc, weight = (rows[c].to_numpy().astype(np.int64) for c in ("arc", "weight"))
    following = np.asarray(rows["next"].is_valid())
    after = rows["next"].fill_null(0).to_numpy().astype(np.int64)
    place = np.minimum(np.searchsorted(arc, after), max(0, len(arc) - 1))
    inside = following & (arc[place] == after)
    jump, offset = np.arange(len(arc)), np.zeros(len(arc), np.int64)
    jump[place[inside]] = np.flatnonzero(inside)
    offset[place[inside]] = weight[inside]
    while True:
        further = jump[jump]
        if np.array_equal(further, jump):
            break
        offset, jump = offset + offset[jump], further
    left = pa.array(after, mask=inside | ~following)
    return pa.table(
        [pa.array(arc), left, pa.array(weight), pa.array(arc[jump]), pa.array(offset), pa.array(~inside)],
        ["arc", "next", "weight", "head", "offset", "tail"],
    )


def _joined(elements: DataFrame, group: Column) -> DataFrame:
    return elements.withColumn("_g", group).groupBy("_g").applyInArrow(_runs, _RUN + ", tail boolean")


def _heads(runs: DataFrame) -> DataFrame:
    """The list of runs: an element for each, its length as weight."""
    ends = runs.filter("tail")
    return ends.select(F.col("head").alias("arc"), "next", (F.col("offset") + F.col("weight")).alias("weight"))


def _mates(elements: DataFrame, turn: int) -> DataFrame:
    """Elements beside the one that splices them out, if any: one of coin 1 before one of coin 0."""

    def coin(c: str) -> Column:
        return F.pmod(F.xxhash64(c, F.lit(turn)), F.lit(2))

    takers = elements.filter((coin("arc") == 1) & (coin("next") == 0))
    takers = takers.select(F.col("next").alias("arc"), F.col("arc").alias("taker"), F.col("weight").alias("step"))
    return elements.join(takers, "arc", "left")


def list_ranks(elements: DataFrame, block: int = BLOCK) -> DataFrame:
    """(arc, position) of every element of ``elements`` (arc, next): 0 for the first.

    ``arc`` are distinct whole numbers; neighbours in the list should be near in number, which
    only decides how much the first step removes. The last element's ``next`` is null. There must
    be one list (a cycle or a second list has no position). The result is read from tables in the
    shared folder. An empty table gives an empty table.
    """
    spark = elements.sparkSession
    one = elements.select("arc", "next", F.lit(1).cast("bigint").alias("weight"))
    runs, _ = written(_joined(one, F.expr(f"arc div {block}L")), "runs")
    rest, undo, turn, temporary = _heads(runs), [], 0, []
    while rest.count() > block:
        mates, path = written(_mates(rest, turn), "mates")
        undo.append(mates.filter("taker is not null"))
        temporary.append(path)
        gone = undo[-1].select(F.col("taker").alias("arc"), F.col("next").alias("then"), F.col("weight").alias("more"))
        left = mates.filter("taker is null").select("arc", "next", "weight").join(gone, "arc", "left")
        spliced = F.when(F.col("more").isNull(), F.col("next")).otherwise(F.col("then"))
        weight = F.col("weight") + F.coalesce("more", F.lit(0))
        rest, path = written(left.select("arc", spliced.alias("next"), weight.alias("weight")), "list")
        temporary.append(path)
        turn += 1
    places, path = written(_joined(rest, F.lit(0)).select("arc", F.col("offset").alias("position")), "places")
    for spliced in reversed(undo):
        temporary.append(path)
        before = places.select(F.col("arc").alias("taker"), "position")
        back = spliced.join(before, "taker").select("arc", (F.col("position") + F.col("step")).alias("position"))
        places, path = written(places.union(back), "places")
    discard(spark, *temporary)
    heads = places.select(F.col("arc").alias("head"), "position")
    return runs.join(heads, "head").select("arc", (F.col("position") + F.col("offset")).alias("position"))
