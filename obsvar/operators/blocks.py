"""Compressed matrices in blocks: one row per block, read and sliced without a shuffle.

A block covers ``ROWS`` indices of the compressed axis and ``SPAN`` of the other, so it holds a
bounded number of cells whatever the skew. Inside, ``rows`` are the non-empty major indices,
``starts`` the place of each one's first cell (one more closes the last), ``indices`` and
``values`` the cells in order: a doubly compressed form, small for very sparse matrices too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsvar.operators.numbering import running_start
from obsvar.session import written

ROWS, SPAN = 64, 16_384
TILE = ("block", "part")


def _segments(cells: DataFrame, major: str, minor: str, rows: int, span: int) -> DataFrame:
    """``(block, part, major, cells)``: the sorted cells of a row inside one block; one shuffle."""
    tiled = cells.select(
        F.expr(f"{major} div {rows}L").alias("block"), F.expr(f"{minor} div {span}L").alias("part"),
        F.col(major).alias("major"), F.struct(F.col(minor).alias("minor"), "value").alias("cell"),
    )
    # hashed on the block alone: the rows, and then the blocks, are put together where they are
    return tiled.repartition(*TILE).groupBy(*TILE, "major").agg(F.array_sort(F.collect_list("cell")).alias("cells"))


def to_blocks(cells: DataFrame, major: str, minor: str, rows: int = ROWS, span: int = SPAN) -> DataFrame:
    """Coordinates to blocks ``(block, part, rows, starts, indices, values)``.

    ``major='obs_idx'`` compresses rows (CSR), ``major='var_idx'`` columns (CSC). Empty blocks are
    not stored. A cell that is given twice is stored twice.
    """
    segments = _segments(cells, major, minor, rows, span)
    packed = segments.groupBy(*TILE).agg(F.array_sort(F.collect_list(F.struct("major", "cells"))).alias("rows"))
    sizes = F.transform("rows", lambda r: F.size(r["cells"]))
    # a block has few rows: sums of its first k sizes cost less than carrying a growing array
    starts = F.transform(
        F.sequence(F.lit(0), F.size("rows")),
        lambda k: F.aggregate(F.slice(F.col("sizes"), F.lit(1), k), F.lit(0), lambda a, n: a + n),
    )
    flat = F.flatten(F.transform("rows", lambda r: r["cells"]))
    return packed.withColumns({"sizes": sizes, "cells": flat}).select(
        *TILE,
        F.transform("rows", lambda r: r["major"]).alias("rows"),
        starts.alias("starts"),
        F.col("cells.minor").alias("indices"),
        F.col("cells.value").alias("values"),
    )


def from_blocks(blocks: DataFrame, major: str, minor: str) -> DataFrame:
    """Blocks to coordinates ``(major, minor, value double)``: a projection and two explodes, no shuffle."""
    cut = F.transform(
        "rows",
        lambda r, k: F.struct(
            r.alias("major"), F.get("starts", k).alias("first"), (F.get("starts", k + 1) - F.get("starts", k)).alias("n")
        ),
    )
    lines = blocks.select("indices", "values", F.explode(cut).alias("r"))
    both = F.arrays_zip(
        F.slice("indices", F.col("r.first") + 1, F.col("r.n")).alias("minor"),
        F.slice("values", F.col("r.first") + 1, F.col("r.n")).alias("value"),
    )
    cells = lines.select("r.major", F.inline(both).alias("minor", "value"))
    return cells.select(
        F.col("major").alias(major), F.col("minor").cast("bigint").alias(minor), F.col("value").cast("double").alias("value")
    )


def slice_blocks(blocks: DataFrame, major: str, minor: str, start: int, count: int, rows: int = ROWS) -> DataFrame:
    """Cells of the major indices ``start .. start+count-1``; only the blocks that hold them are read."""
    last = start + count - 1
    held = blocks.filter(F.col("block").between(start // rows, last // rows))
    return from_blocks(held, major, minor).filter(F.col(major).between(start, last))


def positions(
    cells: DataFrame, axis: DataFrame, major: str, minor: str, rows: int = ROWS, span: int = SPAN
) -> tuple[DataFrame, DataFrame]:
    """Coordinates to ``indptr(r, start)`` and ``entries(pos, idx, val)``.

    ``axis`` holds every major index, so empty rows get their start too; one closing row carries
    the number of entries. Cells are shuffled once and stored by row and block, as both results
    read them. Only their numbers, one for each row of a block, are summed over the whole matrix:
    inside a range of rows, and over the ranges.
    """
    segments, _ = written(_segments(cells, major, minor, rows, span), "segments")
    counts = segments.select(*TILE, "major", F.size("cells").cast("bigint").alias("n"))
    closing = axis.agg((F.max(major) + 1).alias(major)).filter(f"{major} is not null")
    heads = axis.select(major).unionByName(closing).select(
        F.expr(f"{major} div {rows}L").alias("block"), F.lit(-1).cast("bigint").alias("part"),
        F.col(major).alias("major"), F.lit(0).cast("bigint").alias("n"),
    )
    inside = Window.partitionBy("block").orderBy("major", "part")
    counted = heads.unionByName(counts).repartition("block")
    totals = counted.groupBy("block").agg(F.sum("n").alias("total"))
    begins = running_start(totals, "block", "total", "begin")
    placed = counted.withColumn("before", F.sum("n").over(inside) - F.col("n")).join(begins, "block")
    placed = placed.withColumn("base", F.col("begin") + F.col("before"))
    indptr = placed.filter("part = -1").select(F.col("major").alias("r"), F.col("base").alias("start"))
    bases = placed.filter("part >= 0").select(*TILE, "major", "base")
    entries = segments.join(bases, [*TILE, "major"]).select("base", F.posexplode("cells").alias("k", "cell"))
    entries = entries.select(
        (F.col("base") + F.col("k")).alias("pos"), F.col("cell.minor").alias("idx"), F.col("cell.value").alias("val")
    )
    return indptr, entries
