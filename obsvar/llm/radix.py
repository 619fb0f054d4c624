"""Least-significant-digit radix sort over written tables.

A pass is one stable counting sort: rows are counted by (digit, block of positions), prefix sums of
these counts over all digits and blocks give every such group's first destination, and a row's
place inside its group does the rest. Blocks are bounded, so no digit, however common, is one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsvar.session import discard, written

#: Positions in a block, and the widest digit: at most rows * 2**DIGIT_BITS / BLOCK counts.
BLOCK, DIGIT_BITS = 1 << 18, 12


@dataclass(frozen=True)
class Key:
    """A column of whole numbers from 0, and the bits it needs; 64 stand for any long as unsigned."""

    column: str
    bits: int

    def digits(self, width: int) -> list[tuple[int, int]]:
        """(shift, bits) of the digits from the least significant on, of nearly equal widths."""
        if not self.bits:
            return []
        passes = -(-self.bits // width)
        each = -(-self.bits // passes)
        return [(at, min(each, self.bits - at)) for at in range(0, self.bits, each)]


def counting_pass(
    rows: DataFrame, key: str, shift: int, bits: int, position: str, block: int = BLOCK
) -> DataFrame:
    """``rows`` with ``position`` replaced by the 0-based place of a stable sort by one digit."""
    at = ["_block", "_digit"]
    digit = F.shiftrightunsigned(key, shift).bitwiseAND((1 << bits) - 1).cast("int")
    dealt = rows.withColumns({"_block": F.expr(f"{position} div {block}L"), "_digit": digit})
    counts = dealt.groupBy(*at).agg(F.count("*").alias("_n"))
    totals = counts.groupBy("_digit").agg(F.sum("_n").alias("_n"))  # at most 2**bits rows
    firsts = totals.select("_digit", (F.sum("_n").over(Window.orderBy("_digit")) - F.col("_n")).alias("_first"))
    earlier = F.sum("_n").over(Window.partitionBy("_digit").orderBy("_block")) - F.col("_n")
    offsets = counts.select(*at, earlier.alias("_earlier")).join(F.broadcast(firsts), "_digit")
    place = F.row_number().over(Window.partitionBy(*at).orderBy(position)) - 1
    moved = dealt.withColumn("_place", place).join(offsets, at)
    where = (F.col("_first") + F.col("_earlier") + F.col("_place")).cast("bigint").alias(position)
    return moved.select(*(where if c == position else F.col(c) for c in rows.columns))


def radix_sorted(
    rows: DataFrame, keys: list[Key], position: str, block: int = BLOCK, width: int = DIGIT_BITS
) -> tuple[DataFrame, str | None]:
    """``rows`` with ``position`` set to the place by ``keys`` (least significant first), and the table's path.

    ``rows`` must come from a written table and hold a distinct ``position`` for each row, which
    decides ties; its columns must not start with ``_block``, ``_digit`` or the like. Each pass is
    written in the shared folder, and the table it has read is removed; the caller discards the
    last one. Without any digit the rows come back with the positions they have.
    """
    path = None
    for key in keys:
        for shift, bits in key.digits(width):
            before = path
            rows, path = written(counting_pass(rows, key.column, shift, bits, position, block), "radix")
            if before:
                discard(rows.sparkSession, before)
    return rows, path
