"""Dense numbering and prefix sums without a window over the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsvar.session import materialise

BUCKET = 65_536


def bucket_of(index: str, bucket: int = BUCKET) -> Column:
    """The range of ``bucket`` consecutive indices a row falls in.

    Never NULL: a nullable key would make Spark filter one side of each join on it, and two plans
    that differ in such a filter no longer share their shuffle.
    """
    return F.expr(f"coalesce({index} div {bucket}, 0L)")


def assign_index(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """``df`` with a dense 0-based ``name`` in the order of ``order_by`` (a unique key).

    One range shuffle sorts the rows; the position inside a partition and the partition number are
    stored by a reliable checkpoint, because the sampled range bounds may differ when a lost
    executor makes Spark run the shuffle again. Offsets are one row per partition.
    """
    numbered = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    stored = materialise(numbered)
    part, local = F.shiftright("_mid", 33), F.col("_mid").bitwiseAND((1 << 33) - 1)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")
    offsets = sizes.select("_part", before.alias("_offset"))
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # one row per shuffle partition
        .select((F.col("_offset") + local).cast("bigint").alias(name), *df.columns)
    )


def running_start(df: DataFrame, index: str, size: str, out: str, bucket: int = BUCKET) -> DataFrame:
    """Exclusive prefix sum of ``size`` in the order of the dense integer ``index``.

    Rows are summed inside buckets of ``bucket`` consecutive indices, and only the bucket totals
    (rows / ``bucket`` of them) meet in one window.
    """
    rows = df.withColumn("_bucket", bucket_of(index, bucket))
    inside = Window.partitionBy("_bucket").orderBy(index)
    totals = rows.groupBy("_bucket").agg(F.sum(size).alias("_total"))
    carried = totals.select(
        "_bucket", (F.sum("_total").over(Window.orderBy("_bucket")) - F.col("_total")).alias("_carry")
    )
    return (
        rows.withColumn("_inside", F.sum(size).over(inside) - F.col(size))
        .join(carried, "_bucket")
        .select(*df.columns, (F.col("_carry") + F.col("_inside")).cast("bigint").alias(out))
    )


def rank_in_key(
    df: DataFrame, keys: Sequence[str], order: str, out: str, bucket: int = BUCKET
) -> DataFrame:
    """0-based rank of each row inside its key by the integer ``order``.

    The order axis is cut into ranges, so a key that owns a third of the rows is ranked by many
    tasks; the ranges of a key are put together by a running count over (key, range) totals.
    """
    rows = df.withColumn("_bucket", bucket_of(order, bucket))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(order)
    counts = rows.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_bucket")) - F.col("_n")
    offsets = counts.select(*keys, "_bucket", before.alias("_offset"))
    return (
        rows.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(offsets, [*keys, "_bucket"])
        .select(*df.columns, (F.col("_offset") + F.col("_rank")).cast("bigint").alias(out))
    )


def count_before(
    df: DataFrame, keys: Sequence[str], order: str, marked: Column, out: str, bucket: int = BUCKET
) -> DataFrame:
    """Rows of the same key that are ``marked`` and stand before each row by the integer ``order``.

    Of rows equal in ``order`` marked ones stand first. As in ``rank_in_key`` the order axis is cut
    into ranges, and a key's ranges are put together by their totals.
    """
    rows = df.withColumns({"_bucket": bucket_of(order, bucket), "_counted": F.coalesce(marked.cast("bigint"), F.lit(0))})
    inside = Window.partitionBy(*keys, "_bucket").orderBy(order, F.desc("_counted"))
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*keys, "_bucket").agg(F.sum("_counted").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_bucket")) - F.col("_n")
    offsets = totals.select(*keys, "_bucket", before.alias("_offset"))
    return (
        rows.withColumn("_inside", F.coalesce(F.sum("_counted").over(inside), F.lit(0)))
        .join(offsets, [*keys, "_bucket"])
        .select(*df.columns, (F.col("_offset") + F.col("_inside")).cast("bigint").alias(out))
    )
