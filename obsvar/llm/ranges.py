"""Running sums over a global order from per-partition totals."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsvar.session import materialise


def fresh(name: str, df: DataFrame) -> str:
    """``name``, with underscores put before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ordered_sums(
    df: DataFrame, order: Sequence[Column], sums: dict[str, str], position: str
) -> tuple[DataFrame, dict[str, int]]:
    """``df`` with exclusive running sums in the given order, and the totals.

    ``sums`` maps value columns (whole numbers, not null) to the names of their running sums;
    ``position`` gets the row's 0-based place. One range shuffle orders the rows; the read order
    breaks ties, so that equal rows do not meet in one range. The ranges are stored by a reliable
    checkpoint, since bounds sampled anew after a lost executor could differ. The driver sees one
    row of totals for each shuffle partition.
    """
    tie = fresh("_tie", df)
    ranged = df.withColumn(tie, F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange(*order, F.col(tie)).sortWithinPartitions(*order, F.col(tie))
    part = fresh("_part", df)
    stored = materialise(ranged.drop(tie).withColumn(part, F.spark_partition_id()))
    values = list(sums)
    totals = stored.groupBy(part).agg(F.count("*"), *(F.sum(v) for v in values)).orderBy(part).collect()
    offsets, running = {}, [0] * (1 + len(values))
    for number, *found in totals:
        offsets[number] = tuple(running)
        running = [a + b for a, b in zip(running, found, strict=True)]
    outs = [position, *sums.values()]
    fields = [f"`{c}` {t}" for c, t in stored.drop(part).dtypes] + [f"`{c}` bigint" for c in outs]
    with_sums = stored.mapInArrow(_running(part, values, outs, offsets), ", ".join(fields))
    return with_sums, dict(zip(["rows", *values], running, strict=True))


def _running(part: str, values: list[str], outs: list[str], offsets: dict[int, tuple[int, ...]]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if now is None:  # a partition of the checkpoint holds one range
                now = list(offsets[batch.column(part)[0].as_py()])
            sizes = [np.ones(batch.num_rows, np.int64)]
            sizes += [batch.column(v).to_numpy(zero_copy_only=False).astype(np.int64) for v in values]
            arrays = [batch.column(c) for c in batch.schema.names if c != part]
            for k, size in enumerate(sizes):
                ends = np.cumsum(size) + now[k]
                arrays.append(pa.array(ends - size))
                now[k] = int(ends[-1])
            yield pa.RecordBatch.from_arrays(arrays, [c for c in batch.schema.names if c != part] + outs)

    return run
