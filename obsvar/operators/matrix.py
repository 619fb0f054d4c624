"""Conversions between coordinate, CSR, CSC, dense and long forms of a matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsvar.functions.naming import column
from obsvar.operators import blocks
from obsvar.operators.numbering import BUCKET, bucket_of
from obsvar.operators.scans import in_slots, near, packed_rows
from obsvar.session import discard, written


def to_compressed(
    cells: DataFrame, axis: DataFrame, major: str, minor: str, rows: int = blocks.ROWS, span: int = blocks.SPAN
) -> tuple[DataFrame, DataFrame]:
    """Coordinates to a compressed form: ``indptr(r, start)`` and ``entries(pos, idx, val)``.

    ``major='obs_idx'`` gives CSR, ``major='var_idx'`` CSC; ``axis`` holds every major index. For
    use inside Spark the blocked form is better: ``blocks.to_blocks``.
    """
    return blocks.positions(cells, axis, major, minor, rows, span)


def from_compressed(
    indptr: DataFrame, entries: DataFrame, major: str, minor: str, bucket: int = BUCKET
) -> DataFrame:
    """Compressed form to coordinates: row ``r`` owns positions ``start(r) .. start(r+1)-1``.

    Positions are cut into ranges of ``bucket``. A row puts one mark into every range it touches,
    at the first of its positions there, and each entry takes the row of the last mark before it.
    The entries are shuffled once, and a row that owns a third of them is spread over many ranges.
    """
    # every start is also the end of the row before it
    both_ends = F.expr(
        "inline(array(named_struct('r', r, 'start', start, 'end', null),"
        " named_struct('r', r - 1, 'start', null, 'end', start)))"
    )
    owned = (
        indptr.select(both_ends)
        .groupBy("r")
        .agg(F.max("start").alias("start"), F.max("end").alias("end"))
        .filter("end > start")
    )
    spanned = F.expr(f"sequence(start div {bucket}, (end - 1) div {bucket})")
    marks = owned.select("r", "start", F.explode(spanned).alias("_bucket"))
    idx_type, val_type = entries.schema["idx"].dataType, entries.schema["val"].dataType
    stream = marks.select(
        "_bucket",
        F.greatest("start", F.col("_bucket") * bucket).alias("pos"),
        F.lit(0).alias("_entry"),
        "r",
        F.lit(None).cast(idx_type).alias("idx"),
        F.lit(None).cast(val_type).alias("val"),
    ).unionByName(
        entries.select(
            bucket_of("pos", bucket).alias("_bucket"),
            "pos",
            F.lit(1).alias("_entry"),
            F.lit(None).cast("bigint").alias("r"),
            "idx",
            "val",
        )
    )
    order = Window.partitionBy("_bucket").orderBy("pos", "_entry")
    return (
        stream.withColumn("r", F.last("r", ignorenulls=True).over(order))
        .filter("_entry = 1")
        .select(
            F.col("r").alias(major),
            F.col("idx").cast("bigint").alias(minor),
            F.col("val").cast("double").alias("value"),
        )
    )


def compare_cells(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: cells on either side, equal cells, cells of one side only, cells that differ."""
    tagged = left.select("obs_idx", "var_idx", "value", F.lit(1).alias("_l")).unionByName(
        right.select("obs_idx", "var_idx", "value", F.lit(0).alias("_l"))
    )
    is_left = F.col("_l") == 1
    cell = tagged.groupBy("obs_idx", "var_idx").agg(
        F.max(F.when(is_left, F.col("value"))).alias("lv"),
        F.max(F.when(~is_left, F.col("value"))).alias("rv"),
    )
    both = F.col("lv").isNotNull() & F.col("rv").isNotNull()
    return cell.agg(
        F.count("*").alias("n_cells"),
        F.count_if(both & (F.col("lv") == F.col("rv"))).alias("n_equal"),
        F.count_if(~both).alias("n_one_sided"),
        F.count_if(both & (F.col("lv") != F.col("rv"))).alias("n_different"),
    )


#: Rows of a range whose cells share one fingerprint.
PRINT_ROWS = 4_096


def compare_matrices(left: DataFrame, right: DataFrame, rows: int = PRINT_ROWS) -> DataFrame:
    """``compare_cells`` for matrices that are mostly equal; cells are distinct on either side.

    Ranges of observations are compared by an order-free fingerprint of their cells (sums of two
    64-bit hashes in halves, which cannot overflow, and the count); only these sums are shuffled,
    in a job of their own. Cells meet one by one in the ranges that differ, or hold a null, alone.
    """
    sums = []
    for k in range(2):
        h = F.xxhash64(F.lit(k), "obs_idx", "var_idx", "value")
        sums += [h.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h, 32)]
    tagged = left.select("obs_idx", "var_idx", "value", F.lit(1).alias("_s")).unionByName(
        right.select("obs_idx", "var_idx", "value", F.lit(-1).alias("_s"))
    )
    prints = tagged.groupBy(bucket_of("obs_idx", rows).alias("_range")).agg(
        F.count_if(F.col("_s") == 1).alias("n"),
        F.sum("_s").alias("_n"),
        F.count_if(F.col("value").isNull()).alias("_null"),
        *(F.sum(F.col("_s") * x).alias(f"_h{k}") for k, x in enumerate(sums)),
    )
    equal = F.lit(True)
    for c in ("_n", "_null", *(f"_h{k}" for k in range(len(sums)))):
        equal = equal & (F.col(c) == 0)
    prints, path = written(prints.select("_range", "n", equal.alias("equal")), "fingerprints")
    same, other = prints.agg(F.coalesce(F.sum(F.when(F.col("equal"), F.col("n"))), F.lit(0)), F.count_if(~F.col("equal"))).first()
    if not other:
        discard(left.sparkSession, path)
        counts = [F.lit(n).cast("bigint") for n in (same, same, 0, 0)]
        names = ("n_cells", "n_equal", "n_one_sided", "n_different")
        return left.sparkSession.range(1).select(*(c.alias(n) for c, n in zip(counts, names, strict=True)))
    apart = prints.filter("not equal").select("_range")
    left, right = (
        cells.withColumn("_range", bucket_of("obs_idx", rows)).join(apart, "_range", "left_semi") for cells in (left, right)
    )
    found = compare_cells(left, right)
    return found.withColumns({c: F.col(c) + F.lit(same).cast("bigint") for c in ("n_cells", "n_equal")})


def sparse_format(indptr: DataFrame, obs: DataFrame, var: DataFrame) -> DataFrame:
    """One row: starts, observations, variables, and csr, csc or unknown by their numbers.

    A square matrix needs its format declared: either reading would fit.
    """
    counted = [
        df.select(*[F.lit(int(i == k)).alias(n) for i, n in enumerate(("n_starts", "n_obs", "n_var"))])
        for k, df in enumerate((indptr, obs, var))
    ]
    counts = counted[0].unionByName(counted[1]).unionByName(counted[2]).agg(
        *[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in ("n_starts", "n_obs", "n_var")]
    )
    starts, rows, columns = F.col("n_starts"), F.col("n_obs"), F.col("n_var")
    kind = F.when((rows != columns) & (starts == rows + 1), "csr").when((rows != columns) & (starts == columns + 1), "csc")
    return counts.withColumn("format", kind.otherwise("unknown"))


def densify(obs: DataFrame, cells: DataFrame, picks: Sequence[tuple[int, str]]) -> DataFrame:
    """``(obs_idx, var_idx, value)`` for every observation and picked variable, 0 where unstored.

    One packed row per observation, then unfolded: the zeros are never shuffled.
    """
    indices = [i for i, _ in picks]
    packed = packed_rows(obs, in_slots(near(cells, indices), indices), len(indices))
    listed = F.array(*[F.lit(i).cast("bigint") for i in indices]).cast("array<bigint>")
    unfolded = F.transform(
        listed, lambda i, k: F.struct(i.alias("var_idx"), F.get(F.col("vec"), k).alias("value"))
    )
    zero = F.lit(0).cast(cells.schema["value"].dataType)
    return packed.select("obs_idx", F.inline(unfolded)).withColumn("value", F.coalesce("value", zero))


def vectors_to_long(matrix: DataFrame, index: str = "obs_idx") -> DataFrame:
    """Dense rows to ``(index, var_idx, value)``, zeros included."""
    return matrix.select(
        index, F.posexplode("vec").alias("var_idx", "value")
    ).withColumn("var_idx", F.col("var_idx").cast("bigint"))


def nonzero(cells: DataFrame) -> DataFrame:
    """Cells without explicitly stored zeros."""
    return cells.filter(F.col("value") != 0)


def project_variables(cells: DataFrame, indices: Sequence[int]) -> DataFrame:
    """Cells of the given variables; the filter reaches the Parquet scan of stored cells."""
    return cells.filter(F.col("var_idx").isin(list(indices)))


def slice_observations(cells: DataFrame, start: int, count: int) -> DataFrame:
    """Cells of the contiguous observations ``start .. start+count-1``."""
    return cells.filter(F.col("obs_idx").between(start, start + count - 1))
