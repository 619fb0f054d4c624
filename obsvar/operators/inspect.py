"""What a dataset holds, whether it is usable, and whether its components fit together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsvar.model import Dataset, DatasetError


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _extent(df: DataFrame, index: str, tag: str) -> DataFrame:
    return df.agg(F.max(index).alias("top"), F.count("*").alias("n")).select(
        F.lit(tag).alias("tag"), F.col("top").cast("bigint").alias("top"), "n"
    )


def measures(ds: Dataset) -> DataFrame:
    """One row of axis sizes: table row counts, cell counts and the largest index of each axis.

    Each component contributes one aggregated row; the rows meet in a single tiny aggregation.
    """
    frames = []
    for df, index, tag in (
        (ds.obs, "obs_idx", "obs"),
        (ds.var, "var_idx", "var"),
        (ds.raw.var if ds.raw else None, "var_idx", "raw_var"),
    ):
        if df is not None:
            frames.append(_extent(df, index, tag))
    for cells, tag in ((ds.x, "x"), (ds.raw.x if ds.raw else None, "raw_x")):
        if cells is not None:
            both = cells.agg(
                F.max("obs_idx").alias("o"), F.max("var_idx").alias("v"), F.count("*").alias("n")
            )
            rows = F.array(
                F.struct(F.lit(f"{tag}_obs").alias("tag"), F.col("o").cast("bigint").alias("top"), "n"),
                F.struct(F.lit(f"{tag}_var").alias("tag"), F.col("v").cast("bigint").alias("top"), "n"),
            )
            frames.append(both.select(F.inline(rows)))
    if not frames:
        raise DatasetError(f"dataset '{ds.path}' is not valid: it has neither obs nor var")

    def of(tag: str, field: str) -> Column:
        return F.max(F.when(F.col("tag") == tag, F.col(field)))

    declared_obs, declared_var = ds.declared_shape

    def axis(table: str, declared: int | None, cells: str) -> Column:
        return F.coalesce(of(table, "n"), F.lit(declared).cast("bigint"), of(cells, "top") + 1)

    return _union(frames).agg(
        axis("obs", declared_obs, "x_obs").alias("n_obs"),
        axis("var", declared_var, "x_var").alias("n_var"),
        axis("raw_var", None, "raw_x_var").alias("n_raw_var"),
        F.coalesce(of("x_obs", "n"), F.lit(0)).alias("n_cells"),
        of("raw_x_obs", "n").alias("n_raw_cells"),
    )


def matrix_shape(ds: Dataset) -> DataFrame:
    """``n_obs, n_var, n_cells, format``; sizes fall back to the declared shape, then the indices."""
    return measures(ds).select("n_obs", "n_var", "n_cells", F.lit(ds.x_format).alias("format"))


def _sparse(fmt: str) -> bool:
    return fmt != "dense"


def table_names(ds: Dataset) -> list[str]:
    """Names of the usable views, in catalog order.

    Matrices need their axis tables: X and layers both of them, obsm and obsp obs, varm and varp var.
    """
    # The names of views and their prefixes, in catalog order.
    names = [n for n, df in (("obs", ds.obs), ("var", ds.var)) if df is not None] + ["info"]
    both = ds.obs is not None and ds.var is not None
    if both and ds.x is not None:
        names.append("X")
    for kind, usable in (
        ("obsm", ds.obs is not None), ("varm", ds.var is not None), ("layers", both),
        ("obsp", ds.obs is not None), ("varp", ds.var is not None),
    ):
        if usable:
            names += [f"{kind}_{n}" for n in getattr(ds, kind)]
    if ds.uns is not None:
        names.append("uns")
    if ds.raw is not None:
        names += (["raw_X"] if ds.obs is not None and ds.raw.x is not None else []) + ["raw_var"]
        names += [f"raw_varm_{n}" for n in ds.raw.varm]
    return names


def _groups(ds: Dataset) -> list[str]:
    single = [("obs", ds.obs), ("var", ds.var), ("X", ds.x)]
    found = [n for n, df in single if df is not None]
    found += [k for k in ("obsm", "varm", "layers", "obsp", "varp") if getattr(ds, k)]
    return found + (["uns"] if ds.uns is not None else [])


def dataset_info(ds: Dataset) -> DataFrame:
    """``(property, value)`` rows; properties that do not apply are left out."""
    validate(ds)
    as_text = lambda c: F.col(c).cast("string")
    keys = lambda found: ", ".join(found) or None
    missing = F.lit("N/A")
    has_x, raw = ds.x is not None, ds.raw
    raw_x = raw is not None and raw.x is not None
    # The names of properties, in their order.
    rows: list[tuple[str, Column | str | None]] = [
        ("file_path", ds.path),
        ("n_obs", as_text("n_obs") if ds.obs is not None else missing),
        ("n_vars", as_text("n_var") if ds.var is not None else missing),
        ("x_shape", F.concat_ws(" x ", as_text("n_obs"), as_text("n_var")) if has_x else None),
        ("x_sparse", str(_sparse(ds.x_format)).lower() if has_x else None),
        ("x_format", ds.x_format if has_x and _sparse(ds.x_format) else None),
        ("obsm_keys", keys(ds.obsm) if ds.obs is not None else None),
        ("varm_keys", keys(ds.varm) if ds.var is not None else None),
        ("layers", keys(ds.layers) if ds.obs is not None and ds.var is not None else None),
        ("obsp_keys", keys(ds.obsp) if ds.obs is not None else None),
        ("varp_keys", keys(ds.varp) if ds.var is not None else None),
        ("groups", ", ".join(_groups(ds))),
        ("tables", ", ".join(n for n in table_names(ds) if not n.startswith("raw_"))),
        ("var_name_column", ds.var_name_column),
        ("var_id_column", ds.var_id_column),
        ("raw", "true" if raw is not None else None),
        ("raw_n_vars", as_text("n_raw_var") if raw is not None else None),
        ("raw_x_shape", F.concat_ws(" x ", as_text("n_obs"), as_text("n_raw_var")) if raw_x else None),
        ("raw_x_sparse", str(_sparse(raw.x_format)).lower() if raw_x else None),
        ("raw_x_format", raw.x_format if raw_x and _sparse(raw.x_format) else None),
        ("raw_varm_keys", keys(raw.varm) if raw is not None else None),
    ]
    listed = F.array(
        *[
            F.struct(
                F.lit(p).alias("property"), (F.lit(v) if isinstance(v, str) else v).alias("value")
            )
            for p, v in rows
            if v is not None
        ]
    )
    return measures(ds).select(F.inline(listed))


def component_inventory(ds: Dataset) -> DataFrame:
    """One row per component: ``component, type, shape, usable`` by the availability rules."""
    usable = set(table_names(ds))
    one, two = F.col("n").cast("string"), lambda a, b: F.concat_ws(" x ", a, b)
    width = F.coalesce(F.col("k"), F.lit(0)).cast("string")

    def add(name: str, kind: str, shape: Column, df: DataFrame, vec: bool = False) -> None:
        measured = df.agg(
            F.count("*").alias("n"),
            (F.max(F.size("vec")) if vec else F.lit(None).cast("int")).alias("k"),
        )
        frames.append(
            measured.select(
                F.lit(name).alias("component"), F.lit(kind).alias("type"), shape.alias("shape"),
                F.lit(name in usable).alias("usable"),
            )
        )

    frames: list[DataFrame] = []
    stored = F.concat(F.col("n").cast("string"), F.lit(" stored"))
    for name, df in (("obs", ds.obs), ("var", ds.var)):
        if df is not None:
            add(name, "table", one, df)
    if ds.x is not None:
        add("X", "matrix", stored, ds.x)
    for name, df in ds.layers.items():
        add(f"layers_{name}", "matrix", stored, df)
    for kind in ("obsm", "varm"):
        for name, df in getattr(ds, kind).items():
            add(f"{kind}_{name}", "dense", two(one, width), df, vec=True)
    for kind in ("obsp", "varp"):
        for name, df in getattr(ds, kind).items():
            add(f"{kind}_{name}", "pairs", stored, df)
    if ds.uns is not None:
        add("uns", "metadata", one, ds.uns)
    if ds.raw is not None:
        add("raw_var", "table", one, ds.raw.var)
        if ds.raw.x is not None:
            add("raw_X", "matrix", stored, ds.raw.x)
        for name, df in ds.raw.varm.items():
            add(f"raw_varm_{name}", "dense", two(one, width), df, vec=True)
    return _union(frames)


def validity(ds: Dataset) -> tuple[bool, str]:
    if ds.obs is None and ds.var is None:
        return False, f"dataset '{ds.path}' is not valid: it has neither obs nor var"
    return True, "ok"


def validate(ds: Dataset) -> None:
    valid, message = validity(ds)
    if not valid:
        raise DatasetError(message)


def validation_report(ds: Dataset) -> DataFrame:
    """``component, n_rows, valid, message`` for the axis tables that decide validity.

    An invalid dataset is reported and does not raise: both tables are listed, without a count.
    """
    valid, message = validity(ds)
    shown = [F.lit(valid).alias("valid"), F.lit(message).alias("message")]
    present = [(n, df) for n, df in (("obs", ds.obs), ("var", ds.var)) if df is not None]
    if not present:
        absent = F.struct(F.lit(None).cast("bigint").alias("n_rows"), *shown)
        rows = F.array(*(F.struct(F.lit(n).alias("component"), *(absent[c].alias(c) for c in ("n_rows", "valid", "message"))) for n in ("obs", "var")))
        return _session(ds).range(1).select(F.inline(rows))
    return _union([df.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("component"), "n_rows", *shown) for n, df in present])


def _session(ds: Dataset) -> SparkSession:
    """The session of whatever the dataset holds, or the running one."""
    held = [ds.x, ds.uns, *(df for kind in (ds.layers, ds.obsm, ds.varm, ds.obsp, ds.varp) for df in kind.values())]
    found = next((df.sparkSession for df in held if df is not None), None) or SparkSession.getActiveSession()
    if found is None:
        raise DatasetError("no Spark session is running")
    return found


def alignment_check(ds: Dataset) -> DataFrame:
    """Axis sizes of the tables against the matrix, and indices the tables do not have.

    One row. Distinct indices come from a per-index aggregate of cells and table together, so each
    axis is one shuffle of partial counts, whatever the skew.
    """
    obs, var, cells = ds.require_obs(), ds.require_var(), ds.require_x()

    def axis(table: DataFrame, index: str) -> DataFrame:
        seen = cells.groupBy(index).agg(F.lit(True).alias("in_cells"))
        both = (
            table.select(index, F.lit(True).alias("in_table"), F.lit(False).alias("in_cells"))
            .unionByName(seen.select(index, F.lit(False).alias("in_table"), "in_cells"))
            .groupBy(index)
            .agg(F.bool_or("in_table").alias("t"), F.bool_or("in_cells").alias("c"))
        )
        return both.agg(
            F.count_if("t").alias("n_table"),
            F.count_if("c").alias("n_matrix"),
            F.count_if(F.col("c") & ~F.col("t")).alias("n_out_of_range"),
        ).withColumn("axis", F.lit(index))

    sides = axis(obs, "obs_idx").unionByName(axis(var, "var_idx"))
    pick = lambda a, c: F.max(F.when(F.col("axis") == a, F.col(c)))
    return sides.agg(
        pick("obs_idx", "n_table").alias("n_obs_metadata"),
        pick("obs_idx", "n_matrix").alias("n_obs_matrix"),
        pick("var_idx", "n_table").alias("n_var_metadata"),
        pick("var_idx", "n_matrix").alias("n_var_matrix"),
        pick("obs_idx", "n_out_of_range").alias("n_obs_out_of_range"),
        pick("var_idx", "n_out_of_range").alias("n_var_out_of_range"),
    )
