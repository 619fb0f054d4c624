"""Analytics over annotated matrices.

Statistics over *all* cells never build the zeros. With ``k`` stored cells of mean ``m`` among ``n``
cells, the mean is ``k*m/n`` and the squared deviations are those of the stored cells plus
``m*m*k*(n-k)/n``, which stays exact where a plain sum of squares would cancel.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsvar.functions.naming import column, quoted
from obsvar.model import Dataset, DatasetError
from obsvar.operators.collection import (
    FILE, Collection, common_variables, harmonize_long, harmonize_obs, member_variables, slotted,
)
from obsvar.operators.scans import near, packed_rows, scan_obs, vector_columns
from obsvar.operators.numbering import assign_index
from obsvar.operators.variables import has_repeated_names, resolve_variables, unique_variable_names, variable_names
from obsvar.session import materialise, written


def mean_with_zeros(stored: Column, mean: Column, n: Column) -> Column:
    return F.coalesce(stored * mean, F.lit(0.0)) / n


def stddev_with_zeros(stored: Column, mean: Column, var_pop: Column, n: Column) -> Column:
    """Sample standard deviation of ``n`` cells of which ``stored`` are given by mean and variance."""
    squares = stored * var_pop + mean * mean * stored * (n - stored) / n
    return F.when(n > 1, F.sqrt(F.coalesce(squares, F.lit(0.0)) / (n - 1)))


def _labels(ds: Dataset, *columns: str) -> DataFrame:
    return ds.require_obs().select("obs_idx", *[column(c) for c in columns])


def _one(df: DataFrame, value: Column) -> Column:
    """An aggregate of ``df`` as a scalar subquery."""
    return df.select(value.alias("v")).scalar()


# --- quality ----------------------------------------------------------------------------------


def qc_cell_metrics(ds: Dataset, more_than: int = 200, fewer_than: int = 2500) -> DataFrame:
    """Per observation: expressed variables, total and mean over them; outliers left out."""
    stats = (
        ds.require_x()
        .filter("value > 0")
        .groupBy("obs_idx")
        .agg(
            F.count("*").alias("n_genes_expressed"),
            F.sum("value").alias("total_counts"),
            F.avg("value").alias("mean_expression"),
        )
        .filter((F.col("n_genes_expressed") > more_than) & (F.col("n_genes_expressed") < fewer_than))
    )
    return scan_obs(ds).join(stats, "obs_idx")


def marked_fraction(ds: Dataset, pattern: str, name_column: str | None = None) -> DataFrame:
    """Per observation: expressed variables, total, and the share of variables LIKE ``pattern``."""
    names = variable_names(ds.require_var(), name_column or ds.var_name_column)
    marked = names.select("var_idx", F.col("name").like(pattern).alias("_marked"))
    per_obs = (
        ds.require_x()
        .join(marked, "var_idx")
        .groupBy("obs_idx")
        .agg(
            F.count_if(F.col("value") > 0).alias("n_genes"),
            F.sum("value").alias("total_counts"),
            F.sum(F.when(F.col("_marked"), F.col("value"))).alias("_marked_total"),
        )
    )
    total = F.coalesce("total_counts", F.lit(0.0))
    return (
        ds.require_obs()
        .select("obs_idx")
        .join(per_obs, "obs_idx", "left")
        .select(
            "obs_idx",
            F.coalesce("n_genes", F.lit(0)).alias("n_genes"),
            total.alias("total_counts"),
            (F.coalesce("_marked_total", F.lit(0.0)) / F.nullif(total, F.lit(0.0))).alias(
                "marked_fraction"
            ),
        )
    )


def matrix_density(ds: Dataset) -> DataFrame:
    """One row: all entries, positive entries and their share in per cent."""
    n_obs, n_var = _one(ds.require_obs(), F.count("*")), _one(ds.require_var(), F.count("*"))
    positive = ds.require_x().agg(F.count_if(F.col("value") > 0).alias("nonzero_entries"))
    total = n_obs * n_var
    return positive.select(
        total.alias("total_entries"),
        "nonzero_entries",
        (F.col("nonzero_entries") * 100.0 / F.nullif(total, F.lit(0))).alias("density_pct"),
    )


# --- expression -------------------------------------------------------------------------------


def expression_by_group(
    ds: Dataset, group: str, names: Sequence[str], name_column: str | None = None
) -> DataFrame:
    """Mean and deviation of the named variables per group over all cells, zeros included.

    Every group is listed with every name, however many: the names are a table that meets the cells
    in one join, and the cells are read and aggregated once.
    """
    picks = resolve_variables(ds.require_var(), name_column or ds.var_name_column, names)
    genes = ds.var.sparkSession.createDataFrame(picks, "var_idx bigint, gene string")
    sizes = ds.require_obs().groupBy(column(group).alias("grp")).agg(F.count("*").alias("n"))
    named = json.dumps([{"var_idx": i, "gene": n} for i, n in picks])
    listed = F.from_json(F.lit(named), "array<struct<var_idx: bigint, gene: string>>")
    grid = sizes.select("grp", "n", F.inline(listed))
    cells = near(ds.require_x(), [i for i, _ in picks]).join(genes.select("var_idx"), "var_idx")
    stored = (
        cells.join(_labels(ds, group), "obs_idx")
        .groupBy(column(group).alias("grp"), "var_idx")
        .agg(
            F.count("*").alias("k"), F.avg("value").alias("m"), F.var_pop("value").alias("v")
        )
    )
    same_group = grid["grp"].eqNullSafe(stored["grp"]) & (grid["var_idx"] == stored["var_idx"])
    k, m, v, n = F.col("k"), F.col("m"), F.col("v"), F.col("n")
    return grid.join(stored, same_group, "left").select(
        grid["grp"].alias(group),
        "gene",
        mean_with_zeros(k, m, n).alias("mean_expr"),
        stddev_with_zeros(k, m, v, n).alias("std_expr"),
        n.alias("n_cells"),
    )


def expression_by_group_stored(ds: Dataset, group: str) -> DataFrame:
    """Mean, deviation and number of the stored cells per group and variable."""
    return (
        ds.require_x()
        .filter("value != 0")
        .join(_labels(ds, group), "obs_idx")
        .groupBy(column(group), "var_idx")
        .agg(
            F.avg("value").alias("mean_expr"),
            F.stddev("value").alias("std_expr"),
            F.count("*").alias("n_cells"),
        )
    )


def differential_expression(
    ds: Dataset, group: str, left: str, right: str, pseudo: float = 0.001,
    min_change: float = 1.0, limit: int = 50, name_column: str | None = None,
) -> DataFrame:
    """Variables whose mean differs most between two groups, by log10 fold change.

    One conditional aggregation over the cells of both groups, no self join. A variable stored in
    neither group has no change and cannot pass the threshold; nor can any if a group is empty.
    """
    obs = _labels(ds, group)
    in_left, in_right = column(group) == left, column(group) == right
    n_left = _one(obs, F.count_if(in_left))
    n_right = _one(obs, F.count_if(in_right))
    cells = ds.require_x().join(obs.filter(in_left | in_right), "obs_idx")
    sums = cells.groupBy("var_idx").agg(
        F.sum(F.when(in_left, F.col("value")).otherwise(0.0)).alias("l"),
        F.sum(F.when(in_right, F.col("value")).otherwise(0.0)).alias("r"),
    )
    means = sums.select(
        "var_idx", (F.col("l") / F.nullif(n_left, F.lit(0))).alias("mean_left"), (F.col("r") / F.nullif(n_right, F.lit(0))).alias("mean_right")
    )
    change = F.log10(F.col("mean_left") + pseudo) - F.log10(F.col("mean_right") + pseudo)
    top = (
        means.withColumn("log_fold_change", change)
        .filter(F.abs("log_fold_change") > min_change)
        .orderBy(F.desc("log_fold_change"), "var_idx")
        .limit(limit)
    )
    names = variable_names(ds.require_var(), name_column or ds.var_name_column)
    return top.join(names, "var_idx").select(
        "var_idx", F.col("name").alias("gene"), "mean_left", "mean_right", "log_fold_change"
    )


def cluster_markers(ds: Dataset, cluster: str, min_pct: float = 25.0) -> DataFrame:
    """Per cluster and variable: mean over all cells and per cent of cells above 0, kept above
    ``min_pct``. Pairs without a stored cell have 0 per cent, so they need no row."""
    sizes = ds.require_obs().groupBy(column(cluster)).agg(F.count("*").alias("n"))
    return (
        ds.require_x()
        .join(_labels(ds, cluster), "obs_idx")
        .groupBy(column(cluster), "var_idx")
        .agg(F.sum("value").alias("total"), F.count_if(F.col("value") > 0).alias("positive"))
        .join(sizes, cluster)
        .select(
            column(cluster),
            "var_idx",
            (F.col("total") / F.col("n")).alias("mean_expr"),
            (F.col("positive") * 100.0 / F.col("n")).alias("pct_expressed"),
        )
        .filter(F.col("pct_expressed") > min_pct)
    )


def multi_sample_stats(ds: Dataset, sample: str, batch: str, marker: str) -> DataFrame:
    """Stored-cell statistics per sample, batch and variable, on the variables flagged ``marker``."""
    chosen = ds.require_var().filter(column(marker)).select("var_idx")
    return (
        ds.require_x()
        .join(chosen, "var_idx", "left_semi")
        .join(_labels(ds, sample, batch), "obs_idx")
        .groupBy(column(sample), column(batch), "var_idx")
        .agg(
            F.avg("value").alias("mean_expression"),
            F.stddev("value").alias("std_expression"),
            F.count("*").alias("n_cells"),  # a cell is stored once per observation
        )
    )


def batch_effect(ds: Dataset, batch: str, limit: int = 20) -> DataFrame:
    """Variables whose batch means (all cells) lie furthest apart.

    Batches without a stored cell have mean 0; they enter through their number, not as rows.
    """
    sizes = ds.require_obs().groupBy(column(batch)).agg(F.count("*").alias("n"))
    n_batches = _one(sizes, F.count("*"))
    means = (
        ds.require_x()
        .join(_labels(ds, batch), "obs_idx")
        .groupBy(column(batch), "var_idx")
        .agg(F.sum("value").alias("total"))
        .join(sizes, batch)
        .select("var_idx", (F.col("total") / F.col("n")).alias("m"))
    )
    spread = means.groupBy("var_idx").agg(
        F.count("*").alias("k"), F.avg("m").alias("mean"), F.var_pop("m").alias("var"),
        F.max("m").alias("high"), F.min("m").alias("low"),
    ).withColumn("b", n_batches)
    absent = F.col("k") < F.col("b")
    high = F.when(absent, F.greatest("high", F.lit(0.0))).otherwise(F.col("high"))
    low = F.when(absent, F.least("low", F.lit(0.0))).otherwise(F.col("low"))
    return (
        spread.filter("b > 1")
        .select(
            "var_idx",
            (high - low).alias("max_batch_difference"),
            stddev_with_zeros(F.col("k"), F.col("mean"), F.col("var"), F.col("b")).alias("batch_std"),
        )
        .orderBy(F.desc("max_batch_difference"), "var_idx")
        .limit(limit)
    )


def gene_set_score(
    ds: Dataset, sets: Mapping[str, Sequence[str]] | DataFrame, name_column: str | None = None
) -> DataFrame:
    """Mean value per observation and variable set, unstored members counting as 0.

    ``sets`` maps names to variables, or is a table ``(set_name, variable)`` of any length, which
    meets the variables in a join, repeats by their suffixed names, in any case; a null variable
    declares a set without adding to it. A variable that is not there raises; an empty set has no
    mean (NULL). The cells are read once and meet the members in one join; sums per observation
    and set are packed into one row per observation, then unfolded.
    """
    var, named = ds.require_var(), name_column or ds.var_name_column
    if not isinstance(sets, DataFrame):
        rows = [(s, n) for s, members in sets.items() for n in (members or [None])]
        sets = var.sparkSession.createDataFrame(rows, "set_name string, variable string")
    names = variable_names(var, named)
    if has_repeated_names(names):
        names = unique_variable_names(names).select("var_idx", F.col("unique_name").alias("name"))
    wanted = sets.select("set_name", "variable").distinct()
    found = wanted.join(names.select("var_idx", F.lower("name").alias("_name")), F.lower("variable") == F.col("_name"), "left")
    found, _ = written(found.select("set_name", "variable", "var_idx"), "sets")
    absent = F.col("variable").isNotNull() & F.col("var_idx").isNull()
    n_absent, first, low, high = found.agg(F.count_if(absent), F.min(F.when(absent, F.col("variable"))), F.min("var_idx"), F.max("var_idx")).first()
    if n_absent:
        raise DatasetError(f"variables not found: {n_absent} of those named, first '{first}'")
    sizes = found.groupBy("set_name").agg(F.count_distinct("var_idx").alias("n"))
    labels = materialise(assign_index(sizes, ["set_name"], "set_idx"))
    n_sets = labels.count()
    members = found.filter("var_idx is not null").join(labels, "set_name").select("var_idx", "set_idx").distinct()
    cells = ds.require_x().filter(F.col("var_idx").between(low, high)) if low is not None else ds.require_x().filter("false")
    sums = cells.join(members, "var_idx").groupBy("obs_idx", F.col("set_idx").alias("var_idx")).agg(F.sum(F.col("value").cast("double")).alias("value"))
    packed = packed_rows(ds.require_obs().select("obs_idx"), sums, n_sets)
    totals = packed.select("obs_idx", F.posexplode("vec").alias("set_idx", "total"))
    score = F.when(F.col("n") > 0, F.col("total") / F.col("n")).alias("set_score")
    return totals.join(labels, "set_idx").select("obs_idx", "set_name", score)


def _per_variable(ds: Dataset, cells: DataFrame) -> DataFrame:
    n_obs = _one(ds.require_obs(), F.count("*"))
    return cells.groupBy("var_idx").agg(
        F.count_if(F.col("value") > 0).alias("n_cells"), F.sum("value").alias("_total")
    ).select("var_idx", "n_cells", (F.col("_total") / n_obs).alias("mean_counts"))


def top_features(ds: Dataset, marker: str, limit: int = 20) -> DataFrame:
    """Flagged variables with the highest mean over all observations."""
    chosen = ds.require_var().filter(column(marker)).select("var_idx")
    return (
        _per_variable(ds, ds.require_x().join(chosen, "var_idx", "left_semi"))
        .orderBy(F.desc("mean_counts"), "var_idx")
        .limit(limit)
    )


def high_expression(ds: Dataset, min_mean: float = 1.0, limit: int = 20) -> DataFrame:
    """Variables with a mean over ``min_mean``, highest first."""
    return (
        _per_variable(ds, ds.require_x())
        .filter(F.col("mean_counts") > min_mean)
        .orderBy(F.desc("mean_counts"), "var_idx")
        .limit(limit)
        .select("var_idx", "mean_counts")
    )


# --- embeddings, clusters, layers, pairs ------------------------------------------------------


def embedding_with_metadata(
    ds: Dataset, name: str, dims: Sequence[int], columns: Sequence[str]
) -> DataFrame:
    """Chosen dimensions of an embedding next to metadata columns."""
    vectors = ds.member("obsm", name).select(
        "obs_idx", *[F.get("vec", d).alias(f"{name}_{d}") for d in dims]
    )
    return _labels(ds, *columns).join(vectors, "obs_idx")


def trajectory(
    ds: Dataset, pseudotime: str, columns: Sequence[str], embeddings: Mapping[str, int]
) -> DataFrame:
    """Observations with a pseudotime, in its order, with the first dimensions of embeddings."""
    out = _labels(ds, *columns, pseudotime).filter(column(pseudotime).isNotNull())
    for name, width in embeddings.items():
        out = out.join(vector_columns(ds.member("obsm", name), ["obs_idx"], name, width), "obs_idx")
    return out.orderBy(column(pseudotime), "obs_idx")


def cluster_composition(ds: Dataset, cluster: str, kind: str) -> DataFrame:
    """Observations per cluster and kind, and their per cent of the cluster."""
    counts = ds.require_obs().groupBy(column(cluster), column(kind)).agg(F.count("*").alias("n_cells"))
    whole = F.sum("n_cells").over(Window.partitionBy(column(cluster)))
    return counts.withColumn("pct_of_cluster", F.col("n_cells") * 100.0 / whole)


def layer_compare(ds: Dataset, layers: Sequence[str]) -> DataFrame:
    """Cells stored in all the layers, one value column per layer, positive in the first."""
    frames = [
        ds.member("layers", n).select("obs_idx", "var_idx", F.col("value").alias(n)) for n in layers
    ]
    out = frames[0].filter(column(layers[0]) > 0)
    for f in frames[1:]:
        out = out.join(f, ["obs_idx", "var_idx"])
    return out


def layer_stats(ds: Dataset, layers: Sequence[str]) -> DataFrame:
    """Positive cells, their mean and maximum per layer."""
    frames = [
        ds.member("layers", n).select(F.lit(n).alias("layer"), F.col("value").cast("double").alias("value"))
        for n in layers
    ]
    both = frames[0]
    for f in frames[1:]:
        both = both.unionByName(f)
    return both.filter("value > 0").groupBy("layer").agg(
        F.count("*").alias("n_nonzero"), F.avg("value").alias("mean_value"), F.max("value").alias("max_value")
    )


def annotated_long(ds: Dataset, obs_columns: Sequence[str], var_columns: Sequence[str]) -> DataFrame:
    """Positive cells with metadata of both axes."""
    var = ds.require_var().select("var_idx", *[column(c) for c in var_columns])
    return (
        ds.require_x()
        .filter("value > 0")
        .join(_labels(ds, *obs_columns), "obs_idx")
        .join(var, "var_idx")
        .select("obs_idx", "var_idx", "value", *[column(c) for c in (*obs_columns, *var_columns)])
    )


def annotate_pairs(ds: Dataset, name: str, label: str) -> DataFrame:
    """Observation pairs with the label of both ends."""
    pairs = ds.member("obsp", name)
    out = pairs
    for end in (1, 2):
        ends = _labels(ds, label).select(
            F.col("obs_idx").alias(f"obs_idx_{end}"), column(label).alias(f"{label}_{end}")
        )
        out = out.join(ends, f"obs_idx_{end}")
    return out.select("obs_idx_1", f"{label}_1", "obs_idx_2", f"{label}_2", "value")


def pair_stats(pairs: DataFrame, axis: str = "obs_idx") -> DataFrame:
    """One row about a pair matrix: size, index range, mean, mean as a whole number, negatives."""
    mean = F.avg(F.col("value").cast("double"))
    return pairs.agg(
        F.count("*").alias("n_pairs"),
        F.min(f"{axis}_1").alias("min_idx_1"), F.max(f"{axis}_1").alias("max_idx_1"),
        F.min(f"{axis}_2").alias("min_idx_2"), F.max(f"{axis}_2").alias("max_idx_2"),
        mean.alias("avg_value"),
        F.rint(mean).cast("int").alias("avg_rounded"),  # half to even
        F.count_if(F.col("value") < 0).alias("n_negative"),
    )


def array_table(var: DataFrame, array_column: str) -> DataFrame:
    """An array-valued metadata column as a child table ``(var_idx, index, value)``."""
    return var.select("var_idx", F.posexplode(column(array_column)).alias("index", "value"))


def annotate_variables(ds: Dataset, annotation: DataFrame, key: str) -> DataFrame:
    """Variables with the columns of an outside table, NULL where it has no row."""
    return ds.require_var().join(annotation, key, "left")


# --- collections ------------------------------------------------------------------------------


def file_composition(col: Collection, kind: str) -> DataFrame:
    """Observations per member and kind."""
    return harmonize_obs(col).groupBy(FILE, column(kind)).agg(F.count("*").alias("n_cells"))


def cohort_counts(col: Collection) -> DataFrame:
    """Observations and variables per member."""
    tagged = [
        p.rows.select(FILE, F.lit(kind).alias("kind"))
        for kind in ("obs", "var")
        for p in col.component(kind)
    ]
    both = tagged[0]
    for f in tagged[1:]:
        both = both.unionByName(f)
    return both.groupBy(FILE).agg(
        F.count_if(F.col("kind") == "obs").alias("n_obs"),
        F.count_if(F.col("kind") == "var").alias("n_vars"),
    )


def cross_file_expression(col: Collection, name_column: str | None = None) -> DataFrame:
    """Mean per member of every variable all members have, zeros included."""
    variables = member_variables(col, name_column)
    kept = common_variables(col, variables).select("var_name")
    grid = variables.join(kept, "var_name", "left_semi").select(FILE, "var_name")
    sizes = harmonize_obs(col, "union").groupBy(FILE).agg(F.count("*").alias("n"))
    sums = harmonize_long(col, "intersection", name_column=name_column).groupBy(FILE, "var_name").agg(
        F.sum("value").alias("total")
    )
    return (
        grid.join(sizes, FILE)
        .join(sums, [FILE, "var_name"], "left")
        .select(FILE, "var_name", (F.coalesce("total", F.lit(0.0)) / F.col("n")).alias("mean_expr"))
    )


def cross_file_by_kind(
    col: Collection, kind: str, names: Sequence[str] | None = None, name_column: str | None = None
) -> DataFrame:
    """Mean per member and kind of the combined variables, one column each.

    Sums of the stored cells over the numbers of observations; the zeros are never built.
    """
    found = slotted(col, "intersection", names, name_column=name_column)
    obs = harmonize_obs(col).select(FILE, "obs_idx", column(kind).alias("_kind"))
    sizes = obs.groupBy(FILE, "_kind").agg(F.count("*").alias("_n"))
    sums = found.cells.join(obs, [FILE, "obs_idx"]).groupBy(FILE, "_kind", "slot").agg(F.sum("value").alias("_sum"))
    packed = sums.groupBy(FILE, "_kind").agg(F.map_from_entries(F.collect_list(F.struct("slot", "_sum"))).alias("_sums"))
    packed = packed.withColumnsRenamed({FILE: "_f", "_kind": "_k"})
    joined = sizes.join(packed, (F.col(FILE) == F.col("_f")) & F.col("_kind").eqNullSafe(F.col("_k")), "left")
    means = [
        (F.coalesce(F.col("_sums")[F.lit(k).cast("bigint")], F.lit(0.0)) / F.col("_n")).alias(f"mean_{g}")
        for k, g in enumerate(found.labels)
    ]
    return joined.select(FILE, F.col("_kind").alias(kind), *means)
