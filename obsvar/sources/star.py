"""Annotated-matrix datasets over the star-schema tables, used by the registered queries.

``expression``  suppliers x parts, quantity sold; the long, sparse dataset
``panel``       orders x brands; few variables and many observations, for wide views
``sized``       suppliers x part sizes, with a raw section on the full size axis
``embedding``   vectors with labels
``by_flag``     a collection with one member per return flag, overlapping size axes and one variable for other sizes
``slices``      a collection whose members hold vectors of different widths
``metadata``    one nested metadata object per event type
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsvar.model import Components, Dataset, Raw
from obsvar.operators.collection import Collection
from obsvar.session import small_tasks

# Size axis and own metric column of each member of ``by_flag``.
FLAG_MEMBERS = {
    "A": (1, 30, "metric_alpha"),
    "N": (11, 40, "metric_beta"),
    "R": (21, 50, "metric_gamma"),
}
RAW_SIZES, MAIN_SIZES = 50, 25
# The types in the events table.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
SLICE_WIDTHS = {"slice_1": 62, "slice_2": 63, "slice_3": 64}  # the last holds whole vectors
#: The size that stands for all that are not a member's own.
REST = 99


class Tables:
    """The Parquet tables of one folder, opened on access and kept, so that each footer is read once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = small_tasks(spark), str(folder).rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table


# plans are immutable: a session makes those of a folder once and shares them between queries
per_session = lru_cache(maxsize=8)


@per_session
def tables(spark: SparkSession, folder: str) -> Tables:
    return Tables(spark, folder)


def exact_sum(amount: str) -> Column:
    """Sum of a two-decimal amount without rounding drift."""
    return F.sum(F.col(amount).cast("decimal(18,2)")).cast("double")


def lead_pairs(lines: DataFrame, item: str, axis: str) -> DataFrame:
    """Pairs of the lowest item of an order with each other item of it, and in how many orders.

    One edge per distinct (order, item) and not all pairs of an order, so a hot order stays linear.
    """
    items = lines.select("l_orderkey", item).distinct()
    lead = items.groupBy("l_orderkey").agg(F.min(item).alias("lead"))
    return (
        items.join(lead, "l_orderkey")
        .filter(F.col(item) != F.col("lead"))
        .groupBy(F.col("lead").alias(f"{axis}_1"), F.col(item).alias(f"{axis}_2"))
        .agg(F.count("*").cast("float").alias("value"))
    )


def supplier_obs(t: Tables) -> DataFrame:
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return t.supplier.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("obs_idx"),
        F.col("s_name").alias("_index"),
        F.col("n_name").alias("cell_type"),
        F.col("r_name").alias("batch"),
        F.col("s_acctbal").alias("total"),
        (F.col("s_acctbal") > 5000).alias("rich"),
    )


def part_var(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("var_idx"),
        F.format_string("G%06d", "p_partkey").alias("_index"),
        F.col("p_name").alias("label"),
        F.col("p_type").alias("kind"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("price"),
        (F.col("p_size") >= 40).alias("highly_variable"),
    )


@per_session
def expression(spark: SparkSession, folder: str) -> Dataset:
    t = tables(spark, folder)
    cell = [F.col("l_suppkey").alias("obs_idx"), F.col("l_partkey").alias("var_idx")]
    by_cell = t.lineitem.groupBy(*cell)
    x = by_cell.agg(F.sum("l_quantity").alias("value"))
    return Dataset(
        obs=supplier_obs(t),
        var=part_var(t),
        x=x,
        layers=Components(
            {
                "counts": lambda: by_cell.agg(F.count("*").cast("int").alias("value")),
                "lognorm": lambda: x.withColumn("value", F.log1p("value")),
                "price": lambda: by_cell.agg(exact_sum("l_extendedprice").alias("value")),
            }
        ),
        varm=Components(
            {
                "stats": lambda: t.part.select(
                    F.col("p_partkey").alias("var_idx"),
                    F.array(F.col("p_size").cast("double"), "p_retailprice").alias("vec"),
                )
            }
        ),
        obsp=Components({"lead": lambda: lead_pairs(t.lineitem, "l_suppkey", "obs_idx")}),
        varp=Components({"lead": lambda: lead_pairs(t.lineitem, "l_partkey", "var_idx")}),
        path=f"{t.folder}/expression",
    )


@per_session
def panel(spark: SparkSession, folder: str) -> Dataset:
    t = tables(spark, folder)
    brand_idx = (F.regexp_extract("p_brand", "[0-9]+$", 0).cast("bigint") - 1).alias("var_idx")
    by_cell = t.lineitem.join(
        t.part.select(F.col("p_partkey").alias("l_partkey"), brand_idx), "l_partkey"
    ).groupBy(F.col("l_orderkey").alias("obs_idx"), "var_idx")
    var = t.part.groupBy(brand_idx, F.col("p_brand").alias("_index")).agg(
        F.count("*").alias("n_parts"),
        F.array_sort(F.collect_set("p_size")).alias("sizes"),  # the size domain bounds the array
    )
    return Dataset(
        obs=t.orders.select(
            F.col("o_orderkey").alias("obs_idx"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("priority"),
            F.col("o_totalprice").alias("total"),
        ),
        var=var.withColumn("gene_id", F.format_string("ENSB%05d", "var_idx")),
        x=by_cell.agg(F.sum("l_quantity").alias("value")),
        layers=Components(
            {"raw_counts": lambda: by_cell.agg(F.count("*").cast("int").alias("value"))}
        ),
        path=f"{t.folder}/panel",
    )


def _own_size(low: int, high: int, rest: bool) -> tuple[Column, Column]:
    """A part's size and its variable on the axis from ``low`` to ``high``; ``rest`` keeps all other sizes as one."""
    inside = F.col("p_size").between(low, high)
    size = F.when(inside, F.col("p_size"))
    index = F.when(inside, F.col("p_size") - low)
    if rest:
        size, index = size.otherwise(REST), index.otherwise(high - low + 1)
    return size, index.cast("bigint")


def _size_var(part: DataFrame, low: int, high: int, rest: bool = False) -> DataFrame:
    size, index = _own_size(low, high, rest)
    return (
        part.groupBy(index.alias("var_idx"), size.alias("size"))
        .agg(F.count("*").alias("n_parts"), exact_sum("p_retailprice").alias("price"))
        .filter("size is not null")
        .select("var_idx", F.format_string("SIZE_%02d", "size").alias("_index"), "n_parts", "price")
    )


def _size_cells(lines: DataFrame, part: DataFrame, low: int, high: int, rest: bool = False):
    _, index = _own_size(low, high, rest)
    sizes = part.select(F.col("p_partkey").alias("l_partkey"), index.alias("var_idx")).filter("var_idx is not null")
    return lines.join(sizes, "l_partkey").groupBy(F.col("l_suppkey").alias("obs_idx"), "var_idx")


@per_session
def sized(spark: SparkSession, folder: str) -> Dataset:
    t = tables(spark, folder)
    quantity = F.sum("l_quantity").alias("value")
    raw_var = _size_var(t.part, 1, RAW_SIZES)
    profile = F.array(F.col("n_parts").cast("double"), F.col("price")).alias("vec")
    return Dataset(
        obs=supplier_obs(t),
        var=_size_var(t.part, 1, MAIN_SIZES),
        x=_size_cells(t.lineitem, t.part, 1, MAIN_SIZES).agg(quantity),
        raw=Raw(
            var=raw_var,
            x=_size_cells(t.lineitem, t.part, 1, RAW_SIZES).agg(quantity),
            varm=Components({"profile": lambda: raw_var.select("var_idx", profile)}),
        ),
        path=f"{t.folder}/sized",
    )


@per_session
def embedding(spark: SparkSession, folder: str) -> Dataset:
    t = tables(spark, folder)
    vec = t.embeddings.select(F.col("vec_id").alias("obs_idx"), F.col("embedding").alias("vec"))
    return Dataset(
        obs=t.embeddings.select(
            F.col("vec_id").alias("obs_idx"),
            F.col("label").cast("string").alias("cell_type"),
            F.get("embedding", 0).cast("double").alias("pseudotime"),
        ),
        obsm={
            "X_emb": vec,
            "X_map": vec.withColumn("vec", F.slice("vec", 2, 2)),
            "X_diff": vec.withColumn("vec", F.slice("vec", 4, 3)),
        },
        path=f"{t.folder}/embedding",
    )


def _flag_member(t: Tables, flag: str) -> Dataset:
    low, high, metric = FLAG_MEMBERS[flag]
    lines = t.lineitem.filter(F.col("l_returnflag") == flag)
    per_obs = lines.groupBy(F.col("l_suppkey").alias("obs_idx")).agg(
        F.count("*").alias("n"), exact_sum("l_discount").alias("metric")
    )
    # the members store the same columns with different types, as independent writers do
    n_lines_type = {"A": "int", "N": "bigint", "R": "double"}[flag]
    nation = F.col("s_nationkey")
    grade = {"A": nation, "N": F.concat(F.lit("n"), nation.cast("string")), "R": nation > 12}[flag]
    obs = (
        t.supplier.withColumnRenamed("s_suppkey", "obs_idx")
        .join(t.nation, nation == F.col("n_nationkey"))
        .join(per_obs, "obs_idx", "left")
        .select(
            "obs_idx",
            F.col("n_name").alias("cell_type"),
            F.lit(f"flag_{flag}").alias("sample_id"),
            F.coalesce("n", F.lit(0)).cast(n_lines_type).alias("n_lines"),
            grade.alias("grade"),
            F.coalesce("metric", F.lit(0.0)).alias(metric),
        )
    )
    by_cell = _size_cells(lines, t.part, low, high, rest=True)
    var = _size_var(t.part, low, high, rest=True)
    width = {"A": 1, "N": 2, "R": 3}[flag]
    stats = [F.col("n_parts").cast("double"), F.col("price"), F.col("var_idx").cast("double")][:width]
    return Dataset(
        obs=obs,
        var=var if flag == "A" else var.drop("price"),
        x=by_cell.agg(F.sum("l_quantity").alias("value")),
        layers=Components({"counts": lambda: by_cell.agg(F.count("*").cast("int").alias("value"))}),
        varm=Components({"stats": lambda: var.select("var_idx", F.array(*stats).alias("vec"))}),
        obsp=Components({"lead": lambda: lead_pairs(lines, "l_suppkey", "obs_idx")}),
        varp=Components({"lead": lambda: lead_pairs(lines, "l_partkey", "var_idx")}),
        path=f"flag_{flag}",
    )


@per_session
def by_flag(spark: SparkSession, folder: str) -> Collection:
    t = tables(spark, folder)
    return Collection.of({f"flag_{f}": _flag_member(t, f) for f in FLAG_MEMBERS})


@per_session
def slices(spark: SparkSession, folder: str) -> Collection:
    t = tables(spark, folder)
    obs = t.embeddings.select(F.col("vec_id").alias("obs_idx"), "label")
    return Collection.of(
        {
            name: Dataset(
                obs=obs,
                obsm={
                    "X_pca": t.embeddings.select(
                        F.col("vec_id").alias("obs_idx"), F.slice("embedding", 1, k).alias("vec")
                    )
                },
            )
            for name, k in SLICE_WIDTHS.items()
        }
    )


@per_session
def metadata(spark: SparkSession, folder: str) -> DataFrame:
    """``(dataset, tree struct)``: one nested metadata object per event type."""
    events = tables(spark, folder).events
    by_hour = ", ".join(f"count_if(hour(ts) = {h})" for h in range(24))
    by_quarter = ", ".join(
        "array(" + ", ".join(f"count_if(hour(ts) div 6 = {q} and k % 3 = {m})" for m in range(3)) + ")"
        for q in range(4)
    )
    k = F.get_json_object("props", "$.k").cast("int")
    counted = events.withColumn("k", k).groupBy(F.col("event_type").alias("dataset")).agg(
        F.count("*").alias("n"),
        (exact_sum("value") / F.count("*")).alias("mean"),
        F.max("value").alias("max"),
        F.count_distinct("user_id").alias("n_users"),
        F.max("k").alias("k_max"),
        F.expr(f"array({by_hour}) as counts"),
        F.expr(f"array({by_quarter}) as grid"),
    )
    tree = F.struct(
        F.upper("dataset").alias("title"),
        F.struct(
            "n", "mean", "max", (F.col("max") > 350).alias("spread"),
        ).alias("stats"),
        F.struct(
            F.struct("n_users", "k_max").alias("limits"), F.lit(0.1).alias("rate")
        ).alias("params"),
        F.struct(F.expr("sequence(0, 23) as hours"), "counts").alias("hist"),
        F.col("grid"),
    )
    return counted.select("dataset", tree.alias("tree"))


@per_session
def unlike_metadata(spark: SparkSession, folder: str) -> Collection:
    """A member per event type; their trees differ in branches, and in the type of one leaf."""
    t, trees = tables(spark, folder), metadata(spark, folder)
    n = F.col("tree.stats.n")

    def member(kind: str) -> Dataset:
        stats = {"click": [n.cast("int").alias("n")], "error": [n.cast("double").alias("n"), F.col("tree.stats.max").alias("max")]}
        held = {
            "click": [F.struct(*stats["click"]).alias("stats"), F.col("tree.title").alias("title")],
            "error": [F.struct(*stats["error"]).alias("stats"), F.col("tree.params").alias("params")],
            "view": [F.col("tree.hist").alias("hist"), F.struct(F.col("tree.params.rate").cast("string").alias("rate")).alias("params")],
        }.get(kind, [F.struct(n.alias("n")).alias("stats"), F.col("tree.grid").alias("grid")])
        return Dataset(obs=t.supplier.select(F.col("s_suppkey").alias("obs_idx")), uns=trees.filter(F.col("dataset") == kind).select(F.struct(*held).alias("tree")))

    return Collection.of({f"{kind}.data": member(kind) for kind in EVENT_TYPES})
