"""Collections: metadata trees, raw sections, names by case, wide presence, SQL views."""

from dataclasses import replace

import pytest
from obsvar.functions.typing import merged_type, shared_type
from obsvar.model import Dataset, DatasetError, Raw
from obsvar.operators import collection as many
from obsvar.operators import scans
from obsvar.plans import analysis
from obsvar.sources import store
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .conftest import rows
from .test_collection import sample

CELLS = "obs_idx bigint, var_idx bigint, value double"


def tree(spark, schema, *values):
    return spark.createDataFrame([(v,) for v in values], f"tree {schema}")


@pytest.fixture(scope="module")
def trees(spark):
    obs = spark.range(2).select(F.col("id").alias("obs_idx"))
    one = tree(spark, "struct<title: string, stats: struct<n: int, deep: struct<a: int>>, list: array<int>, both: int>",
               Row(title="one", stats=Row(n=1, deep=Row(a=5)), list=[1, 2], both=7))
    two = tree(spark, "struct<Title: string, stats: struct<n: double, other: boolean>, list: array<double>, both: struct<x: int>>",
               Row(Title="two", stats=Row(n=2.5, other=True), list=[0.5], both=Row(x=3)))
    return {"one": Dataset(obs=obs, uns=one), "two": Dataset(obs=obs, uns=two), "none": Dataset(obs=obs)}


def leaves(df):
    return sorted((r[0], r.key, r.dtype, r.value.scalar or ",".join(r.value.arr)) for r in df.collect())


def test_unlike_trees_are_one_scan(trees):
    found = many.harmonize_uns(many.Collection.of(trees))
    assert found.columns == ["_file_name", "key", "type", "dtype", "shape", "value"]
    assert leaves(found) == [
        ("one", "both", "string", "7"), ("one", "list", "float64", "1,2"), ("one", "stats/deep/a", "int32", "5"),
        ("one", "stats/n", "float64", "1"), ("one", "title", "string", "one"),
        ("two", "both", "string", '{"x":3}'), ("two", "list", "float64", "0.5"), ("two", "stats/n", "float64", "2.5"),
        ("two", "stats/other", "bool", "true"), ("two", "title", "string", "two"),
    ]


def test_metadata_of_all_members_and_of_none(trees):
    del_none = {k: v for k, v in trees.items() if k != "none"}
    found = many.harmonize_uns(many.Collection.of(del_none), "intersection")
    assert {r.key for r in found.collect()} == {"both", "list", "stats/n", "title"}
    assert many.harmonize_uns(many.Collection.of(trees), "intersection").count() == 0  # one member has none
    nothing = many.harmonize_uns(many.Collection.of({"none": trees["none"]}))
    assert rows(nothing) == [(scans.NO_UNS,)]


def test_leaves_and_trees_side_by_side(trees):
    listed = scans.scan_uns(trees["one"])
    col = many.Collection.of({"a": replace(trees["one"], uns=listed), "b": trees["two"]})
    found = many.harmonize_uns(col)
    assert {r[0] for r in found.collect()} == {"a", "b"} and found.count() == listed.count() + 5


def test_merged_and_shared_types():
    left, right = (T._parse_datatype_string(s) for s in ("struct<a:int,b:struct<c:string>>", "struct<A:bigint,b:struct<d:int>>"))
    assert merged_type(left, right).simpleString() == "struct<a:bigint,b:struct<c:string,d:int>>"
    assert shared_type(left, right).simpleString() == "struct<a:bigint>"
    assert shared_type(T._parse_datatype_string("struct<x:int>"), T._parse_datatype_string("struct<y:int>")) is None


def test_null_tree_has_no_leaves(spark):
    obs = spark.range(1).select(F.col("id").alias("obs_idx"))
    empty = tree(spark, "struct<a: int>", None)
    other = tree(spark, "struct<b: int>", Row(b=1))
    col = many.Collection.of({"e": Dataset(obs=obs, uns=empty), "o": Dataset(obs=obs, uns=other)})
    assert leaves(many.harmonize_uns(col)) == [("o", "b", "int32", "1")]


def by_case(spark):
    def member(name, cells):
        return Dataset(
            obs=spark.createDataFrame([(0, "t"), (1, "t"), (2, "u")], "obs_idx bigint, kind string"),
            var=spark.createDataFrame([(0, name), (1, "B")], "var_idx bigint, _index string"),
            x=spark.createDataFrame(cells, CELLS),
        )

    return many.Collection.of({"big": member("CD3D", [(0, 0, 4.0), (1, 1, 1.0)]), "small": member("Cd3d", [(0, 0, 6.0), (2, 0, 2.0)])})


def test_means_of_named_variables_that_differ_by_case(spark):
    found = analysis.cross_file_by_kind(by_case(spark), "kind", names=["cd3d"])
    assert found.columns == ["_file_name", "kind", "mean_cd3d"]
    assert rows(found) == [("big", "t", 2.0), ("big", "u", 0.0), ("small", "t", 3.0), ("small", "u", 2.0)]
    unnamed = analysis.cross_file_by_kind(by_case(spark), "kind")
    assert rows(unnamed) == [("big", "t", 0.5), ("big", "u", 0.0), ("small", "t", 0.0), ("small", "u", 0.0)]


def test_union_of_twenty_thousand_variables(spark):
    """Presence is told apart for every column, in a plan that is linear in their number."""
    n = 20_000
    var = spark.range(n).select(F.col("id").alias("var_idx"), F.concat(F.lit("g"), F.col("id").cast("string")).alias("_index"))
    obs = spark.range(2).select(F.col("id").alias("obs_idx"))
    cells = spark.createDataFrame([(0, 7, 2.0), (1, n - 1, 3.0)], CELLS)
    odd = var.filter("var_idx % 2 = 1").select(((F.col("var_idx") - 1) / 2).cast("bigint").alias("var_idx"), "_index")
    col = many.Collection.of({"all": Dataset(obs=obs, var=var, x=cells), "odd": Dataset(obs=obs, var=odd, x=cells.filter("false"))})
    slots = many.slotted(col, "union", name_column="_index")
    assert len(slots.labels) == n
    has = {r[0]: r[1] for r in many.presence_bitmaps(slots.places, n).collect()}
    bits = {f: [(w >> k) & 1 for w in words for k in range(many.WORD)][:n] for f, words in has.items()}
    assert sum(bits["all"]) == n and sum(bits["odd"]) == n // 2
    assert all(int(name[1:]) % 2 == bit for name, bit in zip(slots.labels, bits["odd"], strict=True))


def test_presence_of_seventy_variables_shows_in_the_wide_view(spark):
    n = 70
    var = spark.range(n).select(F.col("id").alias("var_idx"), F.concat(F.lit("g"), F.col("id").cast("string")).alias("_index"))
    obs = spark.range(1).select(F.col("id").alias("obs_idx"))
    cells = spark.createDataFrame([(0, 69, 2.0)], CELLS)
    col = many.Collection.of({"a": Dataset(obs=obs, var=var, x=cells), "b": Dataset(obs=obs, var=var.filter("var_idx >= 62"), x=cells)})
    found = {r[0]: r for r in many.harmonize_x(col, "union", name_column="_index").collect()}
    assert [found["a"][f"g{i}"] for i in range(n)] == [0.0] * 69 + [2.0]
    assert [found["b"][f"g{i}"] for i in range(n)] == [None] * 62 + [0.0] * 7 + [2.0]


@pytest.fixture(scope="module")
def with_raw(spark):
    def member(number, names):
        ds = sample(spark, number)
        var = spark.createDataFrame(list(enumerate(names)), "var_idx bigint, _index string")
        cells = spark.createDataFrame([(0, 0, float(number)), (1, len(names) - 1, 9.0)], CELLS)
        pcs = var.select("var_idx", F.expr(f"array_repeat(0.5D, {number + 1}) as vec"))
        return replace(ds, raw=Raw(var, cells, "csr", {"PCs": pcs}))

    return {"sample1": member(1, ["P", "Q", "R"]), "sample2": member(2, ["Q", "R", "S"])}


def check_raw(col):
    assert rows(many.harmonize_raw_var(col, "union")) == [
        ("sample1", 0, "P"), ("sample1", 1, "Q"), ("sample1", 2, "R"),
        ("sample2", 0, "Q"), ("sample2", 1, "R"), ("sample2", 2, "S"),
    ]
    wide = many.harmonize_raw_x(col, "union").filter("obs_idx < 2")
    assert wide.columns == ["_file_name", "obs_idx", "P", "Q", "R", "S"]
    assert rows(wide) == [
        ("sample1", 0, 1.0, 0.0, 0.0, None), ("sample1", 1, 0.0, 0.0, 9.0, None),
        ("sample2", 0, None, 2.0, 0.0, 0.0), ("sample2", 1, None, 0.0, 0.0, 9.0),
    ]
    assert many.harmonize_raw_varm(col, "PCs", "union").columns == ["_file_name", "var_idx", "PCs_0", "PCs_1", "PCs_2"]


def test_raw_sections_of_a_collection(spark, with_raw):
    check_raw(many.Collection.of(with_raw))
    with pytest.raises(DatasetError, match="raw_var not found in sample3"):
        many.harmonize_raw_x(many.Collection.of({**with_raw, "sample3": sample(spark, 3)}))


def test_views_over_a_stored_collection(spark, with_raw, tmp_path):
    notes = tree(spark, "struct<by: string>", Row(by="me"))
    store.save_dataset(replace(with_raw["sample1"], uns=notes), f"{tmp_path}/sample1")
    store.save_dataset(with_raw["sample2"], f"{tmp_path}/sample2")
    col = store.open_collection(spark, f"{tmp_path}/sample*")
    check_raw(col)
    made = store.create_views(col, "both", "union")
    assert {"both_obs", "both_var", "both_X", "both_X_long", "both_layers_raw", "both_obsm_X_pca", "both_raw_X", "both_uns"} <= set(made)
    assert "both_layers_only1" not in made  # one member has it
    found = spark.sql("select _file_name, count(*) from both_obs where cell_type = 'T cell' group by 1")
    assert rows(found) == [("sample1", 7), ("sample2", 7)]
    joined = spark.sql("select sum(x.Gene_C) from both_X x join both_obs o using (_file_name, obs_idx)").first()[0]
    assert joined == spark.sql("select sum(value) from both_X_long where var_name = 'Gene_C'").first()[0]
    assert rows(spark.sql("select _file_name, key, value.scalar from both_uns")) == [("sample1", "by", "me")]


def test_wide_rows_are_as_wide_as_the_choice(spark):
    """Seventy variables of indices up to a million: arrays of seventy."""
    picks = [(i * 15_000, f"g{i}") for i in range(70)]
    axis = spark.range(2).select(F.col("id").alias("obs_idx"))
    cells = spark.createDataFrame([(0, 15_000, 1.0), (1, 69 * 15_000, 2.0), (1, 7, 5.0)], CELLS)
    found = {r.obs_idx: r for r in scans.wide_cells(axis, cells, picks).collect()}
    assert found[0].g1 == 1.0 and found[1].g69 == 2.0 and sum(found[1][1:]) == 2.0
    slots = scans.in_slots(cells, [i for i, _ in picks])
    assert {r.var_idx: r.value for r in slots.collect()} == {1: 1.0, 69: 2.0}
