import pytest
from obsvar.model import Dataset
from obsvar.operators import scans, uns
from pyspark.sql import Row

from .conftest import rows

TREE = Row(
    dataset_name="Test Dataset", n_cells=100, score=0.123456789, flag=True, empty=None,
    pca=Row(params=Row(n_comps=50, random_state=42, use_highly_variable=True), ratio=[0.5, 0.25]),
    batch_colors=["#ff0000", "#00ff00"], batch_effects=[float(i) for i in range(10)],
    grid=[[1, 2, 3], [4, 5, 6]],
)
SCHEMA = (
    "tree struct<dataset_name: string, n_cells: bigint, score: double, flag: boolean, empty: string,"
    " pca: struct<params: struct<n_comps: int, random_state: smallint, use_highly_variable: boolean>,"
    " ratio: array<float>>, batch_colors: array<string>, batch_effects: array<double>,"
    " grid: array<array<bigint>>>"
)


@pytest.fixture(scope="module")
def nested(spark):
    return spark.createDataFrame([(TREE,)], SCHEMA)


@pytest.fixture(scope="module")
def leaves(nested):
    return uns.flatten_struct(nested, "tree")


def test_struct_leaves(leaves):
    got = {r.key: r for r in leaves.collect()}
    params = {f"pca/params/{k}" for k in ("n_comps", "random_state", "use_highly_variable")}
    assert set(got) == params | {  # "empty" is NULL and has no leaf
        "dataset_name", "n_cells", "score", "flag", "pca/ratio", "batch_colors", "batch_effects", "grid",
    }
    assert (got["dataset_name"].type, got["dataset_name"].dtype) == ("scalar", "string")
    assert (got["n_cells"].type, got["n_cells"].dtype, got["n_cells"].shape) == ("scalar", "int64", "()")
    assert (got["batch_colors"].type, got["batch_colors"].dtype) == ("array", "string")
    assert got["batch_effects"].shape == "(10)" and got["grid"].shape == "(2, 3)"
    assert got["grid"].value.arr == ["1", "2", "3", "4", "5", "6"]
    params = {k: r.value.scalar for k, r in got.items() if k.startswith("pca/params/")}
    assert params == {
        "pca/params/n_comps": "50", "pca/params/random_state": "42", "pca/params/use_highly_variable": "true",
    }
    assert got["score"].value.scalar == "0.123457"
    assert got["pca/params/random_state"].dtype == "int16" and got["pca/ratio"].dtype == "float32"


def test_json_leaves_of_unknown_shape(spark):
    texts = [
        ("a", '{"name": "x{[", "deep": {"er": {"n": 3, "f": 0.1}}, "list": [1, 2], "m": [[1.5, 2], [3, 4]]}'),
        ("b", '{"name": 7, "deep": [], "other": {"flag": false, "nothing": null}}'),
    ]
    df = spark.createDataFrame(texts, "file string, json string")
    got = {(r.file, r.key): r for r in uns.flatten_json(df, "json").collect()}
    flat = {k: (r.type, r.dtype, r.shape, r.value.scalar, r.value.arr) for k, r in got.items()}
    assert flat == {
        ("a", "name"): ("scalar", "string", "()", "x{[", None),
        ("a", "deep/er/n"): ("scalar", "int64", "()", "3", None),
        ("a", "deep/er/f"): ("scalar", "float64", "()", "0.1", None),
        ("a", "list"): ("array", "int64", "(2)", None, ["1", "2"]),
        ("a", "m"): ("array", "float64", "(2, 2)", None, ["1.5", "2", "3", "4"]),
        ("b", "name"): ("scalar", "int64", "()", "7", None),
        ("b", "deep"): ("array", "string", "(0)", None, []),
        ("b", "other/flag"): ("scalar", "bool", "()", "false", None),
    }


def test_access_and_views(leaves, nested):
    by_key = {r.key: r for r in uns.access(leaves).collect()}
    assert (by_key["batch_colors"].tag, by_key["batch_colors"].arr_len) == ("arr", 2)
    assert (by_key["dataset_name"].tag, by_key["dataset_name"].scalar) == ("scalar", "Test Dataset")
    assert rows(uns.scalars(leaves, "pca/params"), "key")[0] == ("pca/params/n_comps", "50")
    assert rows(uns.array_rows(leaves, "pca/ratio")) == [(0, "0.5"), (1, "0.25")]
    nodes = {r.path: r for r in uns.tree(leaves).collect()}
    assert nodes["pca"].node_type == "group" and nodes["pca"].shape is None
    assert nodes["pca/params/n_comps"].parent_path == "pca/params"
    assert nodes["pca/params/n_comps"].name == "n_comps"
    assert uns.subtree_json(nested, "tree", ["pca", "params"]).first().json == (
        '{"n_comps":50,"random_state":42,"use_highly_variable":true}'
    )


def test_parallel_arrays(spark):
    df = spark.createDataFrame(
        [(Row(t=Row(a=[1, 2], b=["x", "y"], c=[1])),)],
        "tree struct<t: struct<a: array<int>, b: array<string>, c: array<int>>>",
    )
    flat = uns.flatten_struct(df, "tree")
    assert rows(uns.parallel_table(flat, "t", ["a", "b"])) == [(0, "1", "x"), (1, "2", "y")]
    with pytest.raises(Exception, match="differ in length"):
        uns.parallel_table(flat, "t", ["a", "c"]).collect()


def test_no_metadata_answers_with_a_message(spark):
    ds = Dataset(obs=spark.range(1).withColumnRenamed("id", "obs_idx"))
    assert rows(scans.scan_uns(ds)) == [("No uns data in file",)]


def test_arrays_of_mixed_kinds_lose_nothing(spark):
    text = '{"a": [1.5, "x"], "b": [[1], 2], "c": [1, 2.5], "d": [[1, 2], [3]], "e": [[1, 2], [3, 4]], "f": [true, null]}'
    df = spark.createDataFrame([(text,)], "j string")
    found = {r.key: (r.dtype, r.shape, r.value.arr) for r in uns.flatten_json(df, "j").collect()}
    assert found == {
        "a": ("string", "(2)", ["1.5", "x"]),
        "b": ("string", "(2)", ["[1]", "2"]),
        "c": ("float64", "(2)", ["1", "2.5"]),
        "d": ("string", "(2)", ["[1,2]", "[3]"]),
        "e": ("int64", "(2, 2)", ["1", "2", "3", "4"]),
        "f": ("bool", "(2)", ["true", None]),
    }
