import pytest
from obsvar.model import Dataset, DatasetError
from obsvar.operators import decode, inspect, scans

from .conftest import rows

CELLS = "obs_idx bigint, var_idx bigint, value double"


def axis(spark, n, name):
    return spark.range(n).withColumnRenamed("id", name)


def test_shape_falls_back_to_declared_then_indices(spark):
    x = spark.createDataFrame([(3, 7, 1.0)], CELLS)
    obs = axis(spark, 6, "obs_idx")
    shape = lambda ds: tuple(inspect.matrix_shape(ds).first())
    assert shape(Dataset(obs=obs, x=x)) == (6, 8, 1, "csr")
    assert shape(Dataset(obs=obs, x=x, declared_shape=(None, 20), x_format="csc")) == (6, 20, 1, "csc")


def test_availability_rules(spark):
    x = spark.createDataFrame([(0, 0, 1.0)], CELLS)
    vec = axis(spark, 1, "obs_idx").selectExpr("obs_idx", "array(1D) as vec")
    no_var = Dataset(obs=axis(spark, 2, "obs_idx"), x=x, layers={"l": x}, obsm={"m": vec}, varm={"v": vec})
    assert inspect.table_names(no_var) == ["obs", "info", "obsm_m"]
    usable = {r.component: r.usable for r in inspect.component_inventory(no_var).collect()}
    assert usable == {"obs": True, "X": False, "layers_l": False, "obsm_m": True, "varm_v": False}
    assert dict(rows(inspect.dataset_info(no_var)))["n_vars"] == "N/A"


def test_validity(spark):
    assert inspect.validity(Dataset(path="p")) == (
        False, "dataset 'p' is not valid: it has neither obs nor var",
    )
    message = "dataset 'p' is not valid: it has neither obs nor var"
    assert rows(inspect.validation_report(Dataset(path="p"))) == [("obs", None, False, message), ("var", None, False, message)]
    with pytest.raises(DatasetError, match="not valid"):
        inspect.validate(Dataset(path="p"))
    only_var = Dataset(var=axis(spark, 3, "var_idx"))
    assert rows(inspect.validation_report(only_var)) == [("var", 3, True, "ok")]


def test_alignment_reports_foreign_indices(spark):
    ds = Dataset(
        obs=axis(spark, 4, "obs_idx"), var=axis(spark, 3, "var_idx"),
        x=spark.createDataFrame([(0, 0, 1.0), (0, 2, 1.0), (9, 2, 1.0)], CELLS),
    )
    assert tuple(inspect.alignment_check(ds).first()) == (4, 2, 3, 2, 1, 0)


def test_categorical_golden(spark):
    data = [(i, f"type_{i}", 100 + 5 * i, float(i)) for i in range(200)] + [(200, None, None, None)]
    df = spark.createDataFrame(data, "obs_idx bigint, cell_type string, cell_size int, dose double")
    want = {"cell_type": lambda i: f"type_{i}", "cell_size": lambda i: str(100 + 5 * i),
            "dose": lambda i: f"{float(i):.6f}"}
    for name, label in want.items():
        codes, categories = decode.categorical_encode(df, "obs_idx", name)
        assert [r.code for r in categories.orderBy("label").collect()] == list(range(200))
        assert codes.filter("code = -1").count() == 1
        got = rows(decode.categorical_decode(codes, categories), "idx")
        assert got == [(i, label(i)) for i in range(200)] + [(200, None)]


def test_codes_outside_the_categories_are_null(spark):
    codes = spark.createDataFrame([(0, 1), (1, -1), (2, 5)], "idx bigint, code int")
    categories = spark.createDataFrame([(0, "a"), (1, "b")], "code int, label string")
    assert rows(decode.categorical_decode(codes, categories), "idx") == [(0, "b"), (1, None), (2, None)]


def test_record_columns(spark):
    data = [(i, (f"cell_{i}", 100 + 2 * i, 1000 + 50.5 * i, i % 2 == 0)) for i in range(50)]
    df = spark.createDataFrame(
        data, "obs_idx bigint, rec struct<_index: string, n_genes: int, total_counts: double, kept: boolean>"
    )
    flat = decode.record_flatten(df, "rec")
    assert flat.columns == ["obs_idx", "_index", "n_genes", "total_counts", "kept"]
    assert flat.filter("n_genes > 150").count() == 24
    assert flat.filter("kept").count() == 25


def test_boolean_text_and_column_order(spark):
    var = spark.createDataFrame([("g", 0, True)], "name string, var_idx bigint, highly_variable boolean")
    assert rows(scans.scan_var(Dataset(var=var), boolean_text=True)) == [(0, "g", "True")]
    assert scans.scan_var(Dataset(var=var)).columns == ["var_idx", "name", "highly_variable"]
    with pytest.raises(DatasetError, match="no obs"):
        scans.scan_obs(Dataset(var=var))


def test_packed_vectors_round_trip(spark):
    matrix = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], "obs_idx bigint, vec array<double>")
    wide = scans.vector_columns(matrix, ["obs_idx"], "m", 2)
    assert rows(scans.pack_columns(wide, "obs_idx", ["m_0", "m_1"])) == rows(matrix)
