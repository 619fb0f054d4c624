import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from obsvar.model import Dataset, DatasetError
from obsvar.operators import scans, variables

from .conftest import rows

NAMED = "var_idx bigint, name string"


def sequential(names, reserved=("obs_idx",)):
    used, out = set(reserved), []
    for name in names:
        unique, k = name, 1
        while unique.lower() in used:
            unique, k = f"{name}_{k}", k + 1
        used.add(unique.lower())
        out.append(unique)
    return out


def unique(spark, names):
    named = spark.createDataFrame(list(enumerate(names)), NAMED)
    return [r[-1] for r in rows(variables.unique_variable_names(named), "var_idx")]


@pytest.mark.parametrize(
    "names",
    [
        ["A", "B", "A", "C", "B", "A"],
        ["A", "A", "A_1", "A"],
        ["A", "A_1", "A", "A_1_1", "A_1"],
        ["a", "A", "obs_idx", "x_1", "x_2", "OBS_IDX"],
        ["A_1", "A_1", "A_1_1", "A", "A"],
        ["v_1", "v_2", "v_3"],
    ],
)
def test_unique_names_follow_the_sequential_rule(spark, names):
    assert unique(spark, names) == sequential(names)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["A", "a", "B", "A_1", "A_1_1", "B_2", "B_1", "C"]), min_size=1, max_size=14))
def test_unique_names_property(spark, names):
    assert unique(spark, names) == sequential(names)


def test_scoped_unique_names(spark):
    named = spark.createDataFrame(
        [("f", 0, "A"), ("f", 1, "A"), ("g", 0, "A"), ("g", 1, "A_1")],
        "file string, var_idx bigint, name string",
    )
    got = variables.unique_variable_names(named, ["file"])
    assert [r[-1] for r in rows(got, "file", "var_idx")] == ["A", "A_1", "A", "A_1"]


@pytest.fixture(scope="module")
def duplicated(spark):
    names = ["GENEA", "GENEB", "GENEA", "UNIQUE1", "GENEB", "GENEA"]
    return Dataset(
        obs=spark.range(4).withColumnRenamed("id", "obs_idx"),
        var=spark.createDataFrame(list(enumerate(names)), "var_idx bigint, _index string"),
        x=spark.createDataFrame(
            [(o, v, v + 1.0) for o in range(4) for v in range(6)],
            "obs_idx bigint, var_idx bigint, value double",
        ),
    )


def test_duplicate_variable_columns(duplicated):
    wide = scans.scan_x(duplicated)
    assert wide.columns == ["obs_idx", "GENEA", "GENEB", "GENEA_1", "UNIQUE1", "GENEB_1", "GENEA_2"]
    assert tuple(wide.filter("obs_idx = 0").first())[1:] == (1.0, 2.0, 3.0, 4.0, 5.0, 6.0)
    assert rows(variables.duplicate_name_audit(duplicated.var)) == [(2, 5)]


def test_chosen_duplicates_resolve_to_their_own_cells(duplicated):
    wide = scans.scan_x(duplicated, ["GENEA_2", "UNIQUE1", "GENEA"])
    assert wide.columns == ["obs_idx", "GENEA_2", "UNIQUE1", "GENEA"]
    assert tuple(wide.first())[1:] == (6.0, 4.0, 1.0)


def test_unknown_names(duplicated):
    with pytest.raises(DatasetError, match="GENEX"):
        scans.scan_x(duplicated, ["GENEX"])


def test_name_fallback(spark):
    var = spark.createDataFrame([(0, "x"), (1, None)], "var_idx bigint, symbol string")
    assert rows(variables.variable_names(var, "SYMBOL")) == [(0, "x"), (1, "var_1")]
    assert rows(variables.variable_names(var, "absent")) == [(0, "var_0"), (1, "var_1")]


def roles(spark, columns):
    n = len(next(iter(columns.values())))
    data = [(i, *[v[i] for v in columns.values()]) for i in range(n)]
    schema = "var_idx bigint, " + ", ".join(f"`{c}` string" for c in columns)
    found = variables.detect_roles(spark.createDataFrame(data, schema))
    return found["var_name_column"], found["var_id_column"]


def test_roles_by_name_come_first(spark):
    assert roles(spark, {"_index": ["a"], "gene_name": ["b"], "gene_id": ["c"]}) == ("gene_name", "gene_id")
    assert roles(spark, {"Name": ["b"], "GENE_SYMBOLS": ["c"]})[0] == "GENE_SYMBOLS"


def test_roles_by_content(spark):
    found = roles(
        spark,
        {
            "_index": ["CD4"] * 10,
            "note": ["lower text"] * 10,
            "digits": ["123"] * 10,
            "ens": [f"ENSG{i:05d}" for i in range(10)],
            "sym": ["CD3D", "HLA-A", "MS4A1", "KRAS", "GAPDH", "ACTB", "B2M", "NKG7", "x", "LYZ"],
        },
    )
    assert found == ("sym", "ens")


def test_roles_fall_back_to_the_index(spark):
    assert roles(spark, {"_index": ["a", "b"], "note": ["free text", "more text"]}) == ("_index", "_index")
