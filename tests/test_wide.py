"""Matrices of more variables than any fixed number of columns, and collections of them."""

import pytest

from obsvar.model import Dataset, DatasetError
from obsvar.operators import collection, matrix, scans
from obsvar.plans import analysis
from obsvar.plans.registered import QUERIES
from obsvar.sources import files
from obsvar.sources.store import create_views
from tests.conftest import rows

N = 2_100


@pytest.fixture(scope="module")
def wide(spark):
    cells = [(o, (o * 701 + k * 13) % N, float(k + 1)) for o in range(4) for k in range(40)]
    x = spark.createDataFrame(cells, "obs_idx bigint, var_idx bigint, value double")
    obs = spark.createDataFrame([(o, "ab"[o % 2]) for o in range(4)], "obs_idx bigint, kind string")
    var = spark.createDataFrame([(i, f"g{i}") for i in range(N)], "var_idx bigint, _index string")
    return Dataset(obs=obs, var=var, x=x, layers={"raw": x}), {(o, v): value for o, v, value in cells}


def test_scan_and_views(spark, wide):
    ds, stored = wide
    found = scans.scan_x(ds)
    assert len(found.columns) == N + 1
    for row in found.collect():
        assert list(row[1:]) == [stored.get((row.obs_idx, v), 0.0) for v in range(N)]
    assert {"w_X", "w_layers_raw"} <= set(create_views(ds, "w"))
    picked = spark.sql("select obs_idx, g13, G2099 from w_X").collect()
    assert all(tuple(r)[1:] == (stored.get((r.obs_idx, 13), 0.0), stored.get((r.obs_idx, 2099), 0.0)) for r in picked)


def test_densify_and_analytics(wide):
    ds, stored = wide
    picks = [(i, f"g{i}") for i in range(N)]
    dense = {(o, v): x for o, v, x in rows(matrix.densify(ds.obs, ds.x, picks))}
    assert len(dense) == 4 * N and all(x == stored.get(k, 0.0) for k, x in dense.items())
    names = [n for _, n in picks]
    assert analysis.expression_by_group(ds, "kind", names).count() == 2 * N
    scores = {r.obs_idx: r.set_score for r in analysis.gene_set_score(ds, {"all": names}).collect()}
    assert scores[0] == pytest.approx(sum(x for (o, _), x in stored.items() if o == 0) / N)


def test_collections(wide):
    ds, stored = wide
    many = collection.Collection.of({"a": ds, "b": ds})
    found = collection.harmonize_x(many, "union")
    assert len(found.columns) == N + 2 and found.count() == 8
    for row in found.collect():
        assert row.g13 == stored.get((row.obs_idx, 13), 0.0)


def member(spark, names):
    cells = [(0, i, float(i + 1)) for i in range(len(names))]
    return Dataset(
        obs=spark.createDataFrame([(0, "x")], "obs_idx bigint, kind string"),
        var=spark.createDataFrame(list(enumerate(names)), "var_idx bigint, _index string"),
        x=spark.createDataFrame(cells, "obs_idx bigint, var_idx bigint, value double"),
    )


def test_names_that_differ_by_case(spark):
    many = collection.Collection.of({"human": member(spark, ["CD3D", "MS4A1"]), "mouse": member(spark, ["Cd3d", "Ms4a1", "Xist"])})
    found = collection.harmonize_x(many, "union")
    assert found.columns[2:] == ["CD3D", "MS4A1", "Cd3d_1", "Ms4a1_1", "Xist"]
    assert rows(found) == [("human", 0, 1.0, 2.0, None, None, None), ("mouse", 0, None, None, 1.0, 2.0, 3.0)]
    asked = collection.harmonize_x(many, "intersection", ["cd3d"])
    assert asked.columns[2:] == ["cd3d"] and rows(asked) == [("human", 0, 1.0), ("mouse", 0, 1.0)]
    assert rows(collection.harmonize_x(many, "union", ["XIST"])) == [("human", 0, None), ("mouse", 0, 3.0)]
    with pytest.raises(DatasetError, match="Xist.*'human'"):
        collection.harmonize_x(many, "intersection", ["Xist"])
    with pytest.raises(DatasetError, match="absent"):
        collection.harmonize_x(many, "union", ["absent"])


def test_files_that_would_be_lost(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
    table = spark.range(2).toPandas()
    table.to_parquet(tmp_path / "a/p.parquet")
    assert files.read_tables(spark, f"{tmp_path}/a/*").members == ("p.parquet",)
    table.to_parquet(tmp_path / "b/p.parquet")
    with pytest.raises(DatasetError, match="p.parquet"):
        files.read_tables(spark, f"{tmp_path}/*/*.parquet")
    table.to_parquet(tmp_path / "a/q.pq")
    with pytest.raises(DatasetError, match="q.pq"):
        files.read_tables(spark, f"{tmp_path}/a/*")
    (tmp_path / "n.csv").write_text("k,v\n1,2\nx,3\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        files.read_annotation(spark, f"{tmp_path}/n.csv", "k int, v int").collect()
    with pytest.raises(Exception, match="header|schema"):
        files.read_annotation(spark, f"{tmp_path}/n.csv", "v int, k int").collect()


def _some_cells(spark):
    obs = spark.range(5).withColumnRenamed("id", "obs_idx")
    var = spark.createDataFrame([(i, f"g{i % 9}") for i in range(10)], "var_idx bigint, _index string")
    stored = [(0, 1, 5.0), (0, 1, 4.0), (0, 9, -2.0), (1, 4, 1.0), (3, 0, 7.0), (3, 3, 8.0), (9, 0, 7.0)]
    return Dataset(obs=obs, var=var, x=spark.createDataFrame(stored, "obs_idx bigint, var_idx bigint, value double"))


def test_sparse_vectors_hold_what_dense_ones_do(spark):
    ds = _some_cells(spark)
    dense = dict(rows(scans.scan_x_vector(ds)))
    for o, size, indices, values in rows(scans.scan_x_sparse(ds)):
        assert indices == sorted(indices)
        stored = dict(zip(indices, values, strict=True))
        assert [stored.get(i, 0.0) for i in range(size)] == dense.pop(o)
    assert not dense
    outside = Dataset(obs=ds.obs, var=ds.var, x=spark.createDataFrame([(0, 10, 1.0)], ds.x.schema))
    with pytest.raises(Exception, match="outside the 10 variables"):
        scans.scan_x_sparse(outside).select("size").collect()


def test_blocks_hold_what_the_wide_view_does(spark):
    ds = _some_cells(spark)
    wide = scans.scan_x(ds)
    labels, blocks = scans.scan_x_blocks(ds, width=4)
    assert blocks.columns == ["obs_idx", "block", "c0", "c1", "c2", "c3"]
    names = {(b, k): name for b, k, _, name in rows(labels)}
    assert [names[divmod(i, 4)] for i in range(10)] == wide.columns[1:]
    held = {(o, b): c for o, b, *c in rows(blocks)}
    assert {o for o, b in held if b == 0} == set(range(5))
    for o, *values in rows(wide):
        shown = [x for b in range(3) for x in held.get((o, b), [0.0] * 4)][:10]
        assert shown == values
    assert held[0, 2] == [0.0, -2.0, None, None]
    outside = Dataset(obs=ds.obs, var=ds.var, x=spark.createDataFrame([(0, 10, 1.0)], ds.x.schema))
    with pytest.raises(Exception, match="outside the 10 variables"):
        scans.scan_x_blocks(outside)[1].collect()


def test_dense_queries_make_no_row_or_plan_of_all_variables(spark, tmp_path):
    """Work that grows with stored cells alone: a row of 50 million values would not fit."""
    obs = spark.range(2).withColumnRenamed("id", "obs_idx")
    var = spark.range(50_000_000).selectExpr("id as var_idx", "cast(id as string) as _index")
    x = spark.createDataFrame([(0, 49_999_999, 2.0)], "obs_idx bigint, var_idx bigint, value double")
    ds = Dataset(obs=obs, var=var, x=x)
    assert rows(scans.scan_x_sparse(ds)) == [(0, 50_000_000, [49_999_999], [2.0]), (1, 50_000_000, [], [])]
    plan = QUERIES["scan_x_wide_many"](spark, "/root/testdata/sf0.01")._jdf.queryExecution().analyzed().toString()
    assert "G000100" not in plan


def test_wide_rows_are_dealt_out_by_their_values(spark, monkeypatch):
    """As many tasks as rows times columns ask for, and cells in the shuffle, not rows of all columns."""
    ds = _some_cells(spark)
    want = rows(scans.scan_x(ds))
    monkeypatch.setattr(scans, "TASK_VALUES", 5)
    found = scans.scan_x(ds)
    assert rows(found) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(obs_idx" in plan and ", 10), REPARTITION_BY_NUM" in plan
    assert plan.index("partial_max") < plan.index("REPARTITION_BY_NUM")
