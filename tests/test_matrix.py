import random

import pytest
from obsvar.model import Dataset
from obsvar.operators import blocks, matrix, scans

from .conftest import rows

CELLS = "obs_idx bigint, var_idx bigint, value double"


def random_cells(n_obs, n_var, share, seed, hot=None):
    rng = random.Random(seed)
    return [
        (o, v, float(rng.randint(1, 9)))
        for o in range(n_obs)
        for v in range(n_var)
        if o == hot or rng.random() < share
    ]


@pytest.mark.parametrize("bucket", [3, 1000])
@pytest.mark.parametrize("major,minor", [("obs_idx", "var_idx"), ("var_idx", "obs_idx")])
def test_compressed_round_trip(spark, bucket, major, minor):
    stored = random_cells(12, 9, 0.2, seed=bucket, hot=4)  # leaves some rows and columns empty
    cells = spark.createDataFrame(stored, CELLS)
    axis = spark.range(12 if major == "obs_idx" else 9).withColumnRenamed("id", major)
    indptr, entries = matrix.to_compressed(cells, axis, major, minor, bucket, bucket + 1)

    at = 0 if major == "obs_idx" else 1
    ordered = sorted(stored, key=lambda c: (c[at], c[1 - at]))
    assert rows(entries, "pos") == [(p, c[1 - at], c[2]) for p, c in enumerate(ordered)]
    n = 12 if at == 0 else 9
    assert rows(indptr, "r") == [(r, sum(c[at] < r for c in stored)) for r in range(n + 1)]

    back = matrix.from_compressed(indptr, entries, major, minor, bucket)
    assert rows(back.select("obs_idx", "var_idx", "value")) == sorted(stored, key=repr)


@pytest.mark.parametrize("rows_,span", [(2, 3), (5, 100), (64, 16_384)])
@pytest.mark.parametrize("major,minor", [("obs_idx", "var_idx"), ("var_idx", "obs_idx")])
def test_blocks_round_trip_and_slices(spark, rows_, span, major, minor):
    stored = random_cells(23, 17, 0.15, seed=rows_, hot=4)
    cells = spark.createDataFrame(stored, CELLS).repartition(3)
    made = blocks.to_blocks(cells, major, minor, rows_, span)
    back = blocks.from_blocks(made, major, minor).select("obs_idx", "var_idx", "value")
    assert rows(back) == sorted(stored, key=repr)
    for b in made.collect():
        assert len(b.rows) + 1 == len(b.starts) <= rows_ + 1 and b.starts[-1] == len(b.indices) == len(b["values"])
        assert all(i // span == b.part for i in b.indices) and all(r // rows_ == b.block for r in b.rows)
        parts = [b.indices[a:z] for a, z in zip(b.starts, b.starts[1:])]
        assert all(p and p == sorted(p) for p in parts)
    at = 0 if major == "obs_idx" else 1
    part = blocks.slice_blocks(made, major, minor, 3, 6, rows_).select("obs_idx", "var_idx", "value")
    assert rows(part) == sorted((c for c in stored if 3 <= c[at] < 9), key=repr)


def test_an_empty_matrix_has_no_block_and_only_starts_of_rows(spark):
    cells = spark.createDataFrame([], CELLS)
    assert blocks.to_blocks(cells, "obs_idx", "var_idx").count() == 0
    axis = spark.range(3).withColumnRenamed("id", "obs_idx")
    indptr, entries = matrix.to_compressed(cells, axis, "obs_idx", "var_idx")
    assert rows(indptr, "r") == [(0, 0), (1, 0), (2, 0), (3, 0)] and entries.count() == 0


def test_a_block_is_read_without_a_shuffle(spark):
    cells = spark.createDataFrame(random_cells(10, 10, 0.5, seed=3), CELLS)
    once = blocks.from_blocks(blocks.to_blocks(cells, "obs_idx", "var_idx"), "obs_idx", "var_idx")
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("rows_", [2, 4_096])
def test_fingerprints_agree_with_single_cells(spark, rows_):
    stored = random_cells(20, 15, 0.3, seed=9)
    changed = list(stored)
    changed[7] = (*changed[7][:2], changed[7][2] + 1)
    for other in (stored, changed, stored[1:], [*stored, (19, 99, 1.0)], [(*stored[0][:2], None), *stored[1:]], []):
        left, right = (spark.createDataFrame(c, CELLS).repartition(3) for c in (stored, other))
        assert rows(matrix.compare_matrices(left, right, rows_)) == rows(matrix.compare_cells(left, right))


def test_csr_and_csc_hold_the_same_cells(spark):
    cells = spark.createDataFrame(random_cells(10, 20, 0.1, seed=1), CELLS)
    forms = []
    for major, minor, n in (("obs_idx", "var_idx", 10), ("var_idx", "obs_idx", 20)):
        axis = spark.range(n).withColumnRenamed("id", major)
        forms.append(matrix.from_compressed(*matrix.to_compressed(cells, axis, major, minor), major, minor))
    n_cells = cells.count()
    assert rows(matrix.compare_cells(*forms)) == [(n_cells, n_cells, 0, 0)]
    other = spark.createDataFrame([(0, 0, -1.0)], CELLS)
    assert matrix.compare_cells(forms[0], other).first().n_equal == 0


def test_sparse_format_needs_a_declaration_when_square(spark):
    indptr = spark.createDataFrame([(r, 0) for r in range(6)], "r bigint, start bigint")
    for n_obs, n_var, kind in ((5, 9, "csr"), (9, 5, "csc"), (5, 5, "unknown"), (3, 4, "unknown")):
        found = matrix.sparse_format(indptr, spark.range(n_obs), spark.range(n_var)).first()
        assert tuple(found) == (6, n_obs, n_var, kind)


def test_densify_fills_zeros_and_keeps_the_axis(spark):
    cells = spark.createDataFrame([(0, 1, 5.0), (2, 0, -3.0), (7, 0, 1.0)], CELLS)
    obs = spark.range(3).withColumnRenamed("id", "obs_idx")
    got = rows(matrix.densify(obs, cells, [(0, "a"), (1, "b")]), "obs_idx", "var_idx")
    assert got == [(0, 0, 0.0), (0, 1, 5.0), (1, 0, 0.0), (1, 1, 0.0), (2, 0, -3.0), (2, 1, 0.0)]


def test_vector_long_and_wide_agree(spark, monkeypatch):
    stored = random_cells(8, 6, 0.3, seed=3)
    var = spark.createDataFrame([(i, f"g{i}") for i in range(6)], "var_idx bigint, _index string")
    ds = Dataset(
        obs=spark.range(9).withColumnRenamed("id", "obs_idx"), var=var,
        x=spark.createDataFrame(stored, CELLS),
    )
    dense = {(o, v): x for o, v, x in stored}
    want = [(o, *[dense.get((o, v), 0.0) for v in range(6)]) for o in range(9)]
    assert rows(scans.scan_x(ds), "obs_idx") == want
    monkeypatch.setattr(scans, "CONDITIONAL_COLUMNS", 0)
    assert rows(scans.scan_x(ds), "obs_idx") == want
    vectors = scans.scan_x_vector(ds)
    assert [(o, *v) for o, v in rows(vectors, "obs_idx")] == want
    long = matrix.vectors_to_long(vectors)
    assert rows(matrix.nonzero(long)) == sorted(stored, key=repr)
    assert rows(matrix.slice_observations(ds.x, 2, 3)) == sorted(
        [c for c in stored if 2 <= c[0] < 5], key=repr
    )
    assert {c[1] for c in rows(matrix.project_variables(ds.x, [1, 4]))} <= {1, 4}


def test_projection_reaches_the_scan(spark, tmp_path):
    cells = spark.createDataFrame(random_cells(20, 10, 0.5, seed=5), CELLS)
    cells.write.parquet(f"{tmp_path}/x")
    stored = spark.read.parquet(f"{tmp_path}/x")
    obs = spark.range(20).withColumnRenamed("id", "obs_idx")
    plan = scans.wide_cells(obs, stored, [(3, "a"), (5, "b")])._jdf.queryExecution().toString()
    assert "In(var_idx, [3,5])" in plan
    assert plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("columns", [0, 64])
def test_repeated_orphan_and_outside_cells(spark, monkeypatch, columns):
    monkeypatch.setattr(scans, "CONDITIONAL_COLUMNS", columns)
    obs = spark.range(2).withColumnRenamed("id", "obs_idx")
    var = spark.createDataFrame([(i, f"g{i}") for i in range(3)], "var_idx bigint, _index string")
    stored = [(0, 1, 5.0), (0, 1, 4.0), (9, 0, 7.0), (1, 2, 1.0)]
    ds = Dataset(obs=obs, var=var, x=spark.createDataFrame(stored, CELLS))
    want = [(0, 0.0, 5.0, 0.0), (1, 0.0, 0.0, 1.0)]
    assert rows(scans.scan_x(ds), "obs_idx") == want
    assert [(o, *v) for o, v in rows(scans.scan_x_vector(ds), "obs_idx")] == want
    outside = Dataset(obs=obs, var=var, x=spark.createDataFrame([(0, 3, 1.0)], CELLS))
    with pytest.raises(Exception, match="outside the 3 variables"):
        scans.scan_x_vector(outside).collect()


def test_vector_width_is_the_longest(spark):
    vectors = spark.createDataFrame([(0, None), (1, [1.0]), (2, [1.0, 2.0, 3.0])], "obs_idx bigint, vec array<double>")
    ds = Dataset(obs=spark.range(3).withColumnRenamed("id", "obs_idx"), obsm={"m": vectors})
    assert rows(scans.scan_obsm(ds, "m"), "obs_idx")[1:] == [(1, 1.0, None, None), (2, 1.0, 2.0, 3.0)]
    assert scans.vector_width(vectors.filter("obs_idx = 0")) == 0
