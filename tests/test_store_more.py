"""What the store writes and what a read of it touches; schemas of many plain files; sets as tables."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from obsvar.model import Dataset, DatasetError
from obsvar.operators import collection as many
from obsvar.operators import scans
from obsvar.plans import analysis
from obsvar.session import discard, scratch_path, written
from obsvar.sources import files, store
from pyspark.sql import functions as F

from .conftest import rows

CELLS = "obs_idx bigint, var_idx bigint, value double"


def scanned(df) -> int:
    """Rows that the file scans of a plan have read, once it has run."""
    df.collect()

    def leaves(node):
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            return leaves(node.executedPlan())
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            return leaves(node.plan())
        if node.nodeName().startswith("Scan parquet"):
            return [node.metrics().apply("numOutputRows").value()]
        children = node.children()
        return [n for k in range(children.size()) for n in leaves(children.apply(k))]

    return max(leaves(df._jdf.queryExecution().executedPlan()))


def test_named_variables_read_a_small_part_of_the_cells(spark, tmp_path):
    n_obs, n_var = 500, 200
    cells = spark.range(n_obs * n_var).selectExpr(f"id div {n_var} as obs_idx", f"id % {n_var} as var_idx", "cast(id % 7 + 1 as double) as value")
    ds = Dataset(
        obs=spark.range(n_obs).withColumnRenamed("id", "obs_idx"),
        var=spark.range(n_var).selectExpr("id as var_idx", "concat('g', id) as _index"),
        x=cells,
    )
    store.save_dataset(ds, f"{tmp_path}/d", file_rows=40_000, group_rows=2_000)
    assert len(list((tmp_path / "d" / "x").glob("*.parquet"))) == 3  # 100,000 rows
    held = pq.ParquetFile(next((tmp_path / "d" / "x").glob("*.parquet"))).metadata
    assert all(held.row_group(k).num_rows <= 2_000 for k in range(held.num_row_groups))
    back = store.open_dataset(spark, f"{tmp_path}/d", "_index", "_index")
    wide = scans.scan_x(back, ["g7", "g150"])
    assert scanned(wide) < n_obs * n_var / 10
    assert {r.obs_idx: (r.g7, r.g150) for r in wide.collect()} == {o: (float((o * n_var + 7) % 7 + 1), float((o * n_var + 150) % 7 + 1)) for o in range(n_obs)}


def test_two_thousand_small_files_open_in_few_jobs(spark, tmp_path):
    for k in range(2_000):
        columns = {"id": [k], "left": [1.5]} if k % 2 else {"id": [k], "right": ["r"]}
        pq.write_table(pa.table(columns), tmp_path / f"f{k:04d}.parquet")
    tracker, group = spark.sparkContext.statusTracker(), "footers"
    spark.sparkContext.setJobGroup(group, "open")
    col = files.read_tables(spark, f"{tmp_path}/*.parquet")
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 10
    parts = col.parts["obs", None]
    assert len(parts) == 2 and sorted(len(p.members) for p in parts) == [1_000, 1_000]
    df = many.harmonize_table(col, "obs", "id", "union")
    assert df.count() == 2_000 and df.filter("left is null").count() == 1_000


def test_schemas_differ_by_type_and_by_what_spark_has_noted(spark, tmp_path):
    pq.write_table(pa.table({"id": pa.array([1], pa.int32())}), tmp_path / "a.parquet")
    pq.write_table(pa.table({"id": pa.array([1], pa.int64())}), tmp_path / "b.parquet")
    pq.write_table(pa.table({"id": pa.array([2], pa.int64())}), tmp_path / "c.parquet")
    found = files.schema_texts(spark, [f"file:{tmp_path}/{n}.parquet" for n in "abc"])
    a, b, c = found.values()
    assert b == c != a


@pytest.fixture(scope="module")
def repeated(spark):
    return Dataset(
        obs=spark.range(3).withColumnRenamed("id", "obs_idx"),
        var=spark.createDataFrame([(0, "A"), (1, "B"), (2, "A"), (3, "C")], "var_idx bigint, _index string"),
        x=spark.createDataFrame([(0, 0, 2.0), (0, 2, 4.0), (1, 1, 6.0), (1, 3, 1.0)], CELLS),
    )


def test_sets_given_as_a_table(spark, repeated):
    sets = spark.createDataFrame([("s", "a"), ("s", "A_1"), ("t", "B"), ("t", "B"), ("none", None), ("u", "C"), ("u", None)], "set_name string, variable string")
    found = {(r.obs_idx, r.set_name): r.set_score for r in analysis.gene_set_score(repeated, sets, "_index").collect()}
    assert found == {
        (0, "s"): 3.0, (0, "t"): 0.0, (0, "u"): 0.0, (0, "none"): None,
        (1, "s"): 0.0, (1, "t"): 6.0, (1, "u"): 1.0, (1, "none"): None,
        (2, "s"): 0.0, (2, "t"): 0.0, (2, "u"): 0.0, (2, "none"): None,
    }
    with pytest.raises(DatasetError, match="1 of those named, first 'Z'"):
        analysis.gene_set_score(repeated, sets.union(spark.createDataFrame([("t", "Z")], sets.schema)), "_index")


def test_an_empty_set_has_no_mean(repeated):
    found = analysis.gene_set_score(repeated, {"empty": [], "b": ["B"]}, "_index")
    assert {r.set_score for r in found.filter("set_name = 'empty'").collect()} == {None}


def test_scratch_tables_go_and_other_paths_stay(spark, tmp_path):
    df, path = written(spark.range(5), "test")
    assert df.count() == 5
    discard(spark, path)
    with pytest.raises(Exception, match="(?i)not exist|does not exist|PATH_NOT_FOUND"):
        spark.read.parquet(path).count()
    discard(spark, scratch_path(spark, "never"))  # nothing there
    with pytest.raises(ValueError, match="not a scratch table"):
        discard(spark, str(tmp_path))
    assert tmp_path.exists()


def test_components_are_made_once(spark, tmp_path):
    """Counting, sampling and writing read a stored copy, which is gone afterwards."""
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    obs = spark.range(40).withColumnRenamed("id", "obs_idx").mapInArrow(seen, "obs_idx bigint")
    var = spark.createDataFrame([(0, "g0")], "var_idx bigint, _index string")
    x = spark.createDataFrame([(3, 0, 1.0)], "obs_idx bigint, var_idx bigint, value double")
    store.save_dataset(Dataset(obs=obs, var=var, x=x), f"{tmp_path}/d", file_rows=10)
    assert made.value == 40
    assert spark.read.parquet(f"{tmp_path}/d/obs").count() == 40
    assert len(list((tmp_path / "d" / "obs").glob("*.parquet"))) == 4
