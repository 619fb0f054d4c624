import pytest
from obsvar.model import Dataset, DatasetError, Raw
from obsvar.operators import collection as many
from obsvar.operators import inspect, scans
from obsvar.sources import files, store
from pyspark.sql import functions as F

from .conftest import rows
from .test_collection import sample

CELLS = "obs_idx bigint, var_idx bigint, value double"


@pytest.fixture(scope="module")
def small(spark):
    var = spark.createDataFrame(
        [(i, f"Gene_{i:03d}", f"ENSG{i:011d}", i % 2 == 0) for i in range(50)],
        "var_idx bigint, gene_name string, gene_id string, highly_variable boolean",
    )
    raw_var = spark.createDataFrame(
        [(i, f"raw_gene_{i}", f"ENSG{i + 100:08d}", True) for i in range(60)],
        "var_idx bigint, _index string, gene_id string, is_expressed boolean",
    )
    return Dataset(
        obs=spark.range(100).select(F.col("id").alias("obs_idx"), F.lit("T").alias("cell_type")),
        var=var,
        x=spark.createDataFrame([(0, 1, 2.0), (99, 49, 3.0)], CELLS),
        x_format="dense",
        layers={"raw counts": spark.createDataFrame([(0, 1, 2)], "obs_idx bigint, var_idx bigint, value int")},
        obsm={"X_pca": spark.range(100).select(F.col("id").alias("obs_idx"), F.expr("array(1.5D, 2.5D) as vec"))},
        varp={"corr": spark.createDataFrame([(1, 2, 0.5)], "var_idx_1 bigint, var_idx_2 bigint, value double")},
        raw=Raw(
            raw_var, spark.createDataFrame([(0, 0, 6.0), (0, 1, 8.0)], CELLS), "csr",
            {"PCs": raw_var.select("var_idx", F.expr("array(0.5D, 0.25D, 0.125D) as vec"))},
        ),
    )


@pytest.fixture(scope="module")
def stored(spark, small, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('store')}/small set"
    store.save_dataset(small, path)
    return path


def test_round_trip(spark, small, stored):
    ds = store.open_dataset(spark, stored)
    assert (ds.var_name_column, ds.var_id_column) == ("gene_name", "gene_id")
    assert rows(ds.obs) == rows(small.obs) and rows(ds.var) == rows(small.var)
    assert rows(ds.x) == rows(small.x)
    assert rows(scans.scan_layer(ds, "raw counts", ["Gene_001"]).filter("Gene_001 > 0")) == [(0, 2)]
    assert scans.scan_obsm(ds, "X_pca").columns == ["obs_idx", "X_pca_0", "X_pca_1"]
    assert scans.scan_raw_varm(ds, "PCs").count() == 60
    named = store.open_dataset(spark, stored, var_name_column="gene_id")
    assert "ENSG00000000000" in scans.scan_x(named).columns


def test_info(spark, stored):
    info = dict(rows(inspect.dataset_info(store.open_dataset(spark, stored))))
    assert info["n_obs"] == "100" and info["n_vars"] == "50" and info["x_shape"] == "100 x 50"
    assert info["x_sparse"] == "false" and "x_format" not in info and "obsp_keys" not in info
    assert info["groups"] == "obs, var, X, obsm, layers, varp"
    assert info["tables"] == "obs, var, info, X, obsm_X_pca, layers_raw counts, varp_corr"
    assert info["var_name_column"] == "gene_name" and info["var_id_column"] == "gene_id"
    assert info["raw"] == "true" and info["raw_x_shape"] == "100 x 60" and info["raw_x_format"] == "csr"
    assert info["raw_varm_keys"] == "PCs"


def test_views(spark, stored):
    created = store.create_views(store.open_dataset(spark, stored), "ad")
    assert "ad_X" in created and "ad_raw_X" in created and "ad_X_long" in created
    assert spark.sql("select raw_gene_0, raw_gene_1 from ad_raw_X where obs_idx = 0").first() == (6.0, 8.0)
    assert spark.sql("select count(*) from ad_X").first()[0] == 100
    joined = spark.sql(
        "select count(*) from ad_X x join ad_obs o on x.obs_idx = o.obs_idx where o.cell_type = 'T'"
    )
    assert joined.first()[0] == 100
    # a boolean column still answers the text form
    assert spark.sql("select count(*) from ad_var where highly_variable = 'True'").first()[0] == 25


def test_variable_filters_reach_the_files(spark, stored):
    ds = store.open_dataset(spark, stored)
    plan = scans.scan_x(ds, ["Gene_001"])._jdf.queryExecution().toString()
    assert "PushedFilters: [In(var_idx, [1])" in plan or "EqualTo(var_idx,1)" in plan


def test_missing_things(spark, small, stored, tmp_path):
    ds = store.open_dataset(spark, stored)
    with pytest.raises(DatasetError, match="not found.*raw counts"):
        scans.scan_layer(ds, "nope")
    with pytest.raises(DatasetError, match="needs the name"):
        scans.scan_obsm(ds, "")
    with pytest.raises(DatasetError, match="not found"):
        scans.scan_raw_varm(ds, "nope")
    bare = Dataset(obs=small.obs, var=small.var, path="bare")
    with pytest.raises(DatasetError, match="does not contain a raw section"):
        scans.scan_raw_x(bare)
    with pytest.raises(DatasetError, match="no X"):
        scans.scan_x(bare)
    with pytest.raises(DatasetError, match="No files found"):
        store.open_dataset(spark, f"{tmp_path}/nothing")
    with pytest.raises(DatasetError, match="neither obs nor var"):
        store.save_dataset(Dataset(path="empty"), f"{tmp_path}/empty")


def test_collection_from_disk_equals_the_one_in_memory(spark, tmp_path):
    members = {f"sample{n}": sample(spark, n) for n in (1, 2, 3)}
    for name, ds in members.items():
        store.save_dataset(ds, f"{tmp_path}/{name}")
    disk = store.open_collection(spark, f"{tmp_path}/sample[0-9]")
    memory = many.Collection.of(members)
    assert disk.members == memory.members
    assert len(disk.parts[("x", None)]) == 1  # one scan for members of one schema
    assert len(disk.parts[("obs", None)]) == 3
    for mode in many.MODES:
        assert rows(many.harmonize_obs(disk, mode)) == rows(many.harmonize_obs(memory, mode))
        assert rows(many.harmonize_x(disk, mode)) == rows(many.harmonize_x(memory, mode))
        assert rows(many.harmonize_obsm(disk, "X_pca", mode)) == rows(many.harmonize_obsm(memory, "X_pca", mode))
    assert rows(many.concat_obsp(disk, "distances")) == rows(many.concat_obsp(memory, "distances"))
    assert store.open_collection(spark, f"{tmp_path}/sample?").members == disk.members
    with pytest.raises(DatasetError, match="No files found"):
        store.open_collection(spark, f"{tmp_path}/other_*")


def test_odd_member_names(spark, tmp_path):
    for name in ("a+b", "a c", "a%d"):
        store.save_dataset(sample(spark, 1), f"{tmp_path}/{name}")
    col = store.open_collection(spark, f"{tmp_path}/a*")
    found = {r[0] for r in many.concat_obsp(col, "distances").select("_file_name").collect()}
    assert found == set(col.members) == {"a+b", "a c", "a%d"}


def test_plain_files(spark, tmp_path):
    spark.range(3).select("id", F.lit("a").alias("left_only")).coalesce(1).write.parquet(f"{tmp_path}/one")
    spark.range(2).selectExpr("id as key").coalesce(1).write.parquet(f"{tmp_path}/two")
    found = files.matching_files(spark, [f"{tmp_path}/*/part*.parquet", f"{tmp_path}/one/*.parquet"], ".parquet")
    assert len(found) == 2
    name = next(p for p in found if "/two/" in p).rsplit("/", 1)[-1]
    col = files.read_tables(spark, f"{tmp_path}/*/*.parquet", {name: {"key": "id"}})
    df = many.harmonize_table(col, "obs", "id", "union")
    assert df.count() == 5 and df.select("_file_name").distinct().count() == 2
    with pytest.raises(DatasetError, match="No files found"):
        files.read_tables(spark, f"{tmp_path}/*.none")


def test_export_and_annotation(spark, small, tmp_path):
    files.export_parquet(small.obs, f"{tmp_path}/out", ["cell_type"])
    assert spark.read.parquet(f"{tmp_path}/out").count() == 100
    spark.createDataFrame([("Gene_001", "p1")], "gene_name string, pathway string").write.option(
        "header", True
    ).csv(f"{tmp_path}/notes")
    notes = files.read_annotation(spark, f"{tmp_path}/notes", "gene_name string, pathway string")
    from obsvar.plans.analysis import annotate_variables

    got = annotate_variables(small, notes, "gene_name")
    assert got.count() == 50 and got.filter("pathway = 'p1'").count() == 1
