import pytest
from obsvar.model import Dataset, DatasetError
from obsvar.operators import collection as many
from obsvar.operators import scans
from obsvar.plans import analysis
from pyspark.sql import functions as F

from .conftest import rows

GENES = [["A", "B", "C", "D"], ["B", "C", "D", "E"], ["C", "D", "E", "F"]]
METRICS = ["metric_alpha", "metric_beta", "metric_gamma"]
N_OBS = 20


def value(sample, obs, gene):
    return float((sample * 31 + obs * 7 + ord(gene)) % 5)  # 0 means not stored


def sample(spark, number):
    i = number - 1
    genes = GENES[i]
    obs = [
        (o, f"s{number}_cell_{o}", ["T cell", "B cell", "Monocyte"][o % 3], 1000 + o, f"sample{number}", o / 20)
        for o in range(N_OBS)
    ]
    cells = [
        (o, v, value(number, o, g)) for o in range(N_OBS) for v, g in enumerate(genes) if value(number, o, g)
    ]
    x = spark.createDataFrame(cells, "obs_idx bigint, var_idx bigint, value double")
    dims = 10 + number
    return Dataset(
        obs=spark.createDataFrame(
            obs,
            f"obs_idx bigint, _index string, cell_type string, n_counts bigint, sample_id string, {METRICS[i]} double",
        ),
        var=spark.createDataFrame(
            [(v, f"Gene_{g}", f"Gene_{g}", v % 2 == 0) for v, g in enumerate(genes)],
            "var_idx bigint, _index string, gene_name string, highly_variable boolean",
        ),
        x=x,
        layers={"raw": x.withColumn("value", F.col("value").cast("int")), f"only{number}": x},
        obsm={
            "X_pca": spark.createDataFrame(
                [(o, [float(d) for d in range(dims)]) for o in range(N_OBS)], "obs_idx bigint, vec array<float>"
            )
        },
        varm={
            "loadings": spark.createDataFrame(
                [(v, [0.5] * 5) for v in range(4)], "var_idx bigint, vec array<float>"
            )
        },
        obsp={
            "distances": spark.createDataFrame(
                [(0, number, 1.5)], "obs_idx_1 bigint, obs_idx_2 bigint, value double"
            )
        },
        varp={
            "correlations": spark.createDataFrame(
                [(0, 1, 0.5)], "var_idx_1 bigint, var_idx_2 bigint, value double"
            )
        },
        path=f"sample{number}",
    )


@pytest.fixture(scope="module")
def samples(spark):
    return {f"sample{n}": sample(spark, n) for n in (3, 1, 2)}


@pytest.fixture(scope="module")
def col(samples):
    return many.Collection.of(samples)


def test_obs_intersection(col):
    df = many.harmonize_obs(col)
    assert df.columns == ["_file_name", "obs_idx", "_index", "cell_type", "n_counts", "sample_id"]
    assert df.count() == 60
    assert df.select("_file_name").distinct().count() == 3


def test_obs_union_fills_null(col):
    df = many.harmonize_obs(col, "union")
    assert df.columns[-3:] == METRICS
    assert [df.filter(F.col(m).isNotNull()).count() for m in METRICS] == [20, 20, 20]


def test_var_keeps_all_rows(col):
    for mode in many.MODES:
        df = many.harmonize_var(col, mode)
        assert (df.count(), df.select("_index").distinct().count()) == (12, 6)


def test_x_intersection_and_union(col):
    both = many.harmonize_x(col)
    assert both.columns == ["_file_name", "obs_idx", "Gene_C", "Gene_D"]
    assert both.filter("Gene_C is not null and Gene_D is not null").count() == 60
    union = many.harmonize_x(col, "union")
    assert union.columns[2:] == [f"Gene_{g}" for g in "ABCDEF"]
    got = {(r._file_name, r.obs_idx): r for r in union.collect()}
    assert len(got) == 60
    for n in (1, 2, 3):
        for o in range(N_OBS):
            for g in "ABCDEF":
                want = value(n, o, g) if g in GENES[n - 1] else None
                assert got[(f"sample{n}", o)][f"Gene_{g}"] == want
    shared = union.select("_file_name", "obs_idx", "Gene_C", "Gene_D")
    assert rows(shared) == rows(both)


def test_layer_and_chosen_variables(col):
    layer = many.harmonize_layer(col, "raw", "union", ["Gene_A", "Gene_C"])
    assert dict(layer.dtypes)["Gene_A"] == "int"
    assert layer.filter("Gene_A is not null").count() == 20
    assert layer.filter("Gene_C is not null").count() == 60
    with pytest.raises(DatasetError, match="Gene_A.*sample2"):
        many.harmonize_x(col, names=["Gene_C", "Gene_A"])
    with pytest.raises(DatasetError, match="only1.*sample2, sample3"):
        many.harmonize_layer(col, "only1")


def test_vector_widths(col):
    low = many.harmonize_obsm(col, "X_pca")
    assert low.columns[-1] == "X_pca_10" and low.filter("X_pca_10 is not null").count() == 60
    high = many.harmonize_obsm(col, "X_pca", "union")
    assert high.columns[-1] == "X_pca_12" and high.filter("X_pca_12 is not null").count() == 20
    assert many.harmonize_varm(col, "loadings").count() == 12


def test_pairs_stay_in_their_file(col):
    assert rows(many.concat_obsp(col, "distances"), "_file_name") == [
        (f"sample{n}", 0, n, 1.5) for n in (1, 2, 3)
    ]
    assert many.concat_varp(col, "correlations").select("_file_name").distinct().count() == 3


def test_long_form_agrees_with_wide(col):
    long = many.harmonize_long(col).groupBy("var_name").agg(F.sum("value")).collect()
    wide = many.harmonize_x(col).agg(F.sum("Gene_C"), F.sum("Gene_D")).first()
    assert {r[0]: r[1] for r in long} == {"Gene_C": wide[0], "Gene_D": wide[1]}


def test_one_member_collection_is_the_dataset(samples):
    alone = many.Collection.of({"sample1": samples["sample1"]})
    wide = many.harmonize_x(alone)
    assert rows(wide.drop("_file_name")) == rows(scans.scan_x(samples["sample1"]))


def test_duplicates_are_renamed_inside_each_member(spark):
    def member(names):
        return Dataset(
            obs=spark.range(1).withColumnRenamed("id", "obs_idx"),
            var=spark.createDataFrame(list(enumerate(names)), "var_idx bigint, _index string"),
            x=spark.createDataFrame(
                [(0, i, i + 1.0) for i in range(len(names))], "obs_idx bigint, var_idx bigint, value double"
            ),
        )

    col = many.Collection.of({"a": member(["X", "X"]), "b": member(["X"])})
    assert rows(many.harmonize_x(col, "union"), "_file_name") == [("a", 0, 1.0, 2.0), ("b", 0, 1.0, None)]


def test_errors(spark, samples):
    with pytest.raises(DatasetError, match="No files found"):
        many.Collection.of({})
    with pytest.raises(DatasetError, match="schema_mode 'both'"):
        many.harmonize_obs(many.Collection.of(samples), "both")
    left = Dataset(obs=spark.createDataFrame([(0, "i", 1)], "obs_idx bigint, _index string, a int"))
    right = Dataset(obs=spark.createDataFrame([(0, "i", 1)], "obs_idx bigint, _index string, b int"))
    with pytest.raises(DatasetError, match="common"):
        many.harmonize_obs(many.Collection.of({"l": left, "r": right}))


def test_types_are_coerced_before_the_union(spark):
    def member(expr, kind):
        return Dataset(obs=spark.range(1).select(F.col("id").alias("obs_idx"), F.expr(expr).cast(kind).alias("v")))

    def combined(*members):
        df = many.harmonize_obs(many.Collection.of({f"m{i}": m for i, m in enumerate(members)}))
        return dict(df.dtypes)["v"], [r.v for r in df.orderBy("_file_name").collect()]

    assert combined(member("1", "tinyint"), member("2", "int")) == ("bigint", [1, 2])
    assert combined(member("1", "int"), member("2.5", "float")) == ("double", [1.0, 2.5])
    assert combined(member("true", "boolean"), member("3", "int")) == ("string", ["true", "3"])
    assert combined(member("'x'", "string"), member("1.5", "double")) == ("string", ["x", "1.5"])


def test_cross_member_analytics(col):
    means = {(r._file_name, r.var_name): r.mean_expr for r in analysis.cross_file_expression(col).collect()}
    assert set(means) == {(f"sample{n}", f"Gene_{g}") for n in (1, 2, 3) for g in "CD"}
    for (f, g), mean in means.items():
        n = int(f[-1])
        assert mean == pytest.approx(sum(value(n, o, g[-1]) for o in range(N_OBS)) / N_OBS)
    by_kind = analysis.cross_file_by_kind(col, "cell_type")
    assert by_kind.count() == 9 and "mean_Gene_C" in by_kind.columns
    assert rows(analysis.cohort_counts(col), "_file_name") == [(f"sample{n}", 20, 4) for n in (1, 2, 3)]
    assert analysis.file_composition(col, "cell_type").agg(F.sum("n_cells")).first()[0] == 60
