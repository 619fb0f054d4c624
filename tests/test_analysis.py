"""Analytics against brute force on a dense matrix, with one observation group holding most cells."""

import statistics as st
import random

import pytest
from obsvar.model import Dataset
from obsvar.plans import analysis

N_OBS, N_VAR = 30, 8
KINDS = ["hot"] * 18 + ["b"] * 8 + ["c"] * 3 + ["lone"]


@pytest.fixture(scope="module")
def dense():
    rng = random.Random(11)
    m = [[0.0] * N_VAR for _ in range(N_OBS)]
    for o in range(N_OBS):
        for v in range(N_VAR - 1):  # the last variable stays empty
            if rng.random() < 0.4 and not (KINDS[o] == "c" and v < 3):
                m[o][v] = rng.choice([-1.0, 0.5, 2.0, 1e6 + v])
    return m


@pytest.fixture(scope="module")
def ds(spark, dense):
    obs = [(o, KINDS[o], ["x", "y"][o % 2], o / 10 if o % 3 else None) for o in range(N_OBS)]
    var = [(v, f"MT-{v}" if v < 2 else f"G{v}", v % 2 == 0) for v in range(N_VAR)]
    cells = [(o, v, x) for o, row in enumerate(dense) for v, x in enumerate(row) if x]
    x = spark.createDataFrame(cells, "obs_idx bigint, var_idx bigint, value double")
    vec = spark.createDataFrame([(o, [o + 0.5, o + 0.25]) for o in range(N_OBS)], "obs_idx bigint, vec array<double>")
    return Dataset(
        obs=spark.createDataFrame(obs, "obs_idx bigint, kind string, side string, pseudotime double"),
        var=spark.createDataFrame(var, "var_idx bigint, _index string, marked boolean"),
        x=x, layers={"a": x, "b": x.filter("value > 0")}, obsm={"e": vec, "d": vec},
        obsp={"p": spark.createDataFrame([(0, 29, 2.5), (1, 18, -1.0), (2, 3, 3.0)],
                                         "obs_idx_1 bigint, obs_idx_2 bigint, value float")},
    )


def column_of(dense, kind, v):
    return [dense[o][v] for o in range(N_OBS) if KINDS[o] == kind]


def test_expression_by_group(ds, dense):
    names = [f"MT-{v}" if v < 2 else f"G{v}" for v in range(N_VAR)]
    got = {(r.kind, r.gene): r for r in analysis.expression_by_group(ds, "kind", names).collect()}
    assert len(got) == 4 * N_VAR
    for kind in set(KINDS):
        for v, name in enumerate(names):
            values, r = column_of(dense, kind, v), got[(kind, name)]
            assert r.mean_expr == pytest.approx(st.mean(values), abs=1e-9) and r.n_cells == len(values)
            if len(values) > 1:
                assert r.std_expr == pytest.approx(st.stdev(values), rel=1e-9, abs=1e-9)
            else:
                assert r.std_expr is None


def test_stored_cells_only(ds, dense):
    got = {(r.kind, r.var_idx): r.mean_expr for r in analysis.expression_by_group_stored(ds, "kind").collect()}
    want = {}
    for kind in set(KINDS):
        for v in range(N_VAR):
            stored = [x for x in column_of(dense, kind, v) if x]
            if stored:
                want[(kind, v)] = pytest.approx(st.mean(stored))
    assert got == want


def test_markers_and_batch_effect(ds, dense):
    got = {(r.kind, r.var_idx): (r.mean_expr, r.pct_expressed) for r in analysis.cluster_markers(ds, "kind").collect()}
    want = {}
    for kind in set(KINDS):
        for v in range(N_VAR):
            values = column_of(dense, kind, v)
            pct = 100.0 * sum(x > 0 for x in values) / len(values)
            if pct > 25:
                want[(kind, v)] = (pytest.approx(st.mean(values)), pytest.approx(pct))
    assert got == want
    effect = {r.var_idx: r for r in analysis.batch_effect(ds, "kind", 100).collect()}
    for v in range(N_VAR - 1):
        means = [st.mean(column_of(dense, k, v)) for k in sorted(set(KINDS))]
        assert effect[v].max_batch_difference == pytest.approx(max(means) - min(means))
        assert effect[v].batch_std == pytest.approx(st.stdev(means))


def test_differential(ds, dense):
    import math

    want = []
    for v in range(N_VAR):
        a, b = st.mean(column_of(dense, "hot", v)), st.mean(column_of(dense, "c", v))
        if a + 0.001 > 0 and b + 0.001 > 0:
            change = math.log10(a + 0.001) - math.log10(b + 0.001)
            if abs(change) > 1:
                want.append((v, pytest.approx(change)))
    got = analysis.differential_expression(ds, "kind", "hot", "c").collect()
    assert sorted((r.var_idx, r.log_fold_change) for r in got if r.log_fold_change is not None) == sorted(
        want, key=lambda x: x[0]
    )


def test_scores_fractions_density(ds, dense):
    sets = {"s1": ["MT-0", "G2"], "s2": ["G7"], "s3": ["MT-0", "MT-1", "G3"]}
    where = {"MT-0": 0, "MT-1": 1, "G2": 2, "G3": 3, "G7": 7}
    got = {(r.obs_idx, r.set_name): r.set_score for r in analysis.gene_set_score(ds, sets).collect()}
    assert len(got) == N_OBS * 3
    for (o, s), score in got.items():
        assert score == pytest.approx(st.mean(dense[o][where[n]] for n in sets[s]))
    many = {f"m{k}": ["G2", "G7"] if k % 2 else ["G3"] for k in range(150)}
    found = analysis.gene_set_score(ds, many).collect()
    assert len(found) == N_OBS * 150
    assert all(r.set_score == pytest.approx(st.mean(dense[r.obs_idx][where[n]] for n in many[r.set_name])) for r in found)
    assert analysis.differential_expression(ds, "kind", "hot", "no such kind").count() == 0
    for r in analysis.marked_fraction(ds, "MT-%").collect():
        total = sum(dense[r.obs_idx])
        assert r.n_genes == sum(x > 0 for x in dense[r.obs_idx])
        if total:
            assert r.marked_fraction == pytest.approx(sum(dense[r.obs_idx][:2]) / total)
        else:
            assert r.marked_fraction is None
    density = analysis.matrix_density(ds).first()
    positive = sum(x > 0 for row in dense for x in row)
    assert (density.total_entries, density.nonzero_entries) == (N_OBS * N_VAR, positive)


def test_top_lists(ds, dense):
    means = {v: st.mean(row[v] for row in dense) for v in range(N_VAR)}
    top = [r.var_idx for r in analysis.top_features(ds, "marked", 2).collect()]
    assert top == sorted((v for v in range(0, N_VAR, 2)), key=lambda v: -means[v])[:2]
    high = [r.var_idx for r in analysis.high_expression(ds, 1.0, 3).collect()]
    assert high == sorted((v for v in means if means[v] > 1), key=lambda v: -means[v])[:3]


def test_joins_on_metadata(ds):
    line = analysis.trajectory(ds, "pseudotime", ["kind"], {"e": 2, "d": 1}).collect()
    assert [r.obs_idx for r in line] == [o for o in range(N_OBS) if o % 3]
    assert line[0].asDict() == {"obs_idx": 1, "kind": "hot", "pseudotime": 0.1, "e_0": 1.5, "e_1": 1.25, "d_0": 1.5}
    pairs = analysis.annotate_pairs(ds, "p", "kind").orderBy("obs_idx_1").collect()
    assert [(r.kind_1, r.kind_2) for r in pairs] == [("hot", "lone"), ("hot", "b"), ("hot", "hot")]
    stats = analysis.pair_stats(ds.obsp["p"]).first()
    assert (stats.n_pairs, stats.min_idx_1, stats.max_idx_2, stats.avg_rounded, stats.n_negative) == (3, 0, 29, 2, 1)
    share = {(r.side, r.kind): r.pct_of_cluster for r in analysis.cluster_composition(ds, "side", "kind").collect()}
    assert share[("x", "hot")] == pytest.approx(60.0)
    both = analysis.layer_compare(ds, ["a", "b"])
    assert both.count() == ds.layers["b"].count()
