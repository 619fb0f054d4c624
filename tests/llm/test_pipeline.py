"""The pipeline's stages, and the registered queries against their SQL."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import __spark_entry__ as contract
import corpus_pipeline
from compare import connect, table

from obsvar.llm import decontaminate, jaccard
from obsvar.llm.queries import QUERIES
from obsvar.llm.sql import SQL
from tests.llm.helpers import DOCS, edge_docs

FOLDER = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


def test_registered():
    names = contract.queries()
    assert QUERIES.keys() <= names.keys() and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@here
@pytest.mark.parametrize("name", [n for n in SQL if n != "op3_shards"])
def test_queries_equal_sql(spark, name):
    found = QUERIES[name](spark, FOLDER)
    expected = connect(FOLDER).execute(SQL[name])
    assert table(found.columns, found.collect()) == table([d[0] for d in expected.description], expected.fetchall())


@here
@pytest.mark.parametrize("name", ["op2_decontaminate", "op4_pii"])
def test_native_plans_have_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@here
def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, kept[-1], FOLDER).cache()
        if name != "sharding":
            assert found.columns == docs.columns and found.dtypes == docs.dtypes
        kept.append(found)
    _, calm, single, clean, mixed, sharded = kept
    assert calm.count() > 0.8 * docs.count()
    groups = jaccard.similar_groups(calm, 5, 80).select("component_id").distinct().count()
    assert single.count() == groups
    assert decontaminate.contamination(clean, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).count() == 0
    assert mixed.join(clean, "doc_id", "left_anti").count() == 0
    assert sharded.count() == mixed.count() and sharded.select("shard").distinct().count() == 16
    total = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, total.collect()), key=repr) == sorted(map(tuple, sharded.collect()), key=repr)


@here
def test_stage_edges(spark):
    for docs in (edge_docs(spark).drop("weight"), spark.createDataFrame([], DOCS)):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, FOLDER)
            if name != "sharding":
                assert docs.columns == [f.split()[0] for f in DOCS.split(", ")]
        assert docs.count() >= 0
