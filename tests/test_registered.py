"""Every registered query against its SQL on the smallest tables, and rules for all plans."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as contract  # noqa: E402
from compare import connect, table  # noqa: E402

from obsvar.plans.oracle import SQL  # noqa: E402
from obsvar.plans.registered import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def other():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.items() <= contract.queries().items()
    assert SQL.items() <= contract.oracle_sql().items()


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, other, name):
    df = contract.queries()[name](spark, FOLDER)
    found = df.collect()
    expected = other.execute(contract.oracle_sql()[name])
    assert table(df.columns, found) == table([d[0] for d in expected.description], expected.fetchall())
    plan = df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan
