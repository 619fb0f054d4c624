from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from obsvar.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        "4", "tests", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"}
    )
    yield session
    session.stop()


def rows(df, *order):
    """Collected rows as tuples, sorted by ``order`` columns or by everything."""
    found = [tuple(r) for r in df.collect()]
    if order:
        at = [df.columns.index(c) for c in order]
        return sorted(found, key=lambda r: tuple(r[i] for i in at))
    return sorted(found, key=repr)
