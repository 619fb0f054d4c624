"""Column-name rules."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """``name`` as a back-quoted identifier, so that ``HLA-A`` or ``a.b`` stay one column."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def metadata_names(names: Iterable[str], taken: Iterable[str] = ()) -> list[str]:
    """Names made unique without regard to case by appending underscores, in order."""
    seen = {n.lower() for n in taken}
    out = []
    for name in names:
        while name.lower() in seen:
            name += "_"
        seen.add(name.lower())
        out.append(name)
    return out


def with_unique_columns(df: DataFrame) -> DataFrame:
    """``df`` with clashing column names renamed by position (Spark cannot address them by name)."""
    names = metadata_names(df.columns)
    return df if names == df.columns else df.toDF(*names)


def find_column(columns: Sequence[str], wanted: str) -> str | None:
    """The column equal to ``wanted`` without regard to case."""
    return next((c for c in columns if c.lower() == wanted.lower()), None)
