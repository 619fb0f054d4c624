"""The annotated-matrix data model: every component is a DataFrame.

=====================  ==========================================================
``obs`` / ``var``      ``obs_idx`` / ``var_idx`` (dense, 0-based) plus metadata
``x``, ``layers[n]``   stored cells ``(obs_idx, var_idx, value)``; other cells are 0
``obsm`` / ``varm``    ``(obs_idx | var_idx, vec array<number>)``
``obsp`` / ``varp``    stored pairs ``(obs_idx_1, obs_idx_2, value)`` and alike
``uns``                metadata leaves ``(key, type, dtype, shape, value)``
``raw``                a second ``var`` / ``x`` / ``varm`` over the same ``obs``
=====================  ==========================================================
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

INDEX_COLUMN = "_index"


class DatasetError(ValueError):
    """A request the dataset cannot answer; raised before any plan is built."""


class Components(Mapping):
    """Named matrices whose plans are made when they are first asked for."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers, self._made = dict(makers), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


@dataclass(frozen=True)
class Raw:
    var: DataFrame
    x: DataFrame | None = None
    x_format: str = "csr"
    varm: Mapping[str, DataFrame] = field(default_factory=dict)


@dataclass(frozen=True)
class Dataset:
    obs: DataFrame | None = None
    var: DataFrame | None = None
    x: DataFrame | None = None
    x_format: str = "csr"
    layers: Mapping[str, DataFrame] = field(default_factory=dict)
    obsm: Mapping[str, DataFrame] = field(default_factory=dict)
    varm: Mapping[str, DataFrame] = field(default_factory=dict)
    obsp: Mapping[str, DataFrame] = field(default_factory=dict)
    varp: Mapping[str, DataFrame] = field(default_factory=dict)
    uns: DataFrame | None = None
    raw: Raw | None = None
    path: str = ""
    declared_shape: tuple[int | None, int | None] = (None, None)
    var_name_column: str = INDEX_COLUMN
    var_id_column: str = INDEX_COLUMN

    def require_obs(self) -> DataFrame:
        if self.obs is None:
            raise DatasetError(f"dataset '{self.path}' has no obs table")
        return self.obs

    def require_var(self) -> DataFrame:
        if self.var is None:
            raise DatasetError(f"dataset '{self.path}' has no var table")
        return self.var

    def require_x(self) -> DataFrame:
        self.require_obs(), self.require_var()
        if self.x is None:
            raise DatasetError(f"dataset '{self.path}' has no X matrix")
        return self.x

    def require_raw(self) -> Raw:
        if self.raw is None:
            raise DatasetError(f"dataset '{self.path}' does not contain a raw section")
        return self.raw

    def member(self, kind: str, name: str | None) -> DataFrame:
        """The matrix ``name`` of ``kind`` (layers, obsm, varm, obsp, varp)."""
        return pick_member(getattr(self, kind), kind, name, self.path)


def pick_member(found: Mapping[str, DataFrame], kind: str, name: str | None, path: str) -> DataFrame:
    if not name:
        raise DatasetError(f"{kind} needs the name of a matrix; available: {', '.join(found) or 'none'}")
    if name not in found:
        raise DatasetError(
            f"{kind} matrix '{name}' not found in '{path}'; available: {', '.join(found) or 'none'}"
        )
    return found[name]
