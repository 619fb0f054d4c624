"""Datasets on disk: one folder, one Parquet table per component, one manifest.

The manifest (a one-line JSON text) lists the components with their schemas and widths and the
facts that are declared rather than guessed: matrix format, shape, column roles. Opening a
collection reads the manifests only, and datasets whose component schemas agree become one scan.
"""

from __future__ import annotations

import json
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsvar.functions.naming import column, quoted
from obsvar.model import INDEX_COLUMN, Dataset, DatasetError, Raw
from obsvar.operators import collection as many
from obsvar.operators.collection import FILE, Collection, Part
from obsvar.operators.inspect import dataset_info, table_names, validate
from obsvar.operators.scans import (
    scan_layer, scan_obs, scan_obsm, scan_obsp, scan_raw_var, scan_raw_varm, scan_raw_x,
    scan_uns, scan_var, scan_varm, scan_varp, scan_x, scan_x_long, vector_width,
)
from obsvar.operators.variables import detect_roles
from obsvar.session import discard, written

MANIFEST = "manifest"
NAMED = ("layers", "obsm", "varm", "obsp", "varp")
CLUSTERING = {
    "obs": ["obs_idx"], "var": ["var_idx"], "raw_var": ["var_idx"],
    "x": ["var_idx", "obs_idx"], "layers": ["var_idx", "obs_idx"], "raw_x": ["var_idx", "obs_idx"],
    "obsm": ["obs_idx"], "varm": ["var_idx"], "raw_varm": ["var_idx"],
    "obsp": ["obs_idx_1", "obs_idx_2"], "varp": ["var_idx_1", "var_idx_2"],
}


def _components(ds: Dataset) -> list[tuple[str, str | None, DataFrame]]:
    found = [("obs", None, ds.obs), ("var", None, ds.var), ("x", None, ds.x), ("uns", None, ds.uns)]
    for kind in NAMED:
        found += [(kind, n, df) for n, df in getattr(ds, kind).items()]
    if ds.raw is not None:
        found += [("raw_var", None, ds.raw.var), ("raw_x", None, ds.raw.x)]
        found += [("raw_varm", n, df) for n, df in ds.raw.varm.items()]
    return [c for c in found if c[2] is not None]


def _folder(root: str, kind: str, name: str | None) -> str:
    return f"{root.rstrip('/')}/{kind}" + (f"/{quote(name, safe='')}" if name else "")


#: Rows of a file and of one of its row groups: some 25 MB and 4 MB of stored cells. A task sorts a file's rows.
FILE_ROWS, GROUP_ROWS = 2_000_000, 250_000


def save_dataset(ds: Dataset, path: str, file_rows: int = FILE_ROWS, group_rows: int = GROUP_ROWS) -> None:
    """Write every component; matrices sorted by variable, so variable filters skip row groups.

    Each component is made once, into a scratch table; that is counted, and cut into as many ranges as ``file_rows`` asks for: files
    are neither tiny for a small component nor huge for a large one, however the session is set.
    ``group_rows`` bounds what a filter on one variable has to read. Observation numbers break the
    ties of the range sort: a variable with very many cells is spread over several files. The
    manifest is written last, so a folder with one is complete.
    """
    validate(ds)
    entries, spark = [], None
    for kind, name, df in _components(ds):
        spark = df.sparkSession
        keys = [k for k in CLUSTERING.get(kind, []) if k in df.columns]
        rows, held = df, None
        if keys:  # counted, sampled and sorted from a stored copy, so that it is made once
            df, held = written(df, "component")
            files = max(1, -(-df.count() // file_rows))
            rows = df.repartitionByRange(files, *keys).sortWithinPartitions(*keys)
        sized = rows.write.mode("errorifexists").option("parquet.block.row.count.limit", group_rows)
        sized.option("parquet.page.row.count.limit", min(group_rows, 20_000)).parquet(_folder(path, kind, name))
        entries.append(
            {
                "kind": kind, "name": name, "schema": df.schema.jsonValue(),
                "width": vector_width(df) if "vec" in df.columns else None,
            }
        )
        if held:
            discard(spark, held)
    manifest = {
        "components": entries, "x_format": ds.x_format,
        "raw_x_format": ds.raw.x_format if ds.raw else None, "shape": ds.declared_shape,
        "var_name_column": ds.var_name_column, "var_id_column": ds.var_id_column,
    }
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.text(
        f"{path.rstrip('/')}/{MANIFEST}"
    )


def _manifests(spark: SparkSession, pattern: str) -> dict[str, dict]:
    """Dataset root to manifest, by root, for every dataset the glob matches."""
    try:
        rows = (
            spark.read.text(f"{pattern.rstrip('/')}/{MANIFEST}")
            .select("value", F.col("_metadata.file_path").alias("path"))
            .collect()
        )
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        rows = []
    if not rows:
        raise DatasetError(f"No files found that match '{pattern}' and hold a dataset")
    return {unquote(r.path.rsplit(f"/{MANIFEST}/", 1)[0]): json.loads(r.value) for r in rows}


def _schema(entry: dict) -> T.StructType:
    schema = T.StructType.fromJson(entry["schema"])
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])


def open_dataset(
    spark: SparkSession, path: str, var_name_column: str | None = None, var_id_column: str | None = None
) -> Dataset:
    """The dataset in a folder. Column roles not given are detected from the var table."""
    found = _manifests(spark, path)
    if len(found) > 1:
        raise DatasetError(f"'{path}' matches {len(found)} datasets; open it as a collection")
    (root, manifest), = found.items()

    def load(kind: str) -> dict[str | None, DataFrame]:
        return {
            e["name"]: spark.read.schema(_schema(e)).parquet(_folder(root, kind, e["name"]))
            for e in manifest["components"]
            if e["kind"] == kind
        }

    single = {k: load(k).get(None) for k in ("obs", "var", "x", "uns", "raw_var", "raw_x")}
    raw = None
    if single["raw_var"] is not None:
        raw = Raw(single["raw_var"], single["raw_x"], manifest["raw_x_format"], load("raw_varm"))
    if single["var"] is not None and not (var_name_column and var_id_column):
        roles = detect_roles(single["var"])
        var_name_column = var_name_column or roles["var_name_column"]
        var_id_column = var_id_column or roles["var_id_column"]
    return Dataset(
        single["obs"], single["var"], single["x"], manifest["x_format"],
        *[load(k) for k in NAMED], single["uns"], raw, path, tuple(manifest["shape"]),
        var_name_column or INDEX_COLUMN, var_id_column or INDEX_COLUMN,
    )


def member_name(path: Column, depth: int) -> Column:
    """The dataset folder's name, from the path of one of its component files."""
    folder = F.element_at(F.split(path, "/"), -(1 + depth))
    return F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))


def open_collection(spark: SparkSession, pattern: str, var_name_column: str = INDEX_COLUMN) -> Collection:
    """All datasets whose folder matches the glob, in the order of their paths."""
    found = _manifests(spark, pattern)
    names = {root: root.rstrip("/").rsplit("/", 1)[-1] for root in found}
    if len(set(names.values())) < len(names):
        raise DatasetError(f"'{pattern}' matches datasets of the same name")
    grouped: dict[tuple, list[str]] = {}
    for root in sorted(found):
        for e in found[root]["components"]:
            key = (e["kind"], e["name"], json.dumps(e["schema"]), e["width"])
            grouped.setdefault(key, []).append(root)
    parts: dict[tuple[str, str | None], list[Part]] = {}
    for (kind, name, schema, width), roots in grouped.items():
        entry = {"schema": json.loads(schema)}
        rows = spark.read.schema(_schema(entry)).parquet(*[_folder(r, kind, name) for r in roots])
        file_name = member_name(F.col("_metadata.file_path"), 3 if name else 2)
        tagged = rows.select(file_name.alias(FILE), *[column(c) for c in rows.columns])
        members = tuple(sorted(names[r] for r in roots))
        parts.setdefault((kind, name), []).append(Part(tagged, members, width))
    return Collection(tuple(sorted(names.values())), parts, var_name_column)


def collection_views(col: Collection, alias: str, mode: str = "intersection") -> list[str]:
    """Temp views ``<alias>_<table>`` over a collection, each with ``_file_name``.

    A component is shown if every member has it; metadata if any has. X and layers are wide over
    the combined variables, which must not be none in intersection mode; ``<alias>_X_long`` holds
    the stored cells by name.
    """
    makers = {
        ("obs", None): lambda: many.harmonize_obs(col, mode),
        ("var", None): lambda: many.harmonize_var(col, mode),
        ("x", None): lambda: many.harmonize_x(col, mode),
        ("raw_var", None): lambda: many.harmonize_raw_var(col, mode),
        ("raw_x", None): lambda: many.harmonize_raw_x(col, mode),
        ("uns", None): lambda: many.harmonize_uns(col, mode),
    }
    named = {
        "layers": lambda n: many.harmonize_layer(col, n, mode), "obsm": lambda n: many.harmonize_obsm(col, n, mode),
        "varm": lambda n: many.harmonize_varm(col, n, mode), "raw_varm": lambda n: many.harmonize_raw_varm(col, n, mode),
        "obsp": lambda n: many.concat_obsp(col, n), "varp": lambda n: many.concat_varp(col, n),
    }
    needs = {"x": ("obs", "var"), "layers": ("obs", "var"), "obsm": ("obs",), "obsp": ("obs",), "varm": ("var",), "varp": ("var",), "raw_x": ("obs", "raw_var")}

    def everywhere(kind: str, name: str | None = None) -> bool:
        held = {m for p in col.parts.get((kind, name), []) for m in p.members}
        return bool(held) if kind == "uns" else held == set(col.members)

    frames = {}
    for kind, name in sorted(col.parts, key=lambda k: (k[0], k[1] or "")):
        if everywhere(kind, name) and all(everywhere(n) for n in needs.get(kind, ())):
            label = {"x": "X", "raw_x": "raw_X"}.get(kind, kind) + (f"_{name}" if name else "")
            frames[label] = named[kind](name) if name else makers[kind, name]()
    if "X" in frames:
        frames["X_long"] = many.harmonize_long(col, mode)
    for label, frame in frames.items():
        frame.createOrReplaceTempView(quoted(f"{alias}_{label}"))
    return [f"{alias}_{label}" for label in frames]


def create_views(ds: Dataset | Collection, alias: str, mode: str = "intersection") -> list[str]:
    """Temp views ``<alias>_<table>`` over every usable component, for SQL users.

    X and layers are wide whatever their number of variables; ``<alias>_X_long`` exists with X. Of a
    collection every view has ``_file_name``, and ``mode`` says how schemas are combined.
    """
    if isinstance(ds, Collection):
        return collection_views(ds, alias, mode)
    makers = {
        "obs": lambda: scan_obs(ds), "var": lambda: scan_var(ds), "info": lambda: dataset_info(ds),
        "uns": lambda: scan_uns(ds), "X": lambda: scan_x(ds), "raw_X": lambda: scan_raw_x(
            ds, name_column=detect_roles(ds.raw.var)["var_name_column"]
        ),
        "raw_var": lambda: scan_raw_var(ds),
    }
    by_prefix = {
        "obsm_": scan_obsm, "varm_": scan_varm, "obsp_": scan_obsp, "varp_": scan_varp,
        "layers_": scan_layer, "raw_varm_": scan_raw_varm,
    }
    created = []
    for table in table_names(ds):
        prefix = next((p for p in by_prefix if table.startswith(p)), None)
        frame = by_prefix[prefix](ds, table[len(prefix):]) if prefix else makers[table]()
        frame.createOrReplaceTempView(quoted(f"{alias}_{table}"))
        created.append(f"{alias}_{table}")
    if "X" in table_names(ds):
        scan_x_long(ds).createOrReplaceTempView(quoted(f"{alias}_X_long"))
        created.append(f"{alias}_X_long")
    return created
