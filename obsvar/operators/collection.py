"""Many datasets as one: harmonized tables and matrices with their provenance in ``_file_name``.

A collection keeps, per component, a list of *parts*. A part is a DataFrame that carries
``_file_name`` and covers every member with the same schema, so a thousand members written alike are
one scan and not a thousand-branch union. Schema algebra runs on the driver, on schemas only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsvar.functions.naming import column, quoted, with_unique_columns
from obsvar.functions.typing import as_type, common_type_of, merged_type, shared_type
from obsvar.model import INDEX_COLUMN, Components, Dataset, DatasetError
from obsvar.operators.scans import NO_UNS, vector_columns, wide_cells
from obsvar.operators.uns import flatten_struct
from obsvar.operators.variables import _suffixed, has_repeated_names, name_stems, unique_variable_names

FILE = "_file_name"
MODES = ("intersection", "union")


@dataclass(frozen=True)
class Part:
    """Rows of one component for the ``members`` (sorted names) that share its schema."""

    rows: DataFrame
    members: tuple[str, ...]
    width: int | None = None


@dataclass(frozen=True)
class Collection:
    members: tuple[str, ...]
    parts: Mapping[tuple[str, str | None], list[Part]] = field(default_factory=dict)
    var_name_column: str = INDEX_COLUMN

    @staticmethod
    def of(datasets: Mapping[str, Dataset], var_name_column: str = INDEX_COLUMN) -> Collection:
        """A collection of datasets at hand, in the order of their names."""
        if not datasets:
            raise DatasetError("No files found: a collection needs at least one dataset")
        parts: dict[tuple[str, str | None], list[Callable[[], Part]]] = {}

        def tagged(member: str, kind: str, name: str | None) -> Part:
            ds = datasets[member]
            held = getattr(ds.raw, kind.removeprefix("raw_")) if kind.startswith("raw_") else getattr(ds, kind)
            df = held[name] if name else held
            return Part(df.select(F.lit(member).alias(FILE), *map(column, df.columns)), (member,))

        for member in sorted(datasets):
            ds = datasets[member]
            found = [(k, None) for k in ("obs", "var", "x", "uns") if getattr(ds, k) is not None]
            found += [(k, n) for k in ("layers", "obsm", "varm", "obsp", "varp") for n in getattr(ds, k)]
            if ds.raw is not None:
                found += [(f"raw_{k}", None) for k in ("var", "x") if getattr(ds.raw, k) is not None]
                found += [("raw_varm", n) for n in ds.raw.varm]
            for key in found:
                parts.setdefault(key, []).append(partial(tagged, member, *key))
        made = {key: partial(lambda makers: [m() for m in makers], makers) for key, makers in parts.items()}
        return Collection(tuple(sorted(datasets)), Components(made), var_name_column)

    def component(self, kind: str, name: str | None = None) -> list[Part]:
        """The parts of a component; every member must have it."""
        found = self.parts.get((kind, name), [])
        have = {m for p in found for m in p.members}
        missing = [m for m in self.members if m not in have]
        if missing:
            label = f"{kind} '{name}'" if name else kind
            raise DatasetError(f"{label} not found in {', '.join(missing)}")
        return sorted(found, key=lambda p: p.members[0])


def _check_mode(mode: str) -> None:
    if mode not in MODES:
        raise DatasetError(f"invalid schema_mode '{mode}': use 'intersection' or 'union'")


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- tables -----------------------------------------------------------------------------------


def harmonized_schema(parts: Sequence[Part], index: str, mode: str) -> list[T.StructField]:
    """Columns of the combined table.

    Intersection: the first member's columns that all have. Union: columns in first-seen order.
    A column of differing types takes their common type.
    """
    _check_mode(mode)
    fixed = {FILE.lower(), index.lower()}
    by_part = [
        {f.name.lower(): f for f in p.rows.schema.fields if f.name.lower() not in fixed} for p in parts
    ]
    order = list(dict.fromkeys(k for fields in by_part for k in fields))
    if mode == "intersection":
        order = [k for k in order if all(k in fields for fields in by_part)]
        if not [k for k in order if k != INDEX_COLUMN]:
            raise DatasetError("the datasets have no metadata column in common: take schema_mode 'union'")
    out = []
    for key in order:
        having = [fields[key] for fields in by_part if key in fields]
        out.append(T.StructField(having[0].name, common_type_of(f.dataType for f in having)))
    return out


def harmonize_table(col: Collection, kind: str, index: str, mode: str) -> DataFrame:
    parts = [
        Part(with_unique_columns(p.rows), p.members, p.width) for p in col.component(kind)
    ]
    schema = harmonized_schema(parts, index, mode)
    frames = []
    for p in parts:
        own = {c.lower(): c for c in p.rows.columns}
        frames.append(
            p.rows.select(
                FILE,
                index,
                *[
                    (column(own[f.name.lower()]) if f.name.lower() in own else F.lit(None))
                    .cast(f.dataType)
                    .alias(f.name)
                    for f in schema
                ],
            )
        )
    return _stack(frames)


def harmonize_obs(col: Collection, mode: str = "intersection") -> DataFrame:
    """Observations of all members: ``_file_name, obs_idx`` and the combined metadata columns."""
    return harmonize_table(col, "obs", "obs_idx", mode)


def harmonize_var(col: Collection, mode: str = "intersection") -> DataFrame:
    """Variable rows of all members; the mode applies to columns, never to rows."""
    return harmonize_table(col, "var", "var_idx", mode)


# --- variables and matrices -------------------------------------------------------------------


def member_variables(col: Collection, name_column: str | None = None, raw: bool = False) -> DataFrame:
    """``(_file_name, var_idx, var_name)`` with repeats renamed inside each member first."""
    named = _named(col, name_column, raw)
    if has_repeated_names(named, [FILE]):
        return _renamed(named)
    return named.withColumnRenamed("name", "var_name")


def _named(col: Collection, name_column: str | None, raw: bool = False) -> DataFrame:
    chosen = name_column or (INDEX_COLUMN if raw else col.var_name_column)
    return _stack([variable_names_of(p, chosen) for p in col.component("raw_var" if raw else "var")])


def _renamed(named: DataFrame) -> DataFrame:
    unique = unique_variable_names(named, [FILE])
    return unique.select(FILE, "var_idx", F.col("unique_name").alias("var_name"))


def _variables_and_picks(
    col: Collection, mode: str, names: Sequence[str] | None, name_column: str | None, raw: bool = False
) -> tuple[DataFrame, list[str], list[int]]:
    """Variables of all members, the columns of a wide view, and the range of their indices.

    One small job in the common case. Where a member repeats a name that matters here, without
    regard to case, its names are made unique first and picked afterwards.
    """
    _check_mode(mode)
    named = _named(col, name_column, raw)
    key = F.lower("name").alias("key")
    per_member = named.groupBy(FILE, key).agg(
        F.count("*").alias("n"), F.min("name").alias("name"), F.min("var_idx").alias("var_idx")
    )
    if names is not None:
        stems = {s for n in names for s in name_stems(n.lower())}
        per_member = per_member.filter(F.col("key").isin(list(stems)))
    clashing = per_member.agg(F.bool_or((F.col("n") > 1) | (F.col("key") == "obs_idx")))
    clash = bool(clashing.first()[0])
    variables = _renamed(named) if clash else named.withColumnRenamed("name", "var_name")
    picked = pick_variables(col, variables, mode, names)
    asked = F.lower("var_name").isin([n.lower() for n in picked]) if names is not None else F.lit(True)
    low, high = variables.filter(asked).agg(F.min("var_idx"), F.max("var_idx")).first()
    return variables, picked, [] if low is None else [low, high]


def variable_names_of(part: Part, name_column: str) -> DataFrame:
    fallback = F.concat(F.lit("var_"), F.col("var_idx").cast("string"))
    own = {c.lower(): c for c in part.rows.columns}
    found = own.get(name_column.lower())
    name = fallback if found is None else F.coalesce(column(found).cast("string"), fallback)
    return part.rows.select(FILE, "var_idx", name.alias("name"))


def common_variables(col: Collection, variables: DataFrame, mode: str = "intersection") -> DataFrame:
    """``var_name`` rows of the combined matrix, with the place each name is first seen at."""
    _check_mode(mode)
    first = F.min(F.struct(FILE, "var_idx"))
    named = variables.groupBy("var_name").agg(
        F.count("*").alias("n_files"), first.alias("first_seen")
    )
    if mode == "intersection":
        named = named.filter(F.col("n_files") == len(col.members))
    return named


def pick_variables(
    col: Collection, variables: DataFrame, mode: str, names: Sequence[str] | None = None
) -> list[str]:
    """The variables of a wide view, in the order in which they are first seen.

    Named variables are looked up without regard to case. They must be in every member in
    intersection mode, in some member in union mode.
    """
    _check_mode(mode)
    if names is None:
        rows = common_variables(col, variables, mode).orderBy("first_seen").select("var_name").collect()
        if not rows:
            raise DatasetError("the datasets have no variable in common: name some, or take schema_mode 'union'")
        return [r.var_name for r in rows]
    picked = list({n.lower(): n for n in reversed(names)}.values())[::-1]
    key = F.lower("var_name").alias("key")
    have = variables.filter(key.isin([n.lower() for n in picked])).groupBy(key)
    found = {r.key: r.n for r in have.agg(F.count_distinct(FILE).alias("n")).collect()}
    needed = len(col.members) if mode == "intersection" else 1
    lacking = [n for n in picked if found.get(n.lower(), 0) < needed]
    if lacking:
        having = variables.filter(F.lower("var_name") == lacking[0].lower()).select(FILE).distinct()
        holders = {r[0] for r in having.limit(len(col.members)).collect()}
        without = [m for m in col.members if m not in holders]
        raise DatasetError(
            f"{len(lacking)} of the named variables are lacking ({mode}), first '{lacking[0]}', "
            f"not found in {len(without)} of {len(col.members)} datasets: {', '.join(map(repr, without[:5]))}"
        )
    return picked


def _cells(col: Collection, layer: str | None, raw: bool = False) -> DataFrame:
    parts = col.component("layers", layer) if layer else col.component("raw_x" if raw else "x")
    common = (
        common_type_of(p.rows.schema["value"].dataType for p in parts) if layer else T.DoubleType()
    )
    return _stack(
        [p.rows.select(FILE, "obs_idx", "var_idx", F.col("value").cast(common).alias("value")) for p in parts]
    )


def harmonize_long(
    col: Collection, mode: str = "intersection", layer: str | None = None,
    name_column: str | None = None,
) -> DataFrame:
    """Stored cells by name: ``_file_name, obs_idx, var_name, value``, over the combined variables."""
    _check_mode(mode)
    variables = member_variables(col, name_column)
    if mode == "intersection":
        kept = common_variables(col, variables, mode).select("var_name")
        variables = variables.join(kept, "var_name", "left_semi")
    return (
        _cells(col, layer)
        .join(variables, [FILE, "var_idx"])
        .select(FILE, "obs_idx", "var_name", "value")
    )


@dataclass(frozen=True)
class Slots:
    """The columns of a combined matrix: labels, ``(_file_name, var_idx, slot)``, and the cells by slot."""

    labels: list[str]
    places: DataFrame
    cells: DataFrame


def slotted(
    col: Collection, mode: str, names: Sequence[str] | None = None, layer: str | None = None,
    name_column: str | None = None, raw: bool = False,
) -> Slots:
    """Stored cells ``(_file_name, obs_idx, slot, value)`` of the variables of a combined matrix.

    Every member's variables are mapped to the slots 0, 1, ... of the columns in one join, in any
    case if names are asked for.
    """
    variables, picked, span = _variables_and_picks(col, mode, names, name_column, raw)
    labels = _suffixed(picked, {"obs_idx", FILE})
    by = (lambda c: F.lower(c)) if names is not None else F.col
    slots = variables.sparkSession.createDataFrame(
        [(n.lower() if names is not None else n, k) for k, n in enumerate(picked)], "_name string, slot bigint"
    )
    places = variables.withColumn("_name", by("var_name")).join(slots, "_name").select(FILE, "var_idx", "slot")
    cells = _cells(col, layer, raw)
    if span:  # lets the scan of stored cells skip row groups
        cells = cells.filter(F.col("var_idx").between(*span))
    return Slots(labels, places, cells.join(places, [FILE, "var_idx"]).select(FILE, "obs_idx", "slot", "value"))


#: Slots in one word of a presence bitmap.
WORD = 63
#: Words of all members' bitmaps up to which they are broadcast, 8 MB; else the wide rows meet them in a shuffle.
BROADCAST_WORDS = 1 << 20


def presence_bitmaps(places: DataFrame, n_slots: int) -> DataFrame:
    """``(_file_name, _has)``: a bit per slot that the member has, packed in words of ``WORD`` bits.

    Bits are joined by ``or`` within each word, map-side, and a member's words are laid in order
    beside the empty ones: linear in variables and words.
    """
    words = -(-n_slots // WORD)
    bit = F.expr(f"shiftleft(1L, cast(slot % {WORD} as int))")
    held = places.groupBy(FILE, F.expr(f"slot div {WORD}").alias("word")).agg(F.bit_or(bit).alias("bits"))
    every = places.select(FILE).distinct().select(FILE, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(words - 1).cast("bigint"))).alias("word"))
    filled = every.join(held, [FILE, "word"], "left").select(FILE, F.struct("word", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits")).alias("w"))
    ordered = F.array_sort(F.collect_list("w"))
    return filled.groupBy(FILE).agg(F.transform(ordered, lambda w: w["bits"]).alias("_has"))


def harmonize_x(
    col: Collection, mode: str = "intersection", names: Sequence[str] | None = None,
    layer: str | None = None, name_column: str | None = None, raw: bool = False,
) -> DataFrame:
    """Wide matrix of all members: ``_file_name, obs_idx`` and one column per variable.

    A variable a member has shows 0 where nothing is stored; one it does not have shows NULL. Names
    that differ by case between members are different variables, unless names are asked for: these
    match in any case. Columns whose names differ by case alone get suffixes like repeated names.
    """
    found = slotted(col, mode, names, layer, name_column, raw)
    cells = found.cells.withColumnRenamed("slot", "var_idx")
    axis = _stack([p.rows.select(FILE, "obs_idx") for p in col.component("obs")])
    keys = [FILE, "obs_idx"]
    columns = list(enumerate(found.labels))
    if mode == "intersection":
        return wide_cells(axis, cells, columns, keys)
    wide = wide_cells(axis, cells, columns, keys, fill_zero=False)
    presence = presence_bitmaps(found.places, len(columns))
    zero = f"cast(0 as {cells.schema['value'].dataType.simpleString()})"
    has = "(shiftright(get(_has, {}), {}) & 1) = 1"
    if len(col.members) * (len(columns) // WORD + 1) <= BROADCAST_WORDS:  # a row per member
        presence = F.broadcast(presence)
    return wide.join(presence, FILE, "left").selectExpr(
        *keys,
        *[f"if({has.format(i // WORD, i % WORD)}, coalesce({quoted(n)}, {zero}), null) as {quoted(n)}" for i, n in columns],
    )


def harmonize_layer(
    col: Collection, layer: str, mode: str = "intersection", names: Sequence[str] | None = None,
    name_column: str | None = None,
) -> DataFrame:
    """``harmonize_x`` on a layer every member has."""
    return harmonize_x(col, mode, names, layer, name_column)


# --- raw sections and metadata ---------------------------------------------------------------


def harmonize_raw_var(col: Collection, mode: str = "intersection") -> DataFrame:
    """Variables of the raw sections of all members; each must have one."""
    return harmonize_table(col, "raw_var", "var_idx", mode)


def harmonize_raw_x(
    col: Collection, mode: str = "intersection", names: Sequence[str] | None = None, name_column: str | None = None
) -> DataFrame:
    """``harmonize_x`` on the raw sections."""
    return harmonize_x(col, mode, names, None, name_column, raw=True)


def harmonize_raw_varm(col: Collection, name: str, mode: str = "intersection") -> DataFrame:
    return _harmonize_vectors(col, "raw_varm", "var_idx", name, mode)


def merged_trees(col: Collection, mode: str = "union") -> DataFrame | None:
    """``(_file_name, tree)``: the nested metadata of all members that hold it as a struct, as one type.

    Unlike trees are merged branch by branch: a leaf takes the common type of its members' leaves,
    a branch a member lacks is NULL. In intersection mode the branches all members have stay. None
    if no member holds a tree, or none of its branches is common.
    """
    _check_mode(mode)
    parts = [p for p in col.parts.get(("uns", None), []) if "tree" in p.rows.columns]
    if not parts:
        return None
    kinds = [p.rows.schema["tree"].dataType for p in sorted(parts, key=lambda p: p.members[0])]
    whole = reduce(merged_type if mode == "union" else lambda a, b: a and shared_type(a, b), kinds)
    if whole is None:
        return None
    return _stack(
        [p.rows.select(FILE, as_type(F.col("tree"), p.rows.schema["tree"].dataType, whole).alias("tree")) for p in parts]
    )


def harmonize_uns(col: Collection, mode: str = "union") -> DataFrame:
    """Metadata leaves of all members: ``_file_name, key, type, dtype, shape, value``.

    Members may hold a nested struct column ``tree`` or a table of leaves. Trees are merged first,
    so a key has one dtype in all of them; leaves in tables stay as they are. In intersection mode
    only keys that every member of the collection has are listed. A member without metadata has no
    rows; if none has any, the answer is one ``message`` row.
    """
    _check_mode(mode)
    parts = col.parts.get(("uns", None), [])
    if not parts:
        obs = next(iter(col.parts.values()))[0].rows
        return obs.sparkSession.createDataFrame([(NO_UNS,)], "message string")
    listed = [FILE, "key", "type", "dtype", "shape", "value"]
    trees = merged_trees(col)
    frames = [] if trees is None else [flatten_struct(trees, "tree").select(listed)]
    frames += [p.rows.select(listed) for p in parts if "tree" not in p.rows.columns]
    leaves = _stack(frames)
    if mode == "union":
        return leaves
    held = leaves.groupBy("key").agg(F.count_distinct(FILE).alias("n")).filter(F.col("n") == len(col.members))
    return leaves.join(held.select("key"), "key", "left_semi").select(listed)


# --- dense matrices and pairs -----------------------------------------------------------------


def _harmonize_vectors(col: Collection, kind: str, index: str, name: str, mode: str) -> DataFrame:
    _check_mode(mode)
    parts = col.component(kind, name)
    element = common_type_of(p.rows.schema["vec"].dataType.elementType for p in parts)
    if len(col.members) > 1:
        element = T.DoubleType()
    rows = _stack(
        [p.rows.select(FILE, index, F.col("vec").cast(T.ArrayType(element)).alias("vec")) for p in parts]
    )
    if all(p.width is not None for p in parts):
        widths = [p.width for p in parts]
        low, high = min(widths), max(widths)
    else:
        found = rows.agg(F.min(F.size("vec")).alias("low"), F.max(F.size("vec")).alias("high")).first()
        low, high = found.low or 0, found.high or 0
    return vector_columns(rows, [index], name, low if mode == "intersection" else high, [FILE])


def harmonize_obsm(col: Collection, name: str, mode: str = "intersection") -> DataFrame:
    """Observation vectors of all members: the smallest width, or the largest with a NULL tail."""
    return _harmonize_vectors(col, "obsm", "obs_idx", name, mode)


def harmonize_varm(col: Collection, name: str, mode: str = "intersection") -> DataFrame:
    return _harmonize_vectors(col, "varm", "var_idx", name, mode)


def _pairs(col: Collection, kind: str, name: str, axis: str) -> DataFrame:
    ends = [f"{axis}_1", f"{axis}_2"]
    return _stack(
        [
            p.rows.select(FILE, *ends, F.col("value").cast("float").alias("value"))
            for p in col.component(kind, name)
        ]
    )


def concat_obsp(col: Collection, name: str) -> DataFrame:
    """Observation pairs of all members; pairs stay inside their member."""
    return _pairs(col, "obsp", name, "obs_idx")


def concat_varp(col: Collection, name: str) -> DataFrame:
    return _pairs(col, "varp", name, "var_idx")
