"""Nested free-form metadata: flattening, typed access and views of sub-trees."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsvar.functions.naming import quoted
from obsvar.functions.text import general_number, leaf_text
from obsvar.functions.typing import dtype_name

SEPARATOR = "/"
VALUE_TYPE = "struct<scalar: string, arr: array<string>>"


def _leaves(schema: T.StructType, path: tuple[str, ...]) -> Iterator[tuple[tuple[str, ...], T.DataType]]:
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            yield from _leaves(f.dataType, (*path, f.name))
        else:
            yield (*path, f.name), f.dataType


def _value(scalar: Column | None, arr: Column | None) -> Column:
    absent = F.lit(None)
    return F.struct(
        (absent if scalar is None else scalar).cast("string").alias("scalar"),
        (absent if arr is None else arr).cast("array<string>").alias("arr"),
    )


def _shape_text(sizes: Sequence[Column]) -> Column:
    return F.concat(F.lit("("), F.concat_ws(", ", *[s.cast("string") for s in sizes]), F.lit(")"))


def _struct_leaf(root: str, path: tuple[str, ...], data_type: T.DataType) -> tuple[Column, Column]:
    source = F.col(".".join(quoted(p) for p in (root, *path)))
    if not isinstance(data_type, T.ArrayType):
        kind, shape = F.lit("scalar"), F.lit("()")
        value = _value(leaf_text(source, data_type), None)
    else:
        sizes, flat, element = [F.size(source)], source, data_type.elementType
        first = F.get(source, 0)
        while isinstance(element, T.ArrayType):
            sizes.append(F.coalesce(F.size(first), F.lit(0)))
            first, flat, element = F.get(first, 0), F.flatten(flat), element.elementType
        kind, shape = F.lit("array"), _shape_text(sizes)
        leaf_type = element
        value = _value(None, F.transform(flat, lambda e: leaf_text(e, leaf_type)))
    leaf = F.struct(
        F.lit(SEPARATOR.join(path)).alias("key"),
        kind.alias("type"),
        F.lit(dtype_name(data_type)).alias("dtype"),
        shape.alias("shape"),
        value.alias("value"),
    )
    return source, leaf


def flatten_struct(df: DataFrame, root: str) -> DataFrame:
    """One row per leaf of a nested struct column: ``key, type, dtype, shape, value``.

    The schema is walked on the driver; the data goes through one projection and one explode.
    Other columns stay in front. Leaves that are NULL are not listed.
    """
    rest = [F.col(quoted(c)) for c in df.columns if c != root]
    pairs = [_struct_leaf(root, p, t) for p, t in _leaves(df.schema[root].dataType, ())]
    leaves = F.array(*[F.when(source.isNotNull(), leaf) for source, leaf in pairs])
    return df.select(*rest, F.explode(F.filter(leaves, lambda x: x.isNotNull())).alias("_l")).select(
        *rest, "_l.*"
    )


def _nesting(json_text: Column, opening: str, closing: str) -> Column:
    """Deepest nesting of a bracket kind in a JSON text, string contents left out."""
    bare = F.regexp_replace(json_text, r'"(?:\\.|[^"\\])*"', "")
    brackets = F.split(F.regexp_replace(bare, f"[^\\{opening}\\{closing}]", ""), "")
    depths = F.aggregate(
        brackets,
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("top")),
        lambda acc, b: F.struct(
            (acc["now"] + F.when(b == opening, 1).when(b == closing, -1).otherwise(0)).alias("now"),
            F.greatest(acc["top"], acc["now"] + F.when(b == opening, 1).otherwise(0)).alias("top"),
        ),
    )
    return depths["top"]


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def flatten_json(df: DataFrame, json_column: str) -> DataFrame:
    """``flatten_struct`` for JSON text of unknown shape, with the type of each leaf per row.

    One pass finds the deepest nesting; the objects are then opened level by level with the variant
    type, each level a narrow explode, and arrays are unrolled row by row of the nested lists.
    """
    text = F.col(quoted(json_column))
    levels = df.agg(
        F.coalesce(F.max(_nesting(text, "{", "}")), F.lit(0)).alias("objects"),
        F.coalesce(F.max(_nesting(text, "[", "]")), F.lit(0)).alias("arrays"),
    ).first()
    rest = [F.col(quoted(c)) for c in df.columns if c != json_column]
    frame = df.select(*rest, F.lit("").alias("key"), F.parse_json(text).alias("_v"))
    entry = "array<struct<k: string, v: variant>>"
    for _ in range(levels.objects):
        opened = F.transform(
            F.map_entries(F.col("_v").try_cast("map<string, variant>")),
            lambda e: F.struct(e["key"].alias("k"), e["value"].alias("v")),
        )
        itself = F.array(F.struct(F.lit(None).cast("string").alias("k"), F.col("_v").alias("v")))
        parts = F.when(_kind(F.col("_v")).startswith("OBJECT"), opened.cast(entry)).otherwise(itself)
        key = F.col("key")
        joined = F.when(F.col("_e.k").isNull(), key).otherwise(
            F.when(key == "", F.col("_e.k")).otherwise(F.concat(key, F.lit(SEPARATOR), F.col("_e.k")))
        )
        frame = frame.withColumn("_e", F.explode(parts)).select(
            *rest, joined.alias("key"), F.col("_e.v").alias("_v")
        )
    frame = frame.filter(F.col("_v").isNotNull() & (_kind(F.col("_v")) != "VOID"))
    is_array = _kind(F.col("_v")).startswith("ARRAY")
    items = F.when(is_array, F.col("_v").try_cast("array<variant>"))
    sizes = [F.size(items)]
    for _ in range(1, levels.arrays):
        # a level is unrolled if all its elements are arrays of one length; else they stay JSON text
        inner = F.transform(items, lambda e: F.size(e.try_cast("array<variant>")))
        arrays = F.forall(items, lambda e: F.coalesce(_kind(e).startswith("ARRAY"), F.lit(False)))
        nested = (F.size(items) > 0) & arrays & (F.array_min(inner) == F.array_max(inner))
        sizes.append(F.when(nested, F.get(inner, 0)))
        items = F.when(
            nested, F.flatten(F.transform(items, lambda e: e.try_cast("array<variant>")))
        ).otherwise(items)
    kinds = F.transform(F.when(is_array, items).otherwise(F.array("_v")), _kind)
    kinds = F.filter(kinds, lambda k: k.isNotNull() & (k != "VOID"))
    frame = frame.select(
        *rest, "key", "_v", is_array.alias("_is_array"), items.alias("_items"),
        F.when(is_array, _shape_text(sizes)).otherwise(F.lit("()")).alias("shape"),
        kinds.alias("_kinds"),
    )
    fraction = "^(DECIMAL|DOUBLE|FLOAT)"

    def rendered(v: Column) -> Column:
        return (
            F.when(_kind(v).rlike(fraction), general_number(v.try_cast("double")))
            .when(_kind(v).rlike("^(ARRAY|OBJECT)"), F.to_json(v))
            .otherwise(v.try_cast("string"))
        )

    def every(pattern: str) -> Column:
        return (F.size("_kinds") > 0) & F.forall("_kinds", lambda k: k.rlike(pattern))

    # the type that holds all elements
    dtype = (
        F.when(every("^BIGINT$"), "int64").when(every(f"^BIGINT$|{fraction}"), "float64").when(every("^BOOLEAN$"), "bool")
        .otherwise("string")
    )
    return frame.select(
        *rest,
        "key",
        F.when(F.col("_is_array"), "array").otherwise("scalar").alias("type"),
        dtype.alias("dtype"),
        "shape",
        F.struct(
            F.when(~F.col("_is_array"), rendered(F.col("_v"))).alias("scalar"),
            F.transform("_items", rendered).alias("arr"),
        ).alias("value"),
    )


def value_tag(value: Column) -> Column:
    """Which variant a leaf value holds: ``scalar`` or ``arr``."""
    return F.when(value["arr"].isNotNull(), "arr").when(value["scalar"].isNotNull(), "scalar")


def access(leaves: DataFrame) -> DataFrame:
    """Leaves with their tag, scalar text and array length side by side."""
    value = F.col("value")
    rest = [c for c in leaves.columns if c != "value"]
    return leaves.select(
        *rest,
        value_tag(value).alias("tag"),
        value["scalar"].alias("scalar"),
        F.when(value["arr"].isNotNull(), F.size(value["arr"])).alias("arr_len"),
    )


def under(prefix: str) -> Column:
    return F.col("key").startswith(prefix.rstrip(SEPARATOR) + SEPARATOR)


def tree(leaves: DataFrame, id_columns: Sequence[str] = ()) -> DataFrame:
    """Every node, inner ones included: ``path, parent_path, name, node_type, dtype, shape``."""
    parts = F.split("key", SEPARATOR)
    depth = F.size(parts)
    nodes = leaves.select(
        *id_columns,
        F.explode(F.sequence(F.lit(1), depth)).alias("_n"),
        parts.alias("_parts"),
        "dtype",
        "shape",
    )
    leaf = F.col("_n") == F.size("_parts")
    return (
        nodes.select(
            *id_columns,
            F.array_join(F.slice("_parts", F.lit(1), F.col("_n")), SEPARATOR).alias("path"),
            F.array_join(F.slice("_parts", F.lit(1), F.col("_n") - 1), SEPARATOR).alias("parent_path"),
            F.get("_parts", F.col("_n") - 1).alias("name"),
            F.when(leaf, "dataset").otherwise("group").alias("node_type"),
            F.when(leaf, F.col("dtype")).alias("dtype"),
            F.when(leaf, F.col("shape")).alias("shape"),
        )
        .distinct()
    )


def scalars(leaves: DataFrame, prefix: str) -> DataFrame:
    """Scalar leaves below ``prefix``: the other columns plus ``key, value``."""
    rest = [c for c in leaves.columns if c not in ("key", "type", "dtype", "shape", "value")]
    return leaves.filter((F.col("type") == "scalar") & under(prefix)).select(
        *rest, "key", F.col("value.scalar").alias("value")
    )


def array_rows(leaves: DataFrame, key: str) -> DataFrame:
    """One array leaf as rows ``(index, value)``."""
    rest = [c for c in leaves.columns if c not in ("key", "type", "dtype", "shape", "value")]
    return leaves.filter((F.col("key") == key) & (F.col("type") == "array")).select(
        *rest, F.posexplode("value.arr").alias("index", "value")
    )


def parallel_table(
    leaves: DataFrame, prefix: str, columns: Sequence[str], id_columns: Sequence[str] = ()
) -> DataFrame:
    """Equally long arrays of one group as the columns of a table, one row per position.

    The arrays of a group are few and named by the caller; they meet in one aggregation per dataset.
    """
    keys = [f"{prefix.rstrip(SEPARATOR)}{SEPARATOR}{c}" for c in columns]
    grouped = leaves.filter(F.col("key").isin(keys)).groupBy(*id_columns).agg(
        *[F.max(F.when(F.col("key") == k, F.col("value.arr"))).alias(c) for k, c in zip(keys, columns)]
    )
    zipped = F.arrays_zip(*[F.col(quoted(c)) for c in columns])
    same = F.lit(True)
    for c in columns[1:]:
        same = same & (F.size(F.col(quoted(c))) == F.size(F.col(quoted(columns[0]))))
    checked = F.when(same, zipped).otherwise(
        F.raise_error(F.lit(f"arrays below {prefix} differ in length"))
    )
    return grouped.select(*id_columns, F.posexplode(checked).alias("index", "_row")).select(
        *id_columns, "index", "_row.*"
    )


def subtree_json(df: DataFrame, root: str, path: Sequence[str] = ()) -> DataFrame:
    """A sub-tree of the nested struct column as one JSON text per dataset."""
    rest = [F.col(quoted(c)) for c in df.columns if c != root]
    node = F.col(".".join(quoted(p) for p in (root, *path)))
    return df.select(*rest, F.to_json(node).alias("json"))
