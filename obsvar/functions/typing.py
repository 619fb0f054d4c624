"""Type lattice of harmonized columns and the dtype names shown to users."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Dtype names by Spark type.
DTYPE_NAMES = {
    "tinyint": "int8",
    "smallint": "int16",
    "int": "int32",
    "bigint": "int64",
    "float": "float32",
    "double": "float64",
    "boolean": "bool",
    "string": "string",
}


def common_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """The type two columns of one name take when their datasets are combined.

    Equal types stay; text wins over everything; a float on either side gives double; other
    number pairs give bigint; everything else becomes text. Spark's own set-operation rule is
    different (text and double give double, boolean and int fail), hence the explicit casts.
    """
    if left == right:
        return left
    numeric = isinstance(left, T.NumericType) and isinstance(right, T.NumericType)
    if not numeric:
        return T.StringType()
    fractional = (T.DoubleType, T.FloatType)
    if isinstance(left, fractional) or isinstance(right, fractional):
        return T.DoubleType()
    return T.LongType()


def common_type_of(types: Iterable[T.DataType]) -> T.DataType:
    return reduce(common_type, types)


def merged_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """The type two metadata trees share: structs field by field, in first-seen order, lists by element.

    Fields are one without regard to case, under the first name; leaves follow ``common_type``. A
    group on one side and a leaf on the other make text.
    """
    if isinstance(left, T.StructType) and isinstance(right, T.StructType):
        fields = {f.name.lower(): f for f in left.fields}
        for f in right.fields:
            held = fields.get(f.name.lower())
            kind = merged_type(held.dataType, f.dataType) if held else f.dataType
            fields[f.name.lower()] = T.StructField(held.name if held else f.name, kind)
        return T.StructType(list(fields.values()))
    if isinstance(left, T.ArrayType) and isinstance(right, T.ArrayType):
        return T.ArrayType(merged_type(left.elementType, right.elementType))
    return common_type(left, right)


def shared_type(left: T.DataType, right: T.DataType) -> T.DataType | None:
    """``merged_type`` of what both have; None where a struct would keep no field."""
    if isinstance(left, T.StructType) and isinstance(right, T.StructType):
        other = {f.name.lower(): f for f in right.fields}
        both = [(f, other[f.name.lower()]) for f in left.fields if f.name.lower() in other]
        kinds = [(f.name, shared_type(f.dataType, g.dataType)) for f, g in both]
        fields = [T.StructField(name, kind) for name, kind in kinds if kind is not None]
        return T.StructType(fields) if fields else None
    return merged_type(left, right)


def as_type(value: Column, held: T.DataType, wanted: T.DataType) -> Column:
    """``value`` of type ``held`` in the shape of ``wanted``, a merged type: missing branches are NULL."""
    if held == wanted:
        return value
    if isinstance(wanted, T.StructType) and isinstance(held, T.StructType):
        own = {f.name.lower(): f for f in held.fields}
        parts = []
        for f in wanted.fields:
            mine = own.get(f.name.lower())
            part = F.lit(None).cast(f.dataType) if mine is None else as_type(value[mine.name], mine.dataType, f.dataType)
            parts.append(part.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(wanted, T.ArrayType) and isinstance(held, T.ArrayType):
        return F.transform(value, lambda e: as_type(e, held.elementType, wanted.elementType))
    if isinstance(wanted, T.StringType) and isinstance(held, (T.StructType, T.ArrayType)):
        return F.to_json(value)
    return value.cast(wanted)


def dtype_name(data_type: T.DataType) -> str:
    while isinstance(data_type, T.ArrayType):
        data_type = data_type.elementType
    if isinstance(data_type, T.DecimalType):
        return "float64"
    return DTYPE_NAMES.get(data_type.simpleString(), data_type.simpleString())
