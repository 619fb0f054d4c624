"""Text rendering of values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def bool_text(value: Column) -> Column:
    """``True`` / ``False`` as text, the way boolean metadata columns are shown."""
    return F.when(value, "True").when(~value, "False")


def _strip_zeros(text: Column) -> Column:
    return F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def general_number(value: Column) -> Column:
    """A double with six significant digits, in C's ``%.6g`` form.

    Java's ``%g`` keeps trailing zeros and switches to exponents elsewhere, so the digits come from
    ``%.5e`` and are laid out here. Rounding is half-up on the shortest decimal form of the double.
    """
    digits = F.format_string("%.5e", value)
    mantissa = F.substring_index(digits, "e", 1)
    exponent = F.substring_index(digits, "e", -1)
    power = exponent.cast("int")
    plain = _strip_zeros(digits.cast("decimal(38,18)").cast("string"))
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(value), "nan")
        .when(value == float("inf"), "inf")
        .when(value == float("-inf"), "-inf")
        .when(value == 0, "0")
        .when((power >= -4) & (power < 6), plain)
        .otherwise(F.concat(_strip_zeros(mantissa), F.lit("e"), exponent))
    )


def leaf_text(value: Column, data_type: T.DataType) -> Column:
    """A metadata leaf as text: floats by ``general_number``, booleans in lower case."""
    if isinstance(data_type, (T.DoubleType, T.FloatType, T.DecimalType)):
        return general_number(value.cast("double"))
    return value.cast("string")


def category_text(value: Column, data_type: T.DataType) -> Column:
    """A category as a label: whole numbers as they are, floats with six decimals."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.format_string("%.6f", value.cast("double"))
    return value.cast("string")
