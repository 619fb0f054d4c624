"""Categorical columns and record columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsvar.functions.naming import column, with_unique_columns
from obsvar.functions.text import category_text
from obsvar.operators.numbering import assign_index


def categorical_encode(df: DataFrame, index: str, value: str) -> tuple[DataFrame, DataFrame]:
    """``codes(idx, code int)`` and ``categories(code int, label)``: labels sorted, NULL is -1."""
    labels = df.select(column(value).alias("label")).filter("label is not null").distinct()
    categories = assign_index(labels, ["label"], "code").select(
        F.col("code").cast("int").alias("code"), "label"
    )
    codes = (
        df.select(column(index).alias("idx"), column(value).alias("label"))
        .join(categories, "label", "left")
        .select("idx", F.coalesce("code", F.lit(-1)).alias("code"))
    )
    return codes, categories


def categorical_decode(codes: DataFrame, categories: DataFrame, out: str = "label") -> DataFrame:
    """``(idx, label)``: the label of each code as text; codes outside the categories give NULL.

    Spark broadcasts the categories when their size allows and splits a hot code otherwise.
    """
    label_type = categories.schema["label"].dataType
    labels = categories.select("code", category_text(F.col("label"), label_type).alias(out))
    return codes.join(labels, "code", "left").select("idx", out)


def record_flatten(df: DataFrame, record: str) -> DataFrame:
    """The fields of a struct column as columns of the table."""
    rest = [column(c) for c in df.columns if c != record]
    return with_unique_columns(df.select(*rest, f"{record}.*"))
