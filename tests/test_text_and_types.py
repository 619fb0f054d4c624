import math
import random

import pytest
from obsvar.functions.naming import metadata_names, with_unique_columns
from obsvar.functions.text import bool_text, category_text, general_number
from obsvar.functions.typing import common_type, dtype_name
from pyspark.sql import functions as F
from pyspark.sql import types as T


def test_general_number_matches_c_format(spark):
    rng = random.Random(7)
    values = [0.0, 1.0, 0.1, 100000.0, 999999.5, 1e6, 1234567.8, 0.0001, 0.00001234, 1e-300, -2.5, 1 / 3,
              math.pi * 1e10, 123456.7, 9.999995e5, 50.0, -1e-5]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-12, 12) for _ in range(400)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.t for r in df.select(general_number(F.col("v")).alias("t")).collect()]
    assert got == ["%.6g" % v for v in values]


def test_special_numbers_and_null(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "v double")
    assert [r.t for r in df.select(general_number(F.col("v")).alias("t")).collect()] == [
        "nan", "inf", "-inf", None,
    ]


def test_bool_and_category_text(spark):
    df = spark.createDataFrame([(True, 1.5, 7), (None, 2.0, 8)], "b boolean, d double, i int")
    got = df.select(
        bool_text(F.col("b")), category_text(F.col("d"), T.DoubleType()), category_text(F.col("i"), T.IntegerType())
    ).collect()
    assert [tuple(r) for r in got] == [("True", "1.500000", "7"), (None, "2.000000", "8")]


@pytest.mark.parametrize(
    "left,right,want",
    [
        (T.IntegerType(), T.IntegerType(), T.IntegerType()),
        (T.IntegerType(), T.StringType(), T.StringType()),
        (T.ByteType(), T.IntegerType(), T.LongType()),
        (T.FloatType(), T.IntegerType(), T.DoubleType()),
        (T.FloatType(), T.FloatType(), T.FloatType()),
        (T.FloatType(), T.DoubleType(), T.DoubleType()),
        (T.BooleanType(), T.IntegerType(), T.StringType()),
    ],
)
def test_type_lattice(left, right, want):
    assert common_type(left, right) == want == common_type(right, left)


def test_names():
    assert metadata_names(["a", "A", "a_", "b"]) == ["a", "A_", "a__", "b"]
    assert dtype_name(T.ArrayType(T.ArrayType(T.FloatType()))) == "float32"


def test_clashing_columns_are_renamed(spark):
    df = spark.range(1).select(F.lit(1).alias("x"), F.lit(2).alias("X"), F.lit(3).alias("x"))
    assert with_unique_columns(df).columns == ["x", "X_", "x__"]
