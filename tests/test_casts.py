"""The pattern in front of a cast must never turn away what the cast accepts."""

import random

import pytest
from pyspark.sql import functions as F

from snapmill.functions import casts

PIECES = [
    *"0123456789", *"0123456789", "+", "-", ".", "e", "E", "d", "F", "x", "p", " ", "\t", "\n", "\x7f",
    "\x00", " ", "_", ",", "/", ":", "T", "NaN", "nan", "inf", "Infinity", "-Inf", "0x1.8p1",
    "2024-01-31", "2024", "12", "1e3", "3.7", "é", "n/a",
]


def _texts():
    pick = random.Random(7)
    return ["", *PIECES] + ["".join(pick.choices(PIECES, k=pick.randint(1, 5))) for _ in range(20_000)]


@pytest.mark.parametrize("type_name", [casts.COUNT, casts.AMOUNT, casts.WIDE, casts.DATE])
def test_parse_equals_try_cast(spark, type_name):
    texts = spark.createDataFrame([(t,) for t in _texts()], "t string")
    both = texts.select(
        "t",
        casts.parse(F.col("t"), type_name).cast("string").alias("guarded"),
        F.col("t").try_cast(type_name).cast("string").alias("plain"),
    )
    assert both.where("plain IS NOT NULL").count() > 100
    assert both.where("NOT guarded <=> plain").collect() == []


def test_whole_digits_only_for_direct_ints(either_mode):
    df = either_mode.createDataFrame(
        [("3",), (" 3 ",), ("3.0",), ("1e3",), ("",), ("x",), ("99999999999",), (None,)], "t string"
    )
    got = [r[0] for r in df.select(casts.as_type(F.col("t"), "int", True)).collect()]
    assert got == [3, 3, None, None, None, None, None, None]


def test_measured_ints_truncate_toward_zero(either_mode):
    df = either_mode.createDataFrame(
        [("3.0",), ("3.7",), ("-3.7",), ("1e3",), ("3e9",), ("NaN",), ("abc",), (None,)], "t string"
    )
    got = [r[0] for r in df.select(casts.as_measured(F.col("t"), "int", True)).collect()]
    assert got == [3, 3, -3, 1000, None, None, None, None]


def test_numbers_need_no_pattern(either_mode):
    df = either_mode.createDataFrame([(3.7,), (None,), (float("nan"),)], "v double")
    got = [r[0] for r in df.select(casts.as_measured(F.col("v"), "int", False)).collect()]
    assert got == [3, None, None]
