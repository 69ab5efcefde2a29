"""Date-time parsing."""

import datetime as dt

import pytest

from labrelay.functions.times import parse_lenient, parse_strict
from pyspark.sql import functions as F


def run(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    v, e = fn(F.col("s"))
    return [(r.v, r.e) for r in df.select(v.alias("v"), e.alias("e")).collect()]


LENIENT = [
    ("202403051015", dt.datetime(2024, 3, 5, 10, 15)),
    ("20240305101530", dt.datetime(2024, 3, 5, 10, 15, 30)),
    ("2024030510", dt.datetime(2024, 3, 5, 10)),
    ("20240305", dt.datetime(2024, 3, 5)),
    ("20240230101530", dt.datetime(2024, 2, 29, 10, 15, 30)),  # day clamped to month end
    ("20230231", dt.datetime(2023, 2, 28)),
    ("20240305240000", dt.datetime(2024, 3, 6)),  # 24:00 is next midnight
]
LENIENT_ERRORS = ["2024", "202403", "202403051", "20240305101", "2024030510153", "202403051015301",
                  "20240305101530.1", "20240305101530.123", "2024030510153012345", "20241305", "20240332",
                  "2024030525", "202403051060", "abcdefgh", "00000101"]


@pytest.mark.parametrize("s,expected", LENIENT)
def test_lenient_parses(spark, s, expected):
    assert run(spark, parse_lenient, [s]) == [(expected, None)]


@pytest.mark.parametrize("s", LENIENT_ERRORS)
def test_lenient_errors(spark, s):
    (v, e), = run(spark, parse_lenient, [s])
    assert v is None and e is not None and s in e


def test_null_and_empty_are_null_without_error(spark):
    assert run(spark, parse_lenient, [None, ""]) == [(None, None), (None, None)]
    assert run(spark, parse_strict, [None, ""]) == [(None, None), (None, None)]


def test_strict_needs_14_chars(spark):
    out = run(spark, parse_strict, ["20240305101530", "202403051015", "20240305", "20240230101530"])
    assert out[0] == (dt.datetime(2024, 3, 5, 10, 15, 30), None)
    assert out[1][0] is None and out[1][1] is not None
    assert out[2][0] is None and out[2][1] is not None
    assert out[3] == (dt.datetime(2024, 2, 29, 10, 15, 30), None)
