from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tracelens.functions import (
    clamp,
    concat_key,
    label_missing,
    missing_if_equal,
    ratio,
    round_half_even,
    round_half_up,
    scale_round,
    split_key,
)


def one(spark, expr, schema="a double, b double, s string", data=None):
    data = data or [(1.005, 0.0, "x")]
    return spark.createDataFrame(data, schema).select(expr.alias("r")).collect()[0].r


def test_round_half_up_is_decimal_rounding(spark):
    assert one(spark, round_half_up("a", 2)) == 1.01
    assert one(spark, round_half_up("a", 2), data=[(-1.005, 0.0, "x")]) == -1.01
    assert one(spark, round_half_up("a", 0), data=[(2.5, 0.0, "x")]) == 3.0
    assert one(spark, round_half_even("a", 0), data=[(2.5, 0.0, "x")]) == 2.0
    assert one(spark, round_half_up("a", 2), data=[(None, 0.0, "x")]) is None


def test_scale_round(spark):
    assert one(spark, scale_round("a", 100, 4), data=[(0.123456789, 0.0, "x")]) == 12.3457


def test_ratio_and_clamp(spark):
    assert one(spark, ratio("a", "b")) is None  # division by zero is missing, not an error
    assert one(spark, ratio(F.lit(1), F.lit(4))) == 0.25
    assert one(spark, clamp(F.lit(5.0), F.lit(1.0), F.lit(3.0))) == 3.0
    assert one(spark, clamp(F.lit(-5.0), F.lit(1.0), F.lit(3.0))) == 1.0


def test_missing_labels(spark):
    df = spark.createDataFrame([(None,), ("",), ("0.5",)], "c string")
    got = sorted(r.r for r in df.select(label_missing("c").alias("r")).collect())
    assert got == ["0.5", "NA", "NA"]
    zero = spark.createDataFrame([(0,), (7,)], "c long")
    got = [r.r for r in zero.select(missing_if_equal("c", 0).alias("r")).collect()]
    assert got == [None, 7]


def test_composite_keys(spark):
    df = spark.createDataFrame([(3000000000, 7)], "job long, task long")
    k = df.select(concat_key("job", "task").alias("k"))
    assert k.collect()[0].k == "3000000000/7"
    back = k.select(split_key("k", 0).alias("j"), split_key("k", 1).alias("t")).collect()[0]
    assert (back.j, back.t) == ("3000000000", "7")


def test_rounding_fast_and_wide_paths_agree(spark):
    vals = [1.005, -1.005, 2.675, 999999999.995, 1e9 + 0.125, -3e12 - 0.5, 123456.78945, None]
    df = spark.createDataFrame([(v,) for v in vals], "a double")
    got = [r.r for r in df.select(round_half_up("a", 2).alias("r")).collect()]
    wide = [r.r for r in df.select(
        F.round(F.col("a").cast("decimal(38,8)"), 2).cast("double").alias("r")).collect()]
    assert got == wide
    assert got[:3] == [1.01, -1.01, 2.68]


def test_missing_if_equal_keeps_type(spark):
    df = spark.createDataFrame([(0, 1.5), (3, 0.0)], "i int, d double")
    out = df.select(missing_if_equal("i", 0).alias("i"), missing_if_equal("d", 0.0).alias("d"))
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["int", "double"]
    assert [tuple(r) for r in out.collect()] == [(None, 1.5), (3, None)]


def test_rounding_never_loses_a_value(spark):
    nan, inf = float("nan"), float("inf")
    vals = [nan, inf, -inf, 1e31, -1e31, 1.7e308, 1e28, 0.5]
    df = spark.createDataFrame([(v,) for v in vals], "a double")
    for rounder in (round_half_up, round_half_even):
        got = [r.r for r in df.select(rounder("a", 2).alias("r")).collect()]
        assert got[0] != got[0] and got[1:] == vals[1:]
        with pytest.raises(ValueError):
            rounder("a", 9)
    assert one(spark, round_half_up("a", 8), data=[(1.23456789012345, 0.0, "x")]) == 1.23456789
