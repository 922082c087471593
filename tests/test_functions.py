"""Scalar semantics on literal rows (cases the driver tables cannot reach)."""

import datetime as dt
import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import scalars as S


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {typ}")


def test_year_is_calendar_week_is_iso(spark):
    df = one_col(spark, [dt.date(2018, 12, 31), dt.date(2019, 1, 1), dt.date(2021, 1, 1)], "date")
    got = df.select(
        S.calendar_year("v").alias("y"), S.iso_week("v").alias("w"), F.to_date(S.week_start("v")).alias("ws")
    ).collect()
    assert [tuple(r) for r in got] == [
        (2018, 1, dt.date(2018, 12, 31)),
        (2019, 1, dt.date(2018, 12, 31)),
        (2021, 53, dt.date(2020, 12, 28)),
    ]


def test_strict_timestamp_pattern(spark):
    bad = ["2018-07-07", "2018-7-7 1:2:3", "2018-07-07 22:09:11.5", " 2018-07-07 22:09:11", "", "bad", None]
    df = one_col(spark, bad + ["2018-07-07 22:09:11"])
    got = [r[0] for r in df.select(S.parse_timestamp("v")).collect()]
    assert got[:-1] == [None] * len(bad)
    assert got[-1] == dt.datetime(2018, 7, 7, 22, 9, 11)
    assert df.select(S.parse_date("v")).collect()[-1][0] == dt.date(2018, 7, 7)


def test_list_separator_is_comma_space(spark):
    df = one_col(spark, ["a,b, c", "", None])
    got = [r[0] for r in df.select(S.split_list("v")).collect()]
    assert got == [["a,b", "c"], [""], None]
    exploded = df.select(F.explode(S.split_list("v")).alias("x")).collect()
    assert [r.x for r in exploded] == ["a,b", "c", ""]


def test_trim_strips_spaces_only(spark):
    df = one_col(spark, ["\t a", "   ", " b1 "])
    assert [r[0] for r in df.select(S.ascii_trim("v")).collect()] == ["\t a", "", "b1"]


def test_tolerant_casts(spark):
    df = one_col(spark, ["abc", "3.7", "3000000000", "-2.5", None])
    got = [r[0] for r in df.select(S.tolerant_cast("v", "int", T.StringType())).collect()]
    assert got == [None, 3, None, -2, None]
    big = spark.createDataFrame([(3000000000,), (7,)], "v bigint")
    assert [r[0] for r in big.select(S.tolerant_cast("v", "int", T.LongType())).collect()] == [None, 7]


def test_star_range_rejects_nan_and_null(spark):
    df = one_col(spark, [0.0, 5.0, 5.5, -0.5, float("nan"), None], "double")
    kept = [r[0] for r in df.filter(F.col("v").between(0, 5)).collect()]
    assert kept == [0.0, 5.0]


def test_round_half_up_on_decimal_text(spark):
    df = spark.createDataFrame([(23.0, 40.0), (1.005, 1.0)], "a double, b double")
    got = [r[0] for r in df.select(S.round2(F.col("a") / F.col("b"))).collect()]
    assert got == [0.58, 1.01]


def test_ratio_null_on_zero_or_null(spark):
    df = spark.createDataFrame([(5, 0), (5, None), (5, 2)], "a bigint, b int")
    assert [r[0] for r in df.select(S.safe_ratio("a", "b")).collect()] == [None, None, 2.5]


def test_star_category_edges(spark):
    df = one_col(spark, [4.0, 3.99, 2.5, 2.49, None], "double")
    got = [r[0] for r in df.select(S.star_category("v")).collect()]
    assert got == ["High", "Medium", "Medium", "Low", "Low"]


def test_exact_mean_of_hundredths(spark):
    # 3.675 exactly halfway: HALF_UP gives 3.68 whatever the summation order.
    rows = [(1, 3.67), (1, 3.68), (2, 0.1), (2, 0.2), (2, 0.4), (3, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {
        r.g: (r.r, r.m)
        for r in df.groupBy("g")
        .agg(S.avg_hundredths_rounded("v").alias("r"), S.avg_hundredths("v").alias("m"))
        .collect()
    }
    assert got[1][0] == 3.68
    assert got[2][0] == 0.23 and math.isclose(got[2][1], 0.7 / 3)
    assert got[3] == (None, None)
