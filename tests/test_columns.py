"""Column functions on hand-written values."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratamart import functions as fn


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    rows = df.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()
    return [r.y for r in rows]


def test_blank_and_empty(spark):
    values = [" a ", "  ", "", None, "\t"]
    assert apply(spark, fn.blank_to_null, values) == ["a", None, None, None, "\t"]
    assert apply(spark, fn.empty_to_null, values) == [" a ", "  ", None, None, "\t"]


def test_tristate(spark):
    values = ["t", "F", " T ", "yes", "", None]
    assert apply(spark, fn.tristate, values) == [True, False, True, None, None, None]


def test_parse_date_multi(spark):
    values = [
        "2020-05-11", "23/9/2009", "23-9-2009", " 2020-05-11 ", "01/02/2020",
        "11 May", "", "32/9/2009", "2020-5-1", "2020-05-11 10:00", "29/2/2021", None,
    ]
    day = dt.date
    assert apply(spark, fn.parse_date_multi, values) == [
        day(2020, 5, 11), day(2009, 9, 23), day(2009, 9, 23), day(2020, 5, 11), day(2020, 2, 1),
        None, None, None, None, None, None, None,
    ]


def test_clean_currency(spark):
    values = ["$1,234.50", "64", "", "-5", "n/a", "1e3", None]
    expected = [Decimal("1234.5"), Decimal(64), None, Decimal(5), None, Decimal(13), None]
    assert apply(spark, fn.clean_currency, values) == expected


def test_malformed_numbers_fail_or_become_null(spark):
    with pytest.raises(PySparkException):
        apply(spark, lambda c: fn.typed(c, "int"), ["10.5"])
    with pytest.raises(PySparkException):
        apply(spark, fn.clean_currency, ["1.2.3"])
    assert apply(spark, lambda c: fn.typed(c, "int", on_bad="null"), ["10.5", " 7 "]) == [None, 7]


def test_unify_code(spark):
    values = ["10300", "300", "lga10300", " 10130 ", "123456", "abc", "", None]
    assert apply(spark, fn.unify_code, values) == [
        "LGA10300", "LGA00300", "LGA10300", "LGA10130", "LGA12345", None, None, None,
    ]


def test_name_key(spark):
    values = ["Canterbury-Bankstown", " north sydney ", "!!", None]
    assert apply(spark, fn.name_key, values) == ["CANTERBURYBANKSTOWN", "NORTHSYDNEY", "", None]


def test_month_start_and_period_label(spark):
    assert apply(spark, fn.month_start, [dt.date(2020, 5, 31)], "date") == [dt.date(2020, 5, 1)]
    values = ["02_1999", "10_2031", "00_1999", "20_1999", "Feb_1999", "02_199", "02__1999", " 02_1999"]
    assert apply(spark, fn.parse_period_label_column, values) == [
        dt.date(1999, 2, 1), dt.date(2031, 10, 1), *[None] * 6,
    ]


def test_ratios_round_half_away_from_zero(spark):
    df = spark.createDataFrame(
        [(1, 8, 0), (5, 0, 1), (-1, 8, 2), (2469, 200_000, 3), (None, 4, 4)],
        "part bigint, whole bigint, i int",
    )
    rows = df.select("i", fn.percent_of(F.col("part"), F.col("whole")).alias("p")).orderBy("i").collect()
    # 2469 / 200000 is 1.2345 percent: a tie at three places, kept exact
    assert [r.p for r in rows] == [Decimal("12.50"), None, Decimal("-12.50"), Decimal("1.23"), None]
    exact = df.where("i = 3").select(fn.percent_of(F.col("part"), F.col("whole"), 3).alias("p"))
    assert exact.first().p == Decimal("1.235")


def test_percent_change(spark):
    df = spark.createDataFrame(
        [(0, 3, 2), (1, 2, 0), (2, 2, None), (3, 1, 3)], "i int, now bigint, before bigint"
    )
    change = fn.percent_change(F.col("now"), F.col("before"))
    rows = df.select("i", change.alias("c")).orderBy("i").collect()
    assert [r.c for r in rows] == [Decimal(50), None, None, Decimal("-66.67")]


def test_layouts_are_one_pattern_whatever_their_groups(spark):
    layouts = [(r"^(\d{4})\.(\d{2})\.(\d{2})\z", "$1-$2-$3"), (r"^(\d{2})/(\d{2})/(\d{4})\z", "$3-$1-$2")]
    got = apply(spark, lambda c: fn.parse_date_multi(c, layouts), ["2020.05.11", "05/11/2020", "2020-05-11", "a\n2020.05.11", "\n"])
    assert got == [dt.date(2020, 5, 11), dt.date(2020, 5, 11), None, None, None]
