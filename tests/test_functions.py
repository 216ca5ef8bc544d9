import math
import sys
import unicodedata
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tradewind.functions.numbers import safe_double, safe_long
from tradewind.functions.text import (
    _accent_table,
    map_values,
    replace_if_contains,
    strip_accents,
)
from tradewind.functions.timestamps import floor_days, late_flag, parse_named_timestamps, to_ts, whole_days


def one(df):
    return [r[0] for r in df.collect()]


def test_text_timestamps(spark):
    df = spark.createDataFrame(
        [("10/2/2017 10:56",), ("10/02/2017 1:05",), ("2017-10-02 10:56:00",), ("",), (None,)], "t string"
    )
    assert one(df.select(to_ts(df, "t"))) == [datetime(2017, 10, 2, 10, 56), datetime(2017, 10, 2, 1, 5), None, None, None]
    assert one(df.select(to_ts(df, "t", fmt=None)))[2] == datetime(2017, 10, 2, 10, 56)


@pytest.mark.parametrize(
    "sql, expected",
    [
        ("1506941760999L", datetime(2017, 10, 2, 10, 56)),
        ("-1500L", datetime(1969, 12, 31, 23, 59, 59)),
        ("timestamp_ntz'2017-10-02 10:56:01'", datetime(2017, 10, 2, 10, 56, 1)),
        ("timestamp'2017-10-02 10:56:01'", datetime(2017, 10, 2, 10, 56, 1)),
        ("date'2017-10-02'", datetime(2017, 10, 2)),
        ("1506941760.0D", datetime(2017, 10, 2, 10, 56)),
    ],
)
def test_typed_timestamps(spark, sql, expected):
    df = spark.sql(f"SELECT {sql} AS t")
    assert one(df.select(to_ts(df, "t"))) == [expected]


def test_only_named_text_columns_are_parsed(spark):
    df = spark.createDataFrame([("1/2/2018 3:04", "1/2/2018 3:04", "x")], "some_date string, order_approved_at string, note string")
    assert parse_named_timestamps(df).first() == (datetime(2018, 1, 2, 3, 4), "1/2/2018 3:04", "x")


@pytest.mark.parametrize("hours, whole, floored, late", [(-36, -1, -2, 0), (12, 0, 0, 0), (24, 1, 1, 1), (-24, -1, -1, 0), (None, None, None, 0)])
def test_day_differences(spark, hours, whole, floored, late):
    df = spark.createDataFrame([(hours,)], "h int").select(
        F.lit(datetime(2018, 1, 10)).alias("a"),
        (F.lit(datetime(2018, 1, 10)) + F.make_interval(hours=F.col("h"))).alias("b"),
    )
    days = floor_days(F.col("a"), F.col("b"))
    assert tuple(df.select(whole_days(F.col("a"), F.col("b")), days, late_flag(days)).first()) == (whole, floored, late)


def test_safe_numbers(spark):
    texts = ["12", "12.75", "-3.9", "", None, "x", "nan", "inf", " 7 ", "1e3"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(safe_double(F.col("t")).alias("d"), safe_long(F.col("t")).alias("n")).collect()
    assert [r.n for r in got] == [12, 12, -3, 0, 0, 0, 0, 0, 7, 1000]
    assert [r.d for r in got][:6] == [12.0, 12.75, -3.9, 0.0, 0.0, 0.0]
    assert math.isnan(got[6].d) and math.isinf(got[7].d)


def bare(text):
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def test_strip_accents_equals_nfkd_on_every_single_letter_form(spark):
    source, target = _accent_table()
    assert len(source) > 2000
    letters = [source[i : i + 500] for i in range(0, len(source), 500)]
    df = spark.createDataFrame([(t,) for t in letters], "t string")
    for row in df.select("t", strip_accents(F.col("t")).alias("p")).collect():
        assert row.p == bare(row.t)


def test_strip_accents_variants(spark):
    df = spark.createDataFrame([("São Paulo",), ("é",), ("ﬁ ½",), (None,), ("ß ø",)], "t string")
    assert one(df.select(strip_accents(F.col("t")))) == ["Sao Paulo", "e", "ﬁ ½", None, "ß ø"]


def test_value_rules(spark):
    df = spark.createDataFrame([("ab",), ("abc",), ("x",), (None,)], "t string")
    # The second rule sees what the first one made.
    assert one(df.select(replace_if_contains(F.col("t"), {"b": "zz", "z": "q"}))) == ["q", "q", "x", None]
    assert one(df.select(map_values(F.col("t"), {"ab": "1"}))) == ["1", "abc", "x", None]
