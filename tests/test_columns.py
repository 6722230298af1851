from __future__ import annotations

from pyspark.sql import functions as F

from conftest import rows_of
from tallyfield.functions import columns as C
from tallyfield.functions import fixed_values as fixed


def one_column(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_clean_numeric(frame):
    cells = ["25000", "-50", "12.5", "", "abc", None]
    df = frame([(c,) for c in cells], "PINCP string")
    cleaned = C.clean_numeric(df, {"PINCP": "double"})
    assert one_column(cleaned, "PINCP") == [25000.0, -50.0, 12.5, None, None, None]


def test_parse_time(frame):
    df = frame([("2016-02-08 00:37:08.000000000",), ("bad",), (None,)], "t string")
    parsed = C.parse_time(df, ["t"]).select(F.date_format("t", "yyyy-MM-dd HH:mm:ss"))
    assert [r[0] for r in parsed.collect()] == ["2016-02-08 00:37:08", None, None]


def test_label(frame):
    df = frame([(1,), (2,), (3,), (None,)], "c int")
    assert one_column(df, C.label(F.col("c"), fixed.SEX)) == [
        "Male", "Female", "Unknown", "Unknown",
    ]


def test_label_of_float_codes(frame):
    df = frame([(1.0,), (6.0,), (7.0,)], "c float")
    assert one_column(df, C.label(F.col("c"), fixed.EMPLOYMENT)) == [
        "Employed - at work", "Not in labor force", "Unknown",
    ]


def test_bands(frame):
    ages = frame([(a,) for a in (17, 18, 25, 26, 56, None)], "a int")
    peer = C.bucketize(F.col("a"), fixed.PEER_AGE_BANDS, fixed.PEER_AGE_LAST)
    assert one_column(ages, peer) == ["Under 18", "18-25", "18-25", "26-35", "56+", None]
    ages = frame([(a,) for a in (10, 24, 25, 40, 60)], "a int")
    crash = C.bucketize(F.col("a"), fixed.ACCIDENT_AGE_BANDS, fixed.ACCIDENT_AGE_LAST)
    assert one_column(ages, crash) == ["18-24", "18-24", "25-39", "40-59", "60+"]
    miles = frame([(v,) for v in (0.99, 1.0, 4.99, 5.0)], "v double")
    seen = C.bucketize(F.col("v"), fixed.VISIBILITY_BANDS, fixed.VISIBILITY_LAST)
    assert one_column(miles, seen) == [
        "Low (<1 mi)", "Moderate (1-5 mi)", "Moderate (1-5 mi)", "High (>5 mi)",
    ]


def test_tier_and_flag(frame):
    df = frame([(100.0,), (100.1,), (None,)], "v double")
    assert one_column(df, C.tier(F.col("v"), 100, "hi", "lo")) == ["lo", "hi", "lo"]
    assert one_column(df, C.flag(F.col("v") > 100)) == [0, 1, 0]


def test_ratio_and_mean(frame):
    df = frame([(1, 2), (1, 0), (None, 4)], "a int, b int")
    assert one_column(df, C.ratio(F.col("a"), F.col("b"))) == [0.5, None, None]
    means = df.agg(C.mean_of(F.col("a")), C.mean_of(F.col("b")))
    assert rows_of(means) == [(1.0, 2.0)]
    assert rows_of(df.filter("a > 9").agg(C.mean_of(F.col("a")))) == [(None,)]


def test_or_zero(frame):
    df = frame([("3",), (None,), ("x",)], "v string")
    assert one_column(df, C.or_zero(F.col("v"))) == [3, 0, 0]
