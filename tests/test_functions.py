"""Column functions against the edge cases of the reference's rules."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar.functions import dates, text
from lakestar.functions.conform import cast_to


def one_col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_initcap_words_are_alphanumeric_runs(spark):
    got = one_col(spark, ["o'brien-smith mcDONALD", "5-low", "5low", "", None], text.initcap_alnum)
    assert got == ["O'Brien-Smith Mcdonald", "5-Low", "5low", "", None]


def test_genre_first_part_not_retrimmed(spark):
    assert one_col(spark, ["  Drama , Comedy", "Solo"], text.genre_label) == ["Drama ", "Solo"]


def test_device_and_os_labels(spark):
    assert one_col(spark, [" mobile-x", "SmartTV LG", "tablet", "web", "console"], text.device_type_label) == \
        ["Mobile", "SmartTV", "Tablet", "Web", None]
    assert one_col(spark, ["IOS", "chromeOS", "webos", "android 14", "Tizen", "other"], text.os_label) == \
        ["iOS", "Chrome", "WebOS", "Android", "Tizen", None]


def test_event_label_alias(spark):
    assert one_col(spark, [" subscribe", "renew", "Cancel"], text.event_type_label) == ["SIGNUP", "RENEW", "CANCEL"]


def test_signup_date_styles(spark):
    got = one_col(spark, ["2024-01-05", "2024-01-05 12:00", "1/5/2024", "n/a", "02/30/2024", "2024-01-05garbage",
                          None], dates.iso_or_us_date)
    d = dt.date(2024, 1, 5)
    assert got == [d, d, d, None, None, None, None]


def test_trailing_garbage_and_newlines_are_no_dates(spark):
    bad = ["2024-01-05 garbage", "2024-01-05Tgarbage", "2024-02-30", "2024-01-05 25:00:00"]
    assert one_col(spark, bad, dates.text_to_date) == [None] * 4
    assert one_col(spark, bad, dates.iso_or_us_date) == [None] * 4
    good = ["2024-01-05", "2024-01-05 10:11:12", "2024-01-05T10:11:12.5Z"]
    assert one_col(spark, good, dates.text_to_date) == [dt.date(2024, 1, 5)] * 3
    assert one_col(spark, ["2024-01-05\n", "2024-01-05"], dates.strict_iso_date) == [None, dt.date(2024, 1, 5)]
    assert one_col(spark, ["1/5/2024\n"], dates.iso_or_us_date) == [None]
    assert one_col(spark, ["2024-01-05T10:11:12.123456Z\n"], dates.strict_iso_timestamp) == [None]


def test_strict_timestamp_needs_full_pattern(spark):
    got = one_col(spark, ["2024-01-05", "2024-01-05T10:11:12.123456Z"], dates.strict_iso_timestamp)
    assert got == [None, dt.datetime(2024, 1, 5, 10, 11, 12, 123456)]


def test_us_date_with_time_is_midnight(spark):
    got = one_col(spark, ["1/5/2024 10:11", "2024-01-06", "x"], dates.iso_or_us_timestamp)
    assert got == [dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6), None]


def test_strict_date_is_anchored(spark):
    assert one_col(spark, ["2024-01-05 12:00", "2024-01-05"], dates.strict_iso_date) == [None, dt.date(2024, 1, 5)]


def test_float_to_int_rounds_half_even(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (2.7,), (-2.5,)], "v double")
    got = [r[0] for r in df.select(cast_to(F.col("v"), T.DoubleType(), T.IntegerType())).collect()]
    assert got == [2, 4, 3, -2]
    df = spark.createDataFrame([("2.5",), ("7",), ("x",)], "v string")
    got = [r[0] for r in df.select(cast_to(F.col("v"), T.StringType(), T.LongType())).collect()]
    assert got == [2, 7, None]


def test_iso_weekday_and_date_key(spark):
    df = spark.createDataFrame([(dt.date(2024, 5, 5),)], "d date")
    r = df.select(dates.iso_day_of_week("d").alias("dow"), dates.date_key("d").alias("k"),
                  dates.month_name("d").alias("m")).first()
    assert (r.dow, r.k, r.m) == (7, 20240505, "May")
