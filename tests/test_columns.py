from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stallwise.functions import columns as fn


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def test_calendar_days_count_midnights(spark):
    assert value(spark, fn.calendar_days(at("2020-01-01 23:59:00"), at("2020-01-02 00:01:00"))) == 1
    assert value(spark, fn.calendar_days(at("2020-01-02 00:01:00"), at("2020-01-01 23:59:00"))) == -1
    assert value(spark, fn.calendar_days(F.lit(None).cast("timestamp_ntz"), at("2020-01-02"))) is None


def test_late_on_the_promised_day(spark):
    promised, delivered = at("2020-03-01 00:00:00"), at("2020-03-01 10:00:00")
    assert value(spark, fn.late_flag(F.lit(1), promised, delivered)) == 1
    assert value(spark, fn.delay_days(F.lit(1), promised, delivered)) == 0
    assert value(spark, fn.late_flag(F.lit(0), promised, delivered)) is None


def test_sunday_is_zero(spark):
    assert value(spark, fn.weekday_from_sunday(at("2026-11-29 12:00:00"))) == 0
    assert value(spark, fn.weekday_from_sunday(at("2026-11-28 12:00:00"))) == 6


@pytest.mark.parametrize("n, d, expected", [(1, 0, None), (1, None, None), (None, 2, None), (1, 2, 0.5), (0, 3, 0.0)])
def test_safe_divide(spark, n, d, expected):
    assert value(spark, fn.safe_divide(F.lit(n).cast("int"), F.lit(d).cast("int"))) == expected


@pytest.mark.parametrize("text, expected", [(None, "none"), ("", "none"), ("  ", "none"), (" a ", "a")])
def test_blank_default(spark, text, expected):
    assert value(spark, fn.default_if_blank(F.lit(text).cast("string"), "none")) == expected


def test_null_default_keeps_blanks(spark):
    assert value(spark, fn.default_if_null(F.lit(""), "none")) == ""
    assert value(spark, fn.default_if_null(F.lit(None).cast("string"), "none")) == "none"


def test_timestamps_and_numbers_from_bad_text(spark):
    assert value(spark, fn.as_timestamp(F.lit("2018-01-02 03:04:05"))) == datetime(2018, 1, 2, 3, 4, 5)
    assert value(spark, fn.as_timestamp(F.lit(""))) is None
    assert value(spark, fn.lenient_double(F.lit("x"))) is None
    assert value(spark, fn.lenient_double(F.lit("1.5"))) == 1.5


@pytest.mark.parametrize(
    "status, group",
    [("created", "placed"), ("approved", "placed"), ("invoiced", "in_transit"), ("shipped", "in_transit"),
     ("delivered", "delivered"), ("canceled", "canceled"), ("unavailable", "other"), ("processing", "other"),
     (None, "other")],
)
def test_status_groups(spark, status, group):
    assert value(spark, fn.status_group(F.lit(status).cast("string"))) == group


def test_surrogate_key_tells_null_from_blank(spark):
    import hashlib

    key = value(spark, fn.surrogate_key(F.lit("a"), F.lit(7)))
    assert key == hashlib.md5(b"a-7").hexdigest()
    null_key = value(spark, fn.surrogate_key(F.lit(None).cast("string")))
    assert null_key != value(spark, fn.surrogate_key(F.lit("")))


@pytest.mark.parametrize("a, b, expected", [("SP", "SP", 1), ("SP", "RJ", 0), (None, "SP", None), ("SP", None, None)])
def test_same_flag(spark, a, b, expected):
    pair = spark.createDataFrame([(a, b)], "a string, b string")
    assert pair.select(fn.flag(F.col("a") == F.col("b"))).first()[0] == expected


@pytest.mark.parametrize(
    "score, expected",
    [(None, "unknown"), (float("nan"), "unknown"), (0.0999, "ok"), (0.1, "warning"), (0.2, "alert")],
)
def test_band(spark, score, expected):
    assert value(spark, fn.band(F.lit(score).cast("double"), 0.1, 0.2)) == expected


def test_calendar_months(spark):
    first, second = F.lit("2026-01-31").cast("date"), F.lit("2026-02-01").cast("date")
    assert value(spark, fn.calendar_months(first, second)) == 1
    assert value(spark, fn.calendar_months(F.lit("2025-12-01").cast("date"), first)) == 1


@pytest.mark.parametrize("p, expected", [(0.5, 1), (0.4999, 0), (None, None)])
def test_threshold_is_inclusive(spark, p, expected):
    assert value(spark, fn.predicted_class(F.lit(p).cast("double"))) == expected


def test_cents(spark):
    assert value(spark, fn.cents_to_currency(F.lit(1999))) == 19.99


def test_amounts_are_not_rounded(spark):
    from pyspark.sql import functions as F

    from stallwise.functions import aggregates as ag

    df = spark.range(1000).select(F.lit(0.004).alias("small"), F.lit(1e17).alias("large"))
    row = df.agg(ag.sum_amount("small").alias("small"), ag.sum_amount("large").alias("large")).first()
    assert (row["small"], row["large"]) == (4.0, 1e20)
