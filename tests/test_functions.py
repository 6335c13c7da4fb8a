from pyspark.sql import functions as F

from eventmart.functions import (
    clock_text,
    day_slot,
    day_text,
    epoch_ms,
    epoch_to_text,
    iso_utc,
    local_text,
    minute_text,
    parse_iso,
)


def one(spark, value, expression):
    frame = spark.createDataFrame([(value,)], "x string")
    return frame.select(expression.alias("y")).first()["y"]


def test_iso_text_is_shifted_to_utc(spark):
    text = "2019-12-24 09:29:45"
    assert one(spark, text, iso_utc("x", "Asia/Shanghai")) == "2019-12-24T01:29:45.000Z"
    assert one(spark, text, iso_utc("x", "Asia/Shanghai", shift=False)) == "2019-12-24T09:29:45.000Z"
    for bad in (None, "", "2019-13-01 00:00:00", "yesterday"):
        assert one(spark, bad, iso_utc("x")) is None


def test_year_end_uses_the_calendar_year(spark):
    assert one(spark, "2019-12-31 10:00:00", iso_utc("x")) == "2019-12-31T10:00:00.000Z"


def test_iso_text_is_read_as_an_instant(spark):
    assert one(spark, "2019-12-24T09:29:45.000Z", parse_iso("x").cast("string")) == "2019-12-24 09:29:45"
    assert one(spark, "2019-12-24T09:29:45.000+08", parse_iso("x").cast("string")) == "2019-12-24 01:29:45"
    assert one(spark, "2019-12-24 09:29:45", parse_iso("x")) is None


def test_epoch_of_empty_null_and_bad_text(spark):
    assert one(spark, "1970-01-01 08:00:01", epoch_ms("x", "Asia/Shanghai")) == 1000
    assert one(spark, "", epoch_ms("x")) == 0
    assert one(spark, None, epoch_ms("x")) == 0
    assert one(spark, "", epoch_ms("x", null_is_zero=False)) == 0
    assert one(spark, None, epoch_ms("x", null_is_zero=False)) is None
    assert one(spark, "not a time", epoch_ms("x")) is None


def test_epoch_to_text(spark):
    assert one(spark, "1514708501000", epoch_to_text(F.col("x").cast("bigint"))) == "2017-12-31 08:21:41"
    assert one(spark, "1514708501000", epoch_to_text(F.col("x").cast("bigint"), "yyyy-MM-dd", "Asia/Shanghai")) == "2017-12-31"


def test_text_cuts(spark):
    text = "2019-12-24 09:29:45"
    assert one(spark, text, minute_text("x")) == "2019-12-24 09:29"
    assert one(spark, text, clock_text("x")) == "09:29"
    assert one(spark, text, day_text("x")) == "2019-12-24"
    assert one(spark, text, day_slot("x")) == "0"
    assert one(spark, "2019-12-25 09:29:45", day_slot("x")) == "1"
    assert one(spark, text, local_text(F.to_timestamp("x"))) == text
