"""Time and text column functions. All are built-in expressions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The time patterns of the topics.
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def local_text(ts) -> Column:
    """Timestamp as `yyyy-MM-dd HH:mm:ss` text."""
    return F.date_format(_col(ts), SECOND_FORMAT)


def iso_utc(text, tz: str = "UTC", shift: bool = True) -> Column:
    """Local `yyyy-MM-dd HH:mm:ss` text as ISO text ending in `Z`; null for unreadable text.

    `shift=False` keeps the local clock and only appends the `Z`.
    """
    local = F.try_to_timestamp(_col(text), F.lit(SECOND_FORMAT)).cast("timestamp_ntz")
    if shift and tz != "UTC":
        local = F.convert_timezone(F.lit(tz), F.lit("UTC"), local)
    return F.date_format(local, ISO_FORMAT)


def parse_iso(text) -> Column:
    """ISO text with zone suffix as an instant; null for unreadable text."""
    return F.try_to_timestamp(_col(text), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSX"))


def epoch_ms(text, tz: str = "UTC", empty_is_zero: bool = True, null_is_zero: bool = True) -> Column:
    """Local time text as epoch milliseconds. Empty and null text give 0, unreadable text null."""
    text = _col(text)
    # The parser raises on "" in some modes; nullif keeps it out of the conversion.
    instant = F.try_to_timestamp(F.nullif(text, F.lit("")), F.lit(SECOND_FORMAT))
    if tz != "UTC":
        instant = F.to_utc_timestamp(instant, tz)
    zero = F.lit(False)
    if empty_is_zero:
        zero = zero | (text == "")
    if null_is_zero:
        zero = zero | text.isNull()
    return F.when(zero, F.lit(0).cast("bigint")).otherwise(F.unix_millis(instant))


def epoch_to_text(ms, fmt: str = SECOND_FORMAT, tz: str = "UTC") -> Column:
    """Epoch milliseconds as text in the given zone."""
    instant = F.timestamp_millis(_col(ms))
    if tz != "UTC":
        instant = F.from_utc_timestamp(instant, tz)
    return F.date_format(instant, fmt)


def epoch_seconds(ts) -> Column:
    """Whole seconds since the epoch (rounded down) of a timestamp with or without zone."""
    return F.unix_seconds(_col(ts).cast("timestamp"))


def seconds_to_ntz(seconds) -> Column:
    return F.timestamp_seconds(_col(seconds)).cast("timestamp_ntz")


# Spark counts from 1 and treats start 0 as one character more than the SQL standard does,
# so the 16 characters up to the minute need start 1.
def minute_text(text) -> Column:
    return F.substring(_col(text), 1, 16)


def clock_text(text) -> Column:
    return F.substring(_col(text), 12, 5)


def day_text(text) -> Column:
    return F.substring(_col(text), 1, 10)


def day_slot(text) -> Column:
    """"0" or "1" by day of month, so that a table keyed by it keeps the last two days."""
    return (F.substring(_col(text), 9, 2).cast("int") % 2).cast("string")
