"""Time expressions. "Now" is always an argument."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Epoch seconds from December 1901 to February 2106, what signed and unsigned 32 bits can hold. A value outside
# (milliseconds, for one) is no usable event time: a single such record would push a stream's watermark so far
# that every later record counted as late.
MIN_EPOCH_SECONDS = -(2**31)
MAX_EPOCH_SECONDS = 2**32 - 1

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
MONTH_KEY = "yyyy-MM"
DISPLAY_MINUTES = "yyyy-MM-dd HH:mm"

RANGES = {"24h": timedelta(hours=24), "3d": timedelta(days=3)}
DEFAULT_RANGE = timedelta(days=7)


def instant(at: datetime) -> Column:
    """Zone-free timestamp literal; it folds to a constant that a parquet scan can be given."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def event_time(epoch_seconds: Column) -> Column:
    usable = epoch_seconds.between(MIN_EPOCH_SECONDS, MAX_EPOCH_SECONDS)
    return F.when(usable, F.timestamp_seconds(epoch_seconds))


def epoch_seconds(at: datetime) -> Column:
    return F.unix_timestamp(instant(at).cast("timestamp"))


def newer_than(column: Column, as_of: datetime, age: timedelta) -> Column:
    """Strictly later than as_of - age."""
    return column > instant(as_of - age)


def day_of(column: Column) -> Column:
    """The day by which tables of the streams are partitioned."""
    return column.cast("date")


def on_report_days(day: Column, as_of: datetime, time_range: str) -> Column:
    """Days that in_report_range can touch; a filter on the partitions, beside the one on the time itself."""
    return day >= F.lit((as_of - RANGES.get(time_range, DEFAULT_RANGE)).date())


def in_report_range(column: Column, as_of: datetime, time_range: str) -> Column:
    """24h and 3d as named; every other name means seven days."""
    return newer_than(column, as_of, RANGES.get(time_range, DEFAULT_RANGE))


def previous_month(as_of: datetime) -> tuple[datetime, datetime]:
    """First instants of the month before as_of and of as_of's own month."""
    this_month = datetime(as_of.year, as_of.month, 1)
    last_day = this_month - timedelta(days=1)
    return datetime(last_day.year, last_day.month, 1), this_month


def previous_month_key(as_of: datetime) -> str:
    return previous_month(as_of)[0].strftime("%Y-%m")


def in_previous_month(column: Column, as_of: datetime) -> Column:
    """Range test on the column itself, which a scan can use; a formatted column could not be pushed."""
    first, end = previous_month(as_of)
    return (column >= instant(first)) & (column < instant(end))
