"""Days are UTC.  Bounds are plain numbers, so they reach the file reader as pushed filters."""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000


def parse_day(day: str | dt.date | None) -> dt.date:
    """`yyyy-MM-dd` text or a date; the current UTC date when not given."""
    if day is None:
        return dt.datetime.now(dt.timezone.utc).date()
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(day)


def day_start_micros(day: dt.date) -> int:
    return (day - dt.date(1970, 1, 1)).days * DAY_MICROS


def in_day(start_time: Column, day: dt.date, closed: bool = False) -> Column:
    """Spans of one day.

    By default both ends are open and the upper end is the day's last microsecond, as the original
    job filters: its first and its last microsecond are not read.  `closed` reads the whole day.
    """
    low = day_start_micros(day)
    high = low + DAY_MICROS - 1
    if closed:
        return (start_time >= F.lit(low)) & (start_time <= F.lit(high))
    return (start_time > F.lit(low)) & (start_time < F.lit(high))


def day_text(day: Column) -> Column:
    """RFC 3339 text of the day's UTC start."""
    return F.concat(F.date_format(day.cast("date"), "yyyy-MM-dd"), F.lit("T00:00:00Z"))


def day_millis(day: Column) -> Column:
    return F.unix_date(day.cast("date")).cast("bigint") * F.lit(DAY_MICROS // 1000)
