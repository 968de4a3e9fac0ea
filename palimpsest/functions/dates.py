"""Log dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# The two date formats that occur in logs.
LOG_DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss Z", "yyyy/MM/dd HH:mm:ss")
DAY_FORMAT = "yyyy/MM/dd"


def parse_date(text: Column, formats: Sequence[str] = LOG_DATE_FORMATS) -> Column:
    """First format that fits, null if none does."""
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(fmt)) for fmt in formats))


def day_bound(date: Column) -> Column:
    """The day a date bound is rounded to."""
    return F.date_trunc("DAY", date)


def day_text(date: Column) -> Column:
    return F.date_format(date, DAY_FORMAT)


def within(date: Column, start: Column | None = None, end: Column | None = None) -> Column:
    """Open date range; a missing or null bound does not limit."""
    keep = F.lit(True)
    if start is not None:
        keep = keep & (start.isNull() | (date > start))
    if end is not None:
        keep = keep & (end.isNull() | (date < end))
    return keep
