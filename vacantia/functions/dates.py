"""Calendar labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def month_label(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def day_label(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def week_start(c: Column) -> Column:
    """Monday 00:00 of the week, without a time zone."""
    return F.date_trunc("week", c).cast("timestamp_ntz")


def weekday_name(c: Column) -> Column:
    """English day name padded to nine characters."""
    return F.rpad(F.date_format(c, "EEEE"), 9, " ")


def whole_days_between(first: Column, last: Column) -> Column:
    """Whole days of the interval last - first (not the number of midnights in between)."""
    return F.extract(F.lit("DAY"), last - first).cast("bigint")
