"""Calendar expressions. Timestamps are wall-clock ``timestamp_ntz`` values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_timestamp(c: Column, on_bad: str = "error") -> Column:
    """Typed wall-clock timestamp from a string/date/timestamp column.

    Under ANSI a malformed string fails the job (``on_bad='error'``);
    ``on_bad='null'`` turns it into null instead.
    """
    if on_bad == "null":
        return c.try_cast("timestamp_ntz")
    return c.cast("timestamp_ntz")


def date_key(c: Column) -> Column:
    """``yyyyMMdd`` as an int, computed arithmetically (no string formatting)."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def calendar_columns(dt: Column) -> dict[str, Column]:
    """Calendar attributes of a date: Sunday = 1, ISO week, weekend = day 1 or 7."""
    dow = F.dayofweek(dt)
    return {
        "date_key": date_key(dt),
        "full_date": dt,
        "day_of_week": dow,
        "day_name": F.date_format(dt, "EEEE"),
        "day_of_month": F.dayofmonth(dt),
        "day_of_year": F.dayofyear(dt),
        "week_of_year": F.weekofyear(dt),
        "month": F.month(dt),
        "month_name": F.date_format(dt, "MMMM"),
        "quarter": F.quarter(dt),
        "year": F.year(dt),
        "is_weekend": dow.isin(1, 7),
        "is_holiday": F.lit(False),
    }
