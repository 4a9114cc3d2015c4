"""Calendar functions; "today" is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_day(value: Column) -> Column:
    """Date in the session's zone; null when the text is no timestamp."""
    return F.to_date(value.try_cast("timestamp"))


def date_and_time(ts: Column) -> Column:
    return F.struct(F.date_format(ts, "yyyy-MM-dd").alias("date"), F.date_format(ts, "HH:mm").alias("time"))


def last_sunday_before(day: Column) -> Column:
    """The latest Sunday strictly before a day."""
    return F.date_sub(day, F.when(F.dayofweek(day) == 1, 7).otherwise(F.dayofweek(day) - 1))


def within(age_ms: Column, least: int, most: int) -> Column:
    return age_ms.between(least, most)
