"""Dates as numbers. Time columns are zone-free; all arithmetic is in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WEEK = 7 * 24 * 3600


def zone_free(ts: Column) -> Column:
    return ts.cast("timestamp_ntz")


def epoch_seconds(ts: Column) -> Column:
    """Whole UTC seconds since 1970 of a zone-free time or a 'YYYY-MM-DD HH:MM:SS' text."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.try_cast("timestamp_ntz"))


def added_epoch(added: Column) -> Column:
    """Epoch of the added-date text; null for dates that do not exist (year 0000)."""
    real = F.when(~F.startswith(added, F.lit("0000")), added)
    return epoch_seconds(real)


def days_since_2000(ts: Column) -> Column:
    return F.datediff(ts.cast("date"), F.lit("2000-01-01").cast("date"))


def week_index(ts: Column) -> Column:
    """Weeks since the epoch; weeks start on Thursdays."""
    return F.floor(epoch_seconds(ts) / F.lit(_WEEK)).cast("long")


def week_start(index: Column) -> Column:
    return index * F.lit(_WEEK)


def week_end(index: Column) -> Column:
    return (index + F.lit(1)) * F.lit(_WEEK) - F.lit(1)


def date_text(ts: Column) -> Column:
    """'YYYY-MM-DD HH:MM:SS'."""
    return F.rpad(F.substring(zone_free(ts).cast("string"), 1, 19), 19, " ")


def rating_x10(rating: Column) -> Column:
    """0.0–10.0 -> 0–100."""
    return F.round(rating.cast("decimal(10,2)") * F.lit(10)).cast("int")
