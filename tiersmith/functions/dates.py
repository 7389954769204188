"""Date helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(c: Column) -> Column:
    """Coercing date parse; text that is no date becomes null."""
    return c.try_cast("timestamp").cast("date")


def week_start(c: Column) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", c).cast("date")


def iso_year(c: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), c).cast("int")


def date_key(c: Column) -> Column:
    return F.date_format(as_date(c), "yyyy-MM-dd")


def minutes_between(start: Column, end: Column) -> Column:
    return F.round((F.unix_timestamp(end) - F.unix_timestamp(start)) / 60).cast("int")
