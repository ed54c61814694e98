"""Date expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def lenient_date(text: Column) -> Column:
    """Text to date; ``YYYY-MM`` becomes the first of the month, junk null."""
    return text.try_cast("date")


def strict_date(text: Column) -> Column:
    """Text to date, only for complete ``YYYY-MM-DD`` values."""
    return F.when(F.length(text) == 10, text.try_cast("date"))


def lag_days(submitted: Column, collected: Column) -> Column:
    return F.datediff(submitted, collected)


def iso_yearweek(day: Column) -> Column:
    """ISO year and week, for example ``2020-W53``."""
    return F.concat(
        F.extract(F.lit("YEAROFWEEK"), day).cast("string"),
        F.lit("-W"),
        F.lpad(F.weekofyear(day).cast("string"), 2, "0"),
    )


def week_start(day: Column) -> Column:
    """Monday on or before ``day``."""
    return F.date_trunc("week", day).cast("date")


def is_sunday(day: Column) -> Column:
    return F.weekday(day) == 6


def time_of_day(ts: Column) -> Column:
    """Decimal hours, to the minute."""
    return F.hour(ts) + F.minute(ts) / F.lit(60.0)


def day_column(day: dt.date | str | Column) -> Column:
    return day if isinstance(day, Column) else F.lit(day).cast("date")


def day_sequence(start: dt.date | Column, end: dt.date | Column) -> Column:
    """Array of all days from start to end; empty when end is before start."""
    s, e = day_column(start), day_column(end)
    return F.when(s <= e, F.sequence(s, e, F.expr("interval 1 day"))).otherwise(
        F.array().cast("array<date>")
    )


def trailing(day: Column, last: dt.date | Column, span: int) -> Column:
    """``last - span <= day <= last``."""
    end = day_column(last)
    return day.between(F.date_sub(end, span), end)
