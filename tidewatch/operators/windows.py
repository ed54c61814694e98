"""Window operators on day series (one row per key and day, no gaps).

Frames count rows, so series are densified first.  A partition holds one key's
days, never raw records; series without a key hold one row per day in total.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

from tidewatch.functions.dates import time_of_day
from tidewatch.functions.numbers import ratio


def ordered(keys: Sequence[str], day: str, *ties: str) -> WindowSpec:
    w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    return w.orderBy(day, *ties)


def trailing_sum(x: Column, keys: Sequence[str], day: str, width: int) -> Column:
    """Sum of the last ``width`` rows, fewer at the start."""
    return F.sum(x).over(ordered(keys, day).rowsBetween(1 - width, 0))


def centred_mean(x: Column, keys: Sequence[str], day: str, width: int,
                 digits: int | None = 2, ties: Sequence[str] = ()) -> Column:
    """Mean of ``width`` rows around the row; null unless all are present.

    An even width reaches one row further forward than back.  Rows of one key and
    day follow ``ties``.
    """
    back, ahead = (width - 1) // 2, width // 2
    w = ordered(keys, day, *ties).rowsBetween(-back, ahead)
    mean = F.sum(x).over(w) / F.lit(float(width))
    full = F.when(F.count(x).over(w) == width, mean)
    return full if digits is None else F.round(full, digits)


def lagged(x: Column, keys: Sequence[str], day: str, rows: int) -> Column:
    return F.lag(x, rows).over(ordered(keys, day))


def running_total(x: Column, keys: Sequence[str], day: str, *ties: str) -> Column:
    """Sum up to the row; rows of one key and day follow ``ties``."""
    return F.sum(x).over(ordered(keys, day, *ties).rowsBetween(Window.unboundedPreceding, 0))


def daily_from_cumulative(x: Column, keys: Sequence[str], day: str) -> Column:
    """Carry the last value forward, zero before the first, first difference."""
    w = ordered(keys, day)
    filled = F.coalesce(
        F.last(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        F.lit(0))
    before = F.coalesce(
        F.last(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0))
    return F.when(F.row_number().over(w) > 1, filled - before)


def add_lag_ratio(df: DataFrame, x: str, keys: Sequence[str], day: str, rows: int,
                  lag_name: str | None = None, ratio_name: str = "r") -> DataFrame:
    """``x`` some rows ago and the ratio to it."""
    name = lag_name or f"{x}_lag_{rows}"
    return (
        df.withColumn(name, lagged(F.col(x), keys, day, rows))
        .withColumn(ratio_name, ratio(F.col(x), F.col(name)))
    )


def latest_snapshot(df: DataFrame, ts: str) -> DataFrame:
    """Rows that carry the newest timestamp of the table.

    The table is read once: every partition keeps its own newest rows, ties included, and
    just those are compared with each other.
    """
    name = "_newest"
    place = F.rank().over(Window.orderBy(F.col(ts).desc_nulls_last()))
    return df.filter(F.col(ts).isNotNull()).withColumn(name, place).filter(F.col(name) == 1).drop(name)


def daily_snapshot(df: DataFrame, ts: str, pick: str, hour: float = 13.0,
                   day: str = "date") -> DataFrame:
    """Per day, the rows of one snapshot; ties stay.

    ``pick='nearest'`` takes the time closest to ``hour``; ``pick='earliest'``
    the first of the day, which is what ``abs(time) - hour`` selects.  The table is read
    once: every partition keeps its own best rows of a day, ties included, and just those
    are dealt out by day, however busy it is.
    """
    clock = time_of_day(F.col(ts))
    if pick == "nearest":
        diff = F.abs(clock - F.lit(hour))
    elif pick == "earliest":
        diff = F.abs(clock) - F.lit(hour)
    else:
        raise ValueError(f"unknown pick: {pick}")
    rows = df.withColumn(day, F.to_date(ts)).withColumn("time_diff", diff)
    place = F.rank().over(Window.partitionBy(day).orderBy("time_diff"))
    return rows.filter(F.col(ts).isNotNull()).withColumn("_nth", place).filter(
        F.col("_nth") == 1).drop("_nth")


def two_day_change(df: DataFrame, day: str, columns: Sequence[str], today: dt.date,
                   back: int = 6) -> DataFrame:
    """One row: value on ``today`` and the change against ``back`` days before."""
    before = today - dt.timedelta(days=back)
    at = lambda c, d: F.max(F.when(F.col(day) == F.lit(d), F.col(c)))
    return (
        df.filter(F.col(day).isin(F.lit(today), F.lit(before)))
        .agg(*(at(c, today).alias(f"n_{c}") for c in columns),
             *((at(c, today) - at(c, before)).alias(f"change_{c}") for c in columns))
        .withColumn(day, F.lit(today))
    )
