"""Series completion: day grids, densify, zero fill."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.functions.dates import day_column, day_sequence


def day_grid(df: DataFrame, keys: Sequence[str], start: dt.date | Column | None,
             end: dt.date | Column, day: str = "date") -> DataFrame:
    """Every day from start to end for every distinct key.

    The calendar is generated per key row, so there is no cross join.  Without
    ``start`` it begins on the first day in the data.
    """
    known = df.dropna(subset=list(keys))
    start = first_day(known, day) if start is None else start
    return known.select(*keys).distinct().select(*keys, F.explode(day_sequence(start, end)).alias(day))


def first_day(df: DataFrame, day: str) -> Column:
    """The first day in the data, as a scalar subquery."""
    return df.agg(F.min(day)).scalar()


def densify(facts: DataFrame, keys: Sequence[str], start: dt.date | Column | None,
            end: dt.date | Column, day: str = "date") -> DataFrame:
    """Full calendar x keys with the facts attached; other columns null in gaps.

    Facts are series: a row or few per key and day.  Each row brings the days up
    to the next row of its key, the first one also the days before it.  So the
    facts are read once, and the result is already partitioned by key for the
    windows that follow.  Without ``start`` the calendar begins on the first day in
    the data, which is worked out from the facts beforehand.
    """
    if start is None:
        start = first_day(facts.dropna(subset=list(keys)), day)
    here = F.col(day)
    w = Window.partitionBy(*keys).orderBy(here.asc_nulls_first())
    first, last = day_column(start), day_column(end)
    opens = F.when(F.col("_nth") == 1, first).otherwise(F.greatest(here, first))
    following = F.lead(day).over(w)
    closes = F.when(following.isNull(), last).otherwise(
        F.least(F.greatest(here, F.date_sub(following, 1)), last))
    rest = [c for c in facts.columns if c not in (*keys, day)]
    # Of rows without a day one stays, so that its key has a calendar.
    series = (facts.dropna(subset=list(keys)).withColumn("_nth", F.row_number().over(w))
              .filter(here.isNotNull() | (F.col("_nth") == 1)))
    spans = series.withColumns({"_opens": opens, "_closes": closes})
    days = spans.withColumn("_day", F.explode(
        day_sequence(F.col("_opens"), F.col("_closes"))))
    return days.select(
        *keys, F.col("_day").alias(day),
        *(F.when(F.col("_day") == here, F.col(f"`{c}`")).alias(c) for c in rest))


def observed_grid(facts: DataFrame, key: str, day: str) -> DataFrame:
    """Every observed key on every observed day; missing measures are null.

    The observed days travel as one array value.  It holds at most one entry per
    calendar day, whatever the number of rows.
    """
    days = facts.agg(F.sort_array(F.collect_set(day))).scalar()
    grid = facts.select(key).dropna().distinct().select(key, F.explode(days).alias(day))
    return grid.join(facts, [key, day], "left")


def zero_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=list(columns))
