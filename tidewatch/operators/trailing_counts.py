"""How many records were both recent and already submitted on each day.

A record counts on day ``d`` when ``d - span <= collected <= d`` and
``submitted <= d``, that is while ``max(collected, submitted) <= d <= collected +
span``.  Each record therefore opens and closes one interval.  Summing the
openings and closings by day and running the sum along the calendar gives every
day's count from one pass over the records, with no range join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch import constants as K
from tidewatch.functions.dates import day_column, day_sequence
from tidewatch.operators.calendar import densify, zero_fill
from tidewatch.operators.windows import add_lag_ratio, running_total


def day_deltas(records: DataFrame, collected: str, submitted: str, keys: Sequence[str] = (),
               span: int = K.MONTH_SPAN, weight: str | None = None) -> DataFrame:
    """(keys, date, delta): net openings per day, pre-aggregated map side.

    With ``weight`` a row stands for that many records.
    """
    one = F.lit(1) if weight is None else F.col(weight)
    opens = F.greatest(collected, submitted)
    closes = F.date_add(F.col(collected), span + 1)
    events = F.array(
        F.struct(opens.alias("date"), one.alias("delta")),
        F.struct(closes.alias("date"), (-one).alias("delta")),
    )
    return (
        records.filter(F.col(collected).isNotNull() & F.col(submitted).isNotNull())
        .filter(opens < closes)
        .select(*keys, F.inline(events))
        .groupBy(*keys, "date").agg(F.sum("delta").alias("delta"))
    )


def counts_from_deltas(deltas: DataFrame, start: dt.date | Column, end: dt.date | Column,
                       keys: Sequence[str] = (), value: str = "n",
                       key_rows: DataFrame | None = None) -> DataFrame:
    """Daily counts from start to end for all days, from per-day deltas.

    Openings before ``start`` are folded into the first day, so the balance is
    carried in.  Calendar rows enter as zero deltas, so no join is needed.
    ``key_rows`` names the keys that must appear; by default those with records,
    and then the calendar is filled in between a key's own days.
    """
    first, last = day_column(start), day_column(end)
    if keys and key_rows is None:
        # Later openings are in no day, but their keys have a calendar.
        day = F.when(F.col("date") <= last, F.greatest(F.col("date"), first))
        daily = deltas.groupBy(*keys, day.alias("date")).agg(F.sum("delta").alias("delta"))
        dense = zero_fill(densify(daily, keys, start, end), ["delta"])
        return dense.select(
            *keys, "date", running_total(F.col("delta"), keys, "date").alias(value))
    if keys:
        base = key_rows.select(*keys).dropna().distinct()
    else:
        base = deltas.sparkSession.range(1).select()
    zero = base.select(*keys, F.explode(day_sequence(start, end)).alias("date"),
                       F.lit(0).cast("bigint").alias("delta"))
    moved = deltas.filter(F.col("date") <= last).select(
        *keys, F.greatest(F.col("date"), first).alias("date"), "delta")
    daily = zero.unionByName(moved).groupBy(*keys, "date").agg(F.sum("delta").alias("delta"))
    return daily.select(
        *keys, "date", running_total(F.col("delta"), keys, "date").alias(value))


def trailing_counts(records: DataFrame, collected: str, submitted: str, start: dt.date,
                    end: dt.date, keys: Sequence[str] = (), span: int = K.MONTH_SPAN,
                    value: str = "n", key_rows: DataFrame | None = None,
                    weight: str | None = None) -> DataFrame:
    """The full series.  Records that can reach no day of it are not read further."""
    needed = records.filter(
        (F.col(collected) >= F.lit(start - dt.timedelta(days=span)))
        & (F.col(collected) <= F.lit(end)) & (F.col(submitted) <= F.lit(end)))
    deltas = day_deltas(needed, collected, submitted, keys, span, weight)
    return counts_from_deltas(deltas, start, end, keys, value, key_rows)


def with_lag_30(series: DataFrame, value: str = "n", keys: Sequence[str] = ()) -> DataFrame:
    return add_lag_ratio(series, value, keys, "date", 30, f"{value}_lag_30", "r")


def refresh_series(master: DataFrame, records: DataFrame, collected: str, submitted: str,
                   end: dt.date, span: int = K.MONTH_SPAN) -> DataFrame:
    """Bring a stored daily series up to ``end``.

    Days are recomputed from the last stored day on and replace it.  Only
    records collected within the window before that day are needed, and that
    bound reaches the scan as a runtime filter.
    """
    last = master.agg(F.max("date")).scalar()
    needed = records.filter(
        (F.col(collected) >= F.date_sub(last, span)) & (F.col(collected) <= F.lit(end))
        & (F.col(submitted) <= F.lit(end)))
    recent = counts_from_deltas(
        day_deltas(needed, collected, submitted, (), span), last, F.lit(end))
    kept = master.filter(F.col("date") < last).select("date", "n")
    return with_lag_30(kept.unionByName(recent))
