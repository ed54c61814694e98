"""Row filters with explicit treatment of nulls."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidewatch.functions.dates import day_column, is_sunday, trailing


def in_dates(df: DataFrame, column: str, start: dt.date, end: dt.date | None = None) -> DataFrame:
    """Both bounds inclusive; rows without a date go."""
    test = F.col(column) >= day_column(start)
    if end is not None:
        test = test & (F.col(column) <= day_column(end))
    return df.filter(test)


def in_trailing(df: DataFrame, column: str, last: dt.date, span: int) -> DataFrame:
    return df.filter(trailing(F.col(column), last, span))


def on_days(df: DataFrame, column: str, days: Sequence[dt.date]) -> DataFrame:
    return df.filter(F.col(column).isin([F.lit(d) for d in days]))


def without_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Drop the listed values, keep rows without a value."""
    return df.filter(F.coalesce(~F.col(column).isin(list(values)), F.lit(True)))


def with_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.filter(F.col(column).isin(list(values)))


def sundays(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_sunday(F.col(column)))


def up_to_latest(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """Keep rows not later than the latest value in ``other``."""
    return df.filter(F.col(column) <= other.agg(F.max(other_column)).scalar())


def sample_keys(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """All rows of ``n`` pseudo-randomly chosen distinct keys.

    Keys are ranked by a seeded digest, so a recomputed task or another partitioning picks
    the same keys.  The digest of the last one chosen is a scalar that filters the rows where
    they are: no join, no shuffle of rows.  The digests are as good as unique; keys that
    share the last one's all stay.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    smallest = (df.filter(F.col(key).isNotNull()).select(digest.alias("digest")).distinct()
                .orderBy("digest").limit(n))
    return df.filter(digest <= smallest.agg(F.max("digest")).scalar())
