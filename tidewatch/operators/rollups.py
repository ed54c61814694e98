"""Lag statistics and roll-ups over place and time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch import constants as K
from tidewatch.functions.text import who_region_label


def _lag_measures(lag: str, freq: str, prefix: str) -> list[Column]:
    q = lambda p: F.percentile(lag, F.lit(p), F.col(freq))
    return [
        F.sum(freq).alias("seq_count"),
        q(0.5).alias(f"{prefix}_median"),
        F.min(lag).alias(f"{prefix}_min"),
        F.max(lag).alias(f"{prefix}_max"),
        q(0.25).alias(f"{prefix}_q1"),
        q(0.75).alias(f"{prefix}_q3"),
    ]


def lag_histogram(df: DataFrame, keys: Sequence[str], lag: str = "lag_days") -> DataFrame:
    """Records per key and lag value: a plain hash aggregate, combined map side."""
    return df.groupBy(*keys, lag).agg(F.count("*").alias("_freq"))


def lag_stats(df: DataFrame, keys: Sequence[str] = ("collect_date", "country"),
              lag: str = "lag_days", prefix: str = "lagdays") -> DataFrame:
    """Count, extremes and exact, interpolated quartiles of the lag.

    Quartiles are taken from (value, frequency) pairs.  Lags are whole days, so
    a group never holds more entries than there are distinct lags.
    """
    counts = lag_histogram(df.dropna(subset=list(keys)), keys, lag)
    counts = counts.withColumn("_freq", F.when(F.col(lag).isNotNull(), F.col("_freq"))
                               .otherwise(0))
    return counts.groupBy(*keys).agg(*_lag_measures(lag, "_freq", prefix))


def regional_lag_stats(df: DataFrame, keys: Sequence[str] = ("collect_weekstartdate",),
                       continent: str = "continent", region: str = "who_region",
                       lag: str = "lag_days", prefix: str = "lagdays") -> DataFrame:
    """Lag statistics per continent, per region and overall from one scan."""
    hist = lag_histogram(df.dropna(subset=list(keys)).filter(F.col(lag).isNotNull()),
                         [*keys, continent, region], lag)
    return _by_place(hist, keys, continent, region, _lag_measures(lag, "_freq", prefix))


def location_rollup(df: DataFrame, keys: Sequence[str], measures: Sequence[str],
                    continent: str = "continent", region: str = "who_region") -> DataFrame:
    """Sums per continent, per region and overall; the sum of nothing is 0."""
    sums = [F.coalesce(F.sum(F.col(f"`{m}`")), F.lit(0)).alias(m) for m in measures]
    return _by_place(df, keys, continent, region, sums)


def _by_place(df: DataFrame, keys: Sequence[str], continent: str, region: str,
              measures: Sequence[Column]) -> DataFrame:
    ks = [F.col(k) for k in keys]
    out = df.dropna(subset=list(keys)).groupingSets(
        [[*ks, F.col(continent)], [*ks, F.col(region)], ks], *keys, continent, region,
    ).agg(*measures, F.grouping(continent).alias("_gc"), F.grouping(region).alias("_gr"))
    label = (
        F.when((F.col("_gc") == 1) & (F.col("_gr") == 1), K.GLOBAL_LABEL)
        .when(F.col("_gr") == 1, F.col(continent))
        .otherwise(who_region_label(F.col(region)))
    )
    return (
        out.withColumn("aggregate_location", label)
        .filter(F.col("aggregate_location").isNotNull())
        .drop("_gc", "_gr")
    )


def weekly_rollup(df: DataFrame, keys: Sequence[str], measures: Sequence[str], country: str,
                  attributes: Sequence[str]) -> DataFrame:
    """Sums per week and country with the country's attributes attached.

    The attributes are one value per country, spread over its weeks by a window, so
    the series is read once and rows cannot multiply.
    """
    sums = [F.coalesce(F.sum(F.col(f"`{m}`")), F.lit(0)).alias(m) for m in measures]
    weekly = df.groupBy(*keys, country).agg(*sums, *(F.max(a).alias(a) for a in attributes))
    place = Window.partitionBy(country)
    return weekly.withColumns({a: F.max(a).over(place) for a in attributes}).dropna(
        subset=[*keys, country])


def overwrite_reported(df: DataFrame, reported: DataFrame, keys: Sequence[str], place: str,
                       columns: Sequence[str]) -> DataFrame:
    """Replace own values by reported ones for every place that reports.

    A place that reports at all loses its own values; weeks it does not report
    are null.
    """
    side = reported.select(*(F.col(k).alias(f"_key_{k}") for k in keys),
                           *(F.col(c).alias(f"_reported_{c}") for c in columns))
    places = reported.select(F.col(place).alias("_reporting")).dropna().distinct()
    test = None
    for k in keys:
        t = F.col(k) == F.col(f"_key_{k}")
        test = t if test is None else test & t
    joined = df.join(side, test, "left").join(
        places, F.col(place) == F.col("_reporting"), "left")
    return joined.withColumns({
        c: F.when(F.col("_reporting").isNotNull(), F.col(f"_reported_{c}")).otherwise(F.col(c))
        for c in columns
    }).select(*df.columns)
