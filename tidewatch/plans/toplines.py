"""Reconciled sources, global time series and the topline table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tidewatch import constants as K
from tidewatch.functions import numbers, text
from tidewatch.operators import columns, reconcile, reshape, windows


def clean_snapshots(snapshots: DataFrame) -> DataFrame:
    """Distinct snapshot rows with a confirmed count."""
    return (
        snapshots.filter(F.col("confirmed").isNotNull())
        .select("code", "confirmed", "probable", "timestamp").distinct()
    )


def reconcile_latest(feed: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Cumulative sequences against the newest snapshot, per code."""
    seq = feed.groupBy("code").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("cum_seq"))
    latest = windows.latest_snapshot(
        snapshots.filter(F.col("confirmed").isNotNull()), "timestamp",
    ).select("code", "confirmed", "probable")
    return reconcile.reconcile(seq, latest, ["code"], "cum_seq", "confirmed")


def reconcile_summary(recent: DataFrame, rec: DataFrame, code: str = "country_code") -> DataFrame:
    """Country metrics with both counts; 0 and null variants."""
    joined = recent.join(rec.withColumnRenamed("code", code), code, "left")
    return joined.withColumns({
        "cum_seq_na": F.col("cum_seq"),
        "max_cases_na": F.col("max_cases").cast("bigint"),
    }).withColumns({
        "cum_seq": numbers.zero_if_null(F.col("cum_seq")),
        "max_cases": numbers.zero_if_null(F.col("max_cases")).cast("bigint"),
    })


def cumulative_feed(feed: DataFrame) -> DataFrame:
    """Running sequences per code; rows before the first count go.

    Countries that share a code and a day follow each other by name.
    """
    filled = feed.withColumn("n", F.coalesce("n", F.lit(0)))
    return filled.withColumn("cum_seq", windows.running_total(
        F.col("n"), ["code"], "submission_date", "country")).filter(F.col("cum_seq") != 0)


def feed_by_day(cumulative: DataFrame) -> DataFrame:
    return cumulative.groupBy("submission_date").agg(
        F.count("*").alias("n_countries_seq"), F.sum("cum_seq").alias("n_seq"))


def snapshots_by_day(picked: DataFrame) -> DataFrame:
    return picked.groupBy("date").agg(
        F.count("*").alias("n_countries_confirmed"),
        F.sum("confirmed").alias("n_cases_confirmed"))


def reconcile_daily(cumulative: DataFrame, picked: DataFrame) -> DataFrame:
    """Both sources per (day, code) and their daily totals."""
    seq = cumulative.select(F.col("submission_date").alias("date"), "code", "cum_seq")
    seen = picked.select("date", "code", "confirmed", "probable", "timestamp")
    rec = reconcile.reconcile(seq, seen, ["date", "code"], "cum_seq", "confirmed")
    return rec.groupBy("date").agg(
        F.count("*").alias("n_countries_all"),
        F.sum("max_cases").alias("n_cases_all"),
        F.coalesce(F.sum("confirmed"), F.lit(0)).alias("n_cases_confirmed"),
        F.coalesce(F.sum("cum_seq"), F.lit(0)).alias("n_seq"))


def global_daily(rolled: DataFrame, last: dt.date, series_days: int | None = None) -> DataFrame:
    """Worldwide daily totals, 7-day means and lagged rolling sums.

    ``series_days`` cuts the country series before the roll-up, which leaves the
    first lags empty.  Windows run over one row per day.
    """
    rows = rolled.filter(F.col("date") <= F.lit(last))
    if series_days is not None:
        start = last - dt.timedelta(days=series_days - 1)
        rows = rows.filter(F.col("date") >= F.lit(start))
    daily = rows.groupBy("date").agg(
        F.sum("rolling_cases_last_7_days").alias("rolling_cases_last_7_days"),
        F.sum("rolling_cases_last_30_days").alias("rolling_cases_last_30_days"),
        F.sum("n_new_sequences").alias("n_new_sequences"),
        F.sum("new_cases").alias("n_new_cases"))
    return daily.withColumns({
        "new_cases_7d_avg": windows.centred_mean(F.col("n_new_cases"), [], "date", 7),
        "new_seq_7d_avg": windows.centred_mean(F.col("n_new_sequences"), [], "date", 7),
        "rolling_cases_lag_7": windows.lagged(
            F.col("rolling_cases_last_7_days"), [], "date", 7),
        "rolling_cases_lag_30": windows.lagged(
            F.col("rolling_cases_last_30_days"), [], "date", 30),
    })


def topline_series(daily: DataFrame, seq_30: DataFrame) -> DataFrame:
    """Daily totals with the submission-aware counts; share of cases sequenced."""
    seq = seq_30.select(
        "date", F.col("n").alias("cases_seq_last_30_days"),
        F.col("n_lag_30").alias("cases_seq_last_30_days_lag_30"))
    return daily.join(seq, "date", "full").withColumn(
        "pct_cases_seq_30_day_window", numbers.percent(
            F.col("cases_seq_last_30_days"), F.col("rolling_cases_last_30_days"), 1))


def global_series(reconciled_daily: DataFrame, daily: DataFrame, seq_30: DataFrame) -> DataFrame:
    """One row per day: reconciled cases, totals, submission-aware counts."""
    seq = seq_30.select(
        "date", F.col("n").alias("cases_seq_last_30_days"),
        F.col("n_lag_30").alias("cases_seq_last_30_days_lag_30"))
    return reconciled_daily.join(daily, "date", "full").join(seq, "date", "left")


def toplines(series: DataFrame, as_of: dt.date, back: int = 6,
             labels: Mapping[str, tuple] = K.TOPLINE_LABELS) -> DataFrame:
    """The four topline rows as display text."""
    last = as_of - dt.timedelta(days=1)
    types = ("omicroncases", "countries")
    now = windows.two_day_change(
        series.withColumnsRenamed({"n_cases_all": "omicroncases",
                                   "n_countries_all": "countries"}),
        "date", types, as_of, back)
    for t in types:
        now = now.withColumn(f"pctchange_{t}", numbers.percent_change(
            F.col(f"change_{t}"), F.col(f"n_{t}")))
    counted = reshape.metrics_by_type(now, ("n", "change", "pctchange"), types).select(
        "type", "n", "change", "pctchange")

    at_last = series.filter(F.col("date") == F.lit(last))
    now_7, ago_7 = F.col("rolling_cases_last_7_days"), F.col("rolling_cases_lag_7")
    cases = at_last.select(
        F.lit("global_cases").alias("type"), now_7.cast("double").alias("n"),
        (now_7 - ago_7).cast("double").alias("change"),
        numbers.percent(now_7 - ago_7, ago_7, 1).alias("pctchange"))

    share = numbers.percent(
        F.col("cases_seq_last_30_days"), F.col("rolling_cases_last_30_days"), 2)
    before = numbers.percent(
        F.col("cases_seq_last_30_days_lag_30"), F.col("rolling_cases_lag_30"), 2)
    sequenced = at_last.select(
        F.lit("pct_cases_seq").alias("type"), share.alias("n"),
        F.round(share - before, 6).alias("change"),
        numbers.percent(F.round(share - before, 6), before, 1).alias("pctchange"))

    rows = columns.bind_rows(counted, cases, sequenced)
    is_share = F.col("type") == "pct_cases_seq"
    shown = lambda c: F.when(is_share, text.with_percent(text.number_text(F.col(c)))) \
        .otherwise(text.grouped_int(F.col(c)))
    metric = text.value_map(F.col("type"), {t: m for t, (m, _) in labels.items()})
    since = text.value_map(F.col("type"), {t: s for t, (_, s) in labels.items()})
    pct = text.with_percent(text.number_text(F.col("pctchange")))
    return rows.select(
        metric.alias("Metric"), shown("n").alias("Value"),
        text.with_plus(shown("change"), F.col("change")).alias("Change (#)"),
        text.with_plus(pct, F.col("pctchange")).alias("Change (%)"),
        since.alias("Change from"))
