"""One row per country: testing metrics, windowed metrics, labels, geometry."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch import constants as K
from tidewatch.functions import dates, numbers
from tidewatch.operators import calendar, crosswalk, gates, windows


#: Stands for a missing code while series are completed; no country has it.
NO_CODE = ""


def _sum_when(test: Column, x: str) -> Column:
    return F.coalesce(F.sum(F.when(test, F.col(x))), F.lit(0))


def testing_series(testing: DataFrame, country_codes: DataFrame) -> DataFrame:
    """Country rows of the testing table, renamed; the code is null where none is known."""
    rows = testing.filter(F.col("set") == "country").select(
        F.col("name").alias("country"), F.col("time").cast("date").alias("date"),
        "pop_100k", F.col("cap_new_tests").alias("new_tests_cap"), "cap_cum_tests",
        F.col("all_new_tests").alias("new_tests_all"), "all_cum_tests", "all_cum_cases")
    return crosswalk.add_code(rows, "country", country_codes)


def testing_metrics(testing: DataFrame, country_codes: DataFrame, as_of: dt.date) -> DataFrame:
    """Testing capacity and positivity per country.

    The calendar runs from the first day in the data to the day before
    ``as_of``.  Gaps count as zero tests but have no population, so they void
    the centred mean.  Countries without a code share one row, of code null; their
    rows of one day follow each other by name.
    """
    last = as_of - dt.timedelta(days=1)
    rows = testing_series(testing, country_codes).withColumn("code", F.coalesce("code", F.lit(NO_CODE)))
    # the first day needs no code, so the names are not looked up for it
    first = calendar.first_day(testing.filter(F.col("set") == "country").select(
        F.col("time").cast("date").alias("date")), "date")
    dense = calendar.zero_fill(
        calendar.densify(rows, ["code"], first, last),
        ["new_tests_cap", "new_tests_all"])
    rate = numbers.ratio(F.col("new_tests_all"), F.col("pop_100k"))
    averaged = dense.withColumn("rate", rate).withColumn(
        "new_tests_cap_avg", windows.centred_mean(
            F.col("rate"), ["code"], "date", 30, ties=["country"]))
    day = F.col("date")
    out = averaged.groupBy("code").agg(
        F.max("new_tests_cap_avg").alias("max_new_tests_cap_avg"),
        F.max("cap_cum_tests").alias("cap_cum_tests"),
        numbers.ratio(F.max("all_cum_cases"), F.max("all_cum_tests")).alias("cum_tpr"),
        _sum_when(dates.trailing(day, last, K.WEEK_SPAN), "new_tests_all")
        .alias("tests_in_last_7_days"),
        _sum_when(dates.trailing(day, last, K.MONTH_SPAN), "new_tests_all")
        .alias("tests_in_last_30_days"),
    )
    return out.withColumns({
        "code": F.nullif(F.col("code"), F.lit(NO_CODE)),
        "max_new_tests_cap_avg": numbers.non_negative(F.col("max_new_tests_cap_avg")),
        "cum_tpr": numbers.unit_interval(F.col("cum_tpr")),
    })


def recent_metrics(merged: DataFrame, as_of: dt.date, family: str | None = None,
                   code: str = "country_code") -> DataFrame:
    """All windowed metrics per country in one conditional aggregate.

    Windows end the day before ``as_of``; "last week" is the seven days ending a
    week before that.
    """
    last = as_of - dt.timedelta(days=1)
    day = F.col("date")
    month = dates.trailing(day, last, K.MONTH_SPAN)
    week = dates.trailing(day, last, K.WEEK_SPAN)
    before = dates.trailing(day, last - dt.timedelta(days=7), K.WEEK_SPAN)
    aggs = [
        _sum_when(month, "new_cases").alias("cases_in_last_30_days"),
        _sum_when(month, "n_new_sequences").alias("sequences_in_last_30_days"),
        F.max(F.when(month, F.col("population"))).alias("population_size"),
        _sum_when(week, "new_cases").alias("_cases_7"),
        F.max(F.when(week, F.col("population"))).alias("_population_7"),
    ]
    if family:
        aggs += [
            _sum_when(week, family).alias("_family_7"),
            _sum_when(week, "n_new_sequences").alias("_seq_7"),
            F.sum(family).alias("n_lineage"),
            F.sum("n_new_sequences").alias("n_sequences"),
            _sum_when(before, family).alias("_family_before"),
            _sum_when(before, "n_new_sequences").alias("total_seq_last_week"),
        ]
    out = merged.groupBy(code).agg(*aggs).withColumns({
        "cases_per_100k_last_30_days": numbers.per_100k(
            F.col("cases_in_last_30_days"), F.col("population_size")),
        "percent_of_cases_sequenced_last_30_days": numbers.percent(
            F.col("sequences_in_last_30_days"), F.col("cases_in_last_30_days")),
        "per_capita_seq_rate_in_last_30_days": numbers.per_100k(
            F.col("sequences_in_last_30_days"), F.col("population_size")),
        "max_prevalence_variant_pct": numbers.detection_threshold(
            F.col("sequences_in_last_30_days")),
        "cases_per_100k_last_7_days": F.round(
            numbers.per_100k(F.col("_cases_7"), F.col("_population_7")), 1),
    })
    if family:
        out = out.withColumns({
            "pct_lineage_last_7_days": numbers.percent(
                F.col("_family_7"), F.col("_seq_7"), 2),
            "pct_lineage_all_time": numbers.percent(
                F.col("n_lineage"), F.col("n_sequences"), 2),
            "pct_seq_last_week": numbers.percent(
                F.col("_family_before"), F.col("total_seq_last_week"), 2),
        })
    return out.drop(*(c for c in out.columns if c.startswith("_")))


def with_testing(recent: DataFrame, tests: DataFrame, code: str = "country_code") -> DataFrame:
    """Attach testing metrics: tests per 100k and positivity."""
    joined = recent.join(tests.withColumnRenamed("code", code), code, "left")
    out = joined
    for span in ("7", "30"):
        out = out.withColumn(f"tests_per_100k_in_last_{span}_days", numbers.per_100k(
            F.col(f"tests_in_last_{span}_days"), F.col("population_size")))
    for span in ("7", "30"):
        out = out.withColumn(f"positivity_in_last_{span}_days", numbers.ratio(
            F.col(f"cases_per_100k_last_{span}_days"),
            F.col(f"tests_per_100k_in_last_{span}_days")))
    return out


def label_lineage(summary: DataFrame) -> DataFrame:
    """Detection, dots and panel columns of a lineage summary."""
    n, share = F.col("n_lineage"), F.col("pct_seq_last_week")
    rounded = F.coalesce(
        F.round("percent_of_cases_sequenced_last_30_days", 2), F.lit(0.0))
    return summary.withColumns({
        "n_lineage_na": numbers.null_if_zero(n),
        "lineage_detected": numbers.detected(n),
        "pct_dots": numbers.dots_value(share, n),
        "pct_panel": numbers.panel_text(share, F.col("total_seq_last_week")),
        "rounded_pct_cases_seq": rounded,
        "pct_cases_seq_w_na": numbers.null_if_zero(rounded),
    })


def label_threshold(summary: DataFrame) -> DataFrame:
    """Log, floored value and both display texts of the detection threshold."""
    x = F.col("max_prevalence_variant_pct")
    return summary.withColumn(
        "log10_max_prevalence_variant_pct", numbers.log10_threshold(x),
    ).withColumn("max_prevalence_variant_pct", numbers.floor_threshold(x)).withColumns({
        "max_prevalence_variant_pct_flags": numbers.threshold_label(x, F.col("cum_tpr")),
        "max_prevalence_variant_pct_w_pct": numbers.threshold_label(
            x, F.col("cum_tpr"), "%"),
    })


def add_map_columns(summary: DataFrame, geometry: DataFrame, lat_long: DataFrame,
                    code: str = "country_code") -> DataFrame:
    """Countries of the map dimension, with or without metrics.

    Identical rows of coordinates and shapes count once; a country with several
    shapes has a row for each.
    """
    places = lat_long.select(code, "latitude", "longitude").distinct()
    shapes = geometry.select(code, "geometry", F.col("Name")).distinct()
    shaped = shapes.join(summary, code, "left")
    return places.join(shaped, code, "left")


LINEAGE_OUTPUT = (
    "geometry", "latitude", "longitude", "Name", "n_lineage", "n_lineage_na",
    "lineage_detected", "cases_per_100k_last_7_days",
    "percent_of_cases_sequenced_last_30_days", "rounded_pct_cases_seq",
    "pct_cases_seq_w_na", "sequences_in_last_30_days", "pct_seq_last_week",
    "pct_dots", "pct_panel", "total_seq_last_week",
)


def lineage_summary(merged: DataFrame, tests: DataFrame, geometry: DataFrame,
                    lat_long: DataFrame, family: str, as_of: dt.date) -> DataFrame:
    """The map table of one lineage family, labelled; metrics columns included."""
    recent = with_testing(recent_metrics(merged, as_of, family), tests)
    mapped = add_map_columns(label_lineage(recent), geometry, lat_long)
    return mapped.withColumns({
        "rounded_pct_cases_seq": F.coalesce("rounded_pct_cases_seq", F.lit(0.0)),
        "sequences_in_last_30_days": numbers.zero_if_null(
            F.col("sequences_in_last_30_days")),
    })


def lineage_gates(summary: DataFrame, home: str = "USA", neighbour: str | None = None,
                  min_share: float | None = 50.0, code: str = "country_code") -> list[gates.Gate]:
    """Plausibility gates of a lineage summary."""
    above = gates.country_above
    out = [
        above(code, home, "cases_per_100k_last_7_days", 50, "home_cases_per_100k"),
        above(code, home, "percent_of_cases_sequenced_last_30_days", 0.0001,
              "home_pct_sequenced"),
        above(code, home, "n_lineage", 40, "home_lineage_count"),
        gates.none_above("pct_dots", 100, "countries_above_100_pct"),
        gates.columns_present(summary, LINEAGE_OUTPUT),
        gates.country_not_null(code, home, "cases_per_100k_last_7_days"),
    ]
    if min_share is not None:
        out.append(above(code, home, "pct_dots", min_share, "home_lineage_share"))
    if neighbour is not None:
        out.append(above(code, neighbour, "total_seq_last_week", 10,
                         "neighbour_sequences_last_week"))
    return out
