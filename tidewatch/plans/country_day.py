"""Country x day tables: the wide lineage table and the merged case table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch import constants as K
from tidewatch.functions import dates, lineages, numbers, text
from tidewatch.operators import (
    calendar, columns, crosswalk, filters, lineage_counts, reconcile, rollups,
    trailing_counts, windows,
)
from tidewatch.session import stored

CASE_COLUMNS = (
    "date", "location", "iso_code", "continent", "new_cases", "new_cases_smoothed",
    "population", "people_vaccinated", "people_fully_vaccinated",
)


def load_cases(series: DataFrame, first: dt.date = K.FIRST_DATE,
               aggregate_codes: Sequence[str] = K.AGGREGATE_CODES_9,
               prefix: str = "") -> DataFrame:
    """Daily case series of countries with daily vaccination increments."""
    kept = filters.without_values(
        filters.in_dates(series, "date", first), "iso_code", aggregate_codes,
    ).select(*CASE_COLUMNS)
    daily = kept.withColumns({
        f"new_{c}": windows.daily_from_cumulative(F.col(c), ["location"], "date")
        for c in ("people_vaccinated", "people_fully_vaccinated")
    })
    return columns.prefix_columns(daily, prefix)


NO_LINEAGE = "no lineage"


def wide_counts(clean: DataFrame, labels: Sequence[str] | None = None,
                patterns: Sequence[str] | None = None,
                lineage: str = "pango_lineage", counted: str = "accession_id") -> DataFrame:
    """One row per (collect_date, country): total, a column per key lineage, other lineages.

    Lineages become pivot slots before the records are aggregated, so a task sends at most
    one row per country, day and slot.  Records without a lineage have a slot of their own,
    which counts in the total only.  Without ``labels`` the columns are the key lineages of
    the data, found in the aggregated slots; with them, another key lineage raises.
    """
    own = lineages.key_lineage(F.col(lineage), patterns)
    slot = F.when(F.col(lineage).isNotNull(), own).otherwise(NO_LINEAGE)
    slots = clean.dropna(subset=["collect_date", "country"]).groupBy(
        "collect_date", "country", slot.alias("slot")).agg(F.count(counted).alias("n"))
    if labels is None:
        slots = stored(slots)
        labels = lineage_counts.present_labels(slots, "slot")
    listed = [*sorted(set(labels) - {K.OTHER_LINEAGES, NO_LINEAGE}), K.OTHER_LINEAGES]
    wide = lineage_counts.pivot_lineages(
        slots, ["collect_date", "country"], [*listed, NO_LINEAGE], "slot")
    total = F.lit(0).cast("bigint")
    for c in [*listed, NO_LINEAGE]:
        total = total + F.coalesce(F.col(f"`{c}`"), F.lit(0))
    return wide.select("collect_date", "country", total.alias(K.ALL_LINEAGES),
                       *(F.col(f"`{c}`") for c in listed))


def wide_cases(wide: DataFrame, cases: DataFrame) -> DataFrame:
    """Lineage columns per (day, country) merged with the case series.

    Both sides have one row per country and day.  Days without sequences stay,
    with null counts.  A country's population and continent are spread over all
    its days by a window, so the case series is read once.
    """
    day_cases = cases.select(
        F.col("date").alias("collect_date"), F.col("location").alias("country"), "location",
        "continent", "population", "new_cases", "new_cases_smoothed", "new_people_vaccinated",
        "new_people_fully_vaccinated")
    place = Window.partitionBy("country")
    return reconcile.merge_full(wide, day_cases, ["collect_date", "country"]).withColumns({
        **{c: F.max(c).over(place) for c in ("location", "continent", "population")},
        "date": F.col("collect_date"),
        "collect_yearweek": dates.iso_yearweek(F.col("collect_date")),
        "collect_weekstartdate": dates.week_start(F.col("collect_date")),
    })


def country_day_wide(
    clean: DataFrame, cases: DataFrame, regions: DataFrame, labels: Sequence[str] | None = None,
    patterns: Sequence[str] | None = None, region_key: str = "Entity",
    region_name: str = "WHO region", seq_prefix: str = "seq_", case_prefix: str = "case_",
) -> DataFrame:
    """The wide country-day table with regional rows and lag statistics.

    ``labels`` as in :func:`wide_counts`.
    """
    counts = wide_counts(clean, labels, patterns)
    wide = wide_cases(counts, cases)
    wide = crosswalk.add_dimension(
        wide, regions, {"location": region_key}, {region_name: "who_region"})
    keys = ["collect_date", "collect_yearweek", "collect_weekstartdate", "date"]
    measures = [*counts.columns[2:], "new_cases", "new_cases_smoothed",
                "new_people_vaccinated", "new_people_fully_vaccinated", "population"]
    regional = rollups.location_rollup(wide, keys, measures)
    rows = columns.bind_rows(wide, regional)
    lags = rollups.lag_stats(clean.withColumn(
        "lag_days", dates.lag_days(F.col("submit_date"), F.col("collect_date"))))
    full = rows.join(lags, ["collect_date", "country"], "left")
    latest = filters.up_to_latest(full, "date", clean, "submit_date")
    names = {c: seq_prefix + c for c in (
        "collect_date", "country", "collect_yearweek", "collect_weekstartdate")}
    names |= {c: seq_prefix + c for c in latest.columns if c.startswith("lagdays_")}
    names |= {c: case_prefix + c for c in (
        "date", "location", "continent", "population", "new_cases", "new_cases_smoothed",
        "new_people_vaccinated", "new_people_fully_vaccinated")}
    return columns.rename(latest, names)


def ratio_columns(df: DataFrame, sequences: str, cases: str, population: str) -> DataFrame:
    """Sequences per new case and new cases per million."""
    return df.withColumns({
        "sequences_over_new_cases": numbers.ratio(F.col(f"`{sequences}`"), F.col(cases)),
        "new_cases_per_mil": numbers.per_million(F.col(cases), F.col(population)),
    })


def cumulative_vaccination(df: DataFrame, place: str, day: str, population: str = "population"
                           ) -> DataFrame:
    """Running totals of the increments and the share of the population."""
    out = df
    for c in ("people_vaccinated", "people_fully_vaccinated"):
        out = out.withColumn(c, windows.running_total(F.col(f"new_{c}"), [place], day))
        out = out.withColumn(f"{c}_per_hundred",
                             numbers.per_hundred(F.col(c), F.col(population)))
    return out


def reported_vaccination(series: DataFrame, weekly: bool = True,
                         names: Mapping[str, str] = K.REGION_OF_AGGREGATE_CODE) -> DataFrame:
    """Reported regional vaccination; weekly takes the Sunday of each week."""
    region = series.select(
        text.lookup(F.col("iso_code"), names).alias("aggregate_location"),
        "date", dates.week_start(F.col("date")).alias("collect_weekstartdate"),
        "people_vaccinated_per_hundred", "people_fully_vaccinated_per_hundred",
    ).filter(F.col("aggregate_location").isNotNull())
    return filters.sundays(region, "date") if weekly else region


def weekly_vaccination(series: DataFrame, own: Column, columns: Sequence[str],
                       names: Mapping[str, str] = K.REGION_OF_AGGREGATE_CODE) -> DataFrame:
    """Weekly maxima per place, replaced by reported values where the place reports.

    ``own`` names the place of a row; rows of aggregate codes report for the place of their
    code, by the Sunday of each week.  A place that reports at all loses its own values, and
    weeks it does not report are null.  Own and reported values meet in one aggregate over
    one read; whether a place reports is spread over its weeks by a window.
    """
    day = F.col("date")
    reports = F.when(dates.is_sunday(day), text.lookup(F.col("iso_code"), names))
    place = lambda where, own_row: F.struct(
        where.alias("aggregate_location"), F.lit(own_row).alias("_own"))
    rows = series.select(
        dates.week_start(day).alias("collect_weekstartdate"), *columns,
        F.inline(F.filter(F.array(place(own, True), place(reports, False)),
                          lambda x: x["_own"] | x["aggregate_location"].isNotNull())))
    best = lambda c, is_own: F.max(F.when(F.col("_own") == is_own, F.col(c)))
    weeks = rows.groupBy("aggregate_location", "collect_weekstartdate").agg(
        F.bool_or("_own").alias("_own"), F.bool_and("_own").alias("_only_own"),
        *(best(c, True).alias(c) for c in columns),
        *(best(c, False).alias(f"_reported_{c}") for c in columns))
    reporting = ~F.min("_only_own").over(Window.partitionBy("aggregate_location"))
    return weeks.withColumn("_reporting", reporting).filter("_own").select(
        "aggregate_location", "collect_weekstartdate",
        *(F.when(F.col("_reporting"), F.col(f"_reported_{c}")).otherwise(F.col(c)).alias(c)
          for c in columns))


def merged_series(
    coded: DataFrame, cases: DataFrame, families: Mapping[str, Column], as_of: dt.date,
    first: dt.date = K.FIRST_DATE, aggregate_codes: Sequence[str] = K.AGGREGATE_CODES_15,
    weight: str | None = None,
) -> DataFrame:
    """Cases per country and day, completed, with lineage-family counts.

    With ``weight``, ``coded`` is a cube of the records (see ``lineage_counts.record_cube``).

    ``coded`` needs ``code`` and ``collection_date``.  Counts and new cases are
    zero in gaps; population and the other attributes stay null there.
    """
    last = as_of - dt.timedelta(days=1)
    counts = lineage_counts.family_counts(
        filters.in_dates(coded, "collection_date", first, last),
        ["code", "collection_date"], families, weight=weight,
    ).withColumnsRenamed({"code": "country_code", "collection_date": "date"})
    series = filters.without_values(
        filters.in_dates(cases, "date", first, last), "iso_code", aggregate_codes,
    ).select(*CASE_COLUMNS).withColumnRenamed("iso_code", "country_code")
    dense = calendar.densify(series, ["country_code"], first, last)
    merged = reconcile.merge_left(dense, counts, ["country_code", "date"])
    return calendar.zero_fill(
        merged, ["n_new_sequences", *families, "other", "new_cases", "new_cases_smoothed"])


def rolling_series(merged: DataFrame, family: str | None = None, code: str = "country_code",
                   day: str = "date") -> DataFrame:
    """Rolling sums, centred means and percentages per country."""
    s = lambda c, k: windows.trailing_sum(F.col(c), [code], day, k)
    out = merged.withColumns({
        "seq_7davg": windows.centred_mean(F.col("n_new_sequences"), [code], day, 7),
        "rolling_cases_last_30_days": s("new_cases", 30),
        "rolling_cases_last_7_days": s("new_cases", 7),
        "rolling_seq_last_30_days": s("n_new_sequences", 30),
        "rolling_seq_last_7_days": s("n_new_sequences", 7),
        **({"rolling_family_last_7_days": s(family, 7)} if family else {}),
    })
    pct = numbers.percent
    out = out.withColumn("percent_of_cases_seq_last_30_days", pct(
        F.col("rolling_seq_last_30_days"), F.col("rolling_cases_last_30_days")))
    if family:
        out = out.withColumn("rolling_pct_of_seq", pct(
            F.col("rolling_family_last_7_days"), F.col("rolling_seq_last_7_days"), 2))
    return out


def submission_aware_series(
    coded: DataFrame, merged: DataFrame, codes: Sequence[str], start: dt.date,
    end: dt.date, from_day: dt.date,
) -> DataFrame:
    """Per listed country: 30-day counts as known on each day, against cases.

    The 30-day case sum starts with the series at ``start``; output begins at
    ``from_day``.
    """
    wanted = crosswalk.literal_rows(coded.sparkSession, [(c,) for c in codes], ["code"])
    counts = trailing_counts.trailing_counts(
        filters.with_values(coded, "code", codes), "collection_date", "submission_date",
        start, end, ["code"], value="n_seq_last_30_d", key_rows=wanted)
    cases = filters.with_values(merged, "country_code", codes).select(
        F.col("country_code").alias("code"), "date", "new_cases", "population")
    joined = counts.join(cases, ["code", "date"], "left")
    rolled = joined.withColumn("rolling_cases_last_30_days", windows.trailing_sum(
        F.col("new_cases"), ["code"], "date", 30))
    return rolled.withColumn("pct_cases_seq_last_30_days", numbers.percent(
        F.col("n_seq_last_30_d"), F.col("rolling_cases_last_30_days"))
    ).filter(F.col("date") >= F.lit(from_day))
