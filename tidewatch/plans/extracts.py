"""Smaller report jobs: dashboard extract, map attributes, flows, snapshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidewatch import constants as K
from tidewatch.functions import numbers, text
from tidewatch.operators import columns, crosswalk, filters, reshape


def capture_snapshot(pages: DataFrame, country_codes: DataFrame, taken: str,
                     cells: str = "cells", by_words: bool = True) -> DataFrame:
    """Tracker pages to snapshot rows (location, counts, code, timestamp).

    ``by_words`` as in :func:`crosswalk.add_code`.
    """
    rows = reshape.tracker_table(pages, cells).withColumn(
        "location", text.value_map(F.col("location"), K.TRACKER_NAME_FIXES))
    return crosswalk.add_code(rows, "location", country_codes, by_words=by_words).withColumnRenamed(
        taken, "timestamp")


def dashboard_cases(series: DataFrame, day: dt.date, countries: Sequence[str]) -> DataFrame:
    """Case columns of the listed countries on one day."""
    on_day = filters.on_days(series, "date", [day]).select(
        F.col("location").alias("country"), "iso_code", "date", "total_cases",
        "new_cases", "total_deaths", "new_deaths",
    ).withColumnsRenamed({
        "total_cases": "total_covid_cases", "new_cases": "new_covid_cases"})
    return filters.with_values(on_day, "country", countries)


def dashboard(counts: DataFrame, cases: DataFrame, regions: DataFrame) -> DataFrame:
    """Counts joined with cases and region, one row per country, code and day.

    Regions are reduced to one row per country before the join instead of
    removing the repeats it would cause afterwards.
    """
    by_region = crosswalk.one_per_key(
        regions.select("country", "who_region"), ["country"], [F.col("who_region")])
    joined = counts.join(cases, "country").join(by_region, "country")
    out = joined.select(
        "country", "iso_code", "who_region", "omicron_variant", "new_covid_cases",
        "new_deaths", "total_covid_cases", "total_deaths", "date")
    return crosswalk.one_per_key(
        out, ["country", "iso_code", "date"],
        [F.col(c) for c in out.columns if c not in ("country", "iso_code", "date")])


def top_countries(board: DataFrame, n: int) -> DataFrame:
    return board.orderBy(F.desc("omicron_variant"), "country").limit(n)


def dashboard_by_region(board: DataFrame) -> DataFrame:
    return board.groupBy("date", "who_region").agg(
        F.sum("omicron_variant").alias("omicron_variant"))


def dashboard_geometry(board: DataFrame, geometry: DataFrame) -> DataFrame:
    """Geometry by code; codes without a value and identical rows do not multiply rows."""
    return crosswalk.add_dimension(
        board, geometry, {"iso_code": "code"}, {"geometry": "geometry"})


def map_attributes(summary: DataFrame, places: DataFrame, feed: DataFrame) -> DataFrame:
    """Country summary with place attributes and cumulative sequences.

    Cumulative sequences join by place name, the summary by code; both are
    outer with respect to the places.
    """
    seq = feed.groupBy(F.col("country").alias("NAME")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("cum_seq"))
    counted = places.join(seq, "NAME", "full").withColumns({
        "cum_seq_na": F.col("cum_seq"),
        "cum_seq": numbers.zero_if_null(F.col("cum_seq")),
    })
    x = F.col("max_prevalence_variant_pct")
    rounded = summary.withColumn(
        "log10_max_prevalence_variant_pct", numbers.log10_threshold(x),
    ).withColumn("max_prevalence_variant_pct", numbers.floor_threshold(x))
    return rounded.join(
        counted.withColumnRenamed("ISO3", "country_code"), "country_code", "left")


def map_polygons(vertices: DataFrame, attributes: DataFrame, summary: DataFrame,
                 feed: DataFrame) -> DataFrame:
    """Polygon vertices with their shape's attributes, metrics and sequences.

    Metrics and counts without a shape stay as rows without vertices.
    """
    seq = feed.groupBy(F.col("country").alias("NAME")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("cum_seq"))
    shaped = vertices.join(attributes.withColumnRenamed("ISO3", "code"), "id")
    metrics = summary.withColumnRenamed("country_code", "code")
    return crosswalk.full_join_keyed(
        crosswalk.full_join_keyed(shaped, metrics, "code"), seq, "NAME")


def flow_table(flows: DataFrame) -> DataFrame:
    """Week bounds and endpoints from the composite keys, row by row."""
    out = columns.split_key(flows, "Group.1", "_", ("week_start", "week_end"), "date")
    out = columns.split_key(out, "Group.2", " ", ("i", "j"), "int")
    return out.select("week_start", "week_end", "i", "j", F.col("x").alias("w"))


def flow_diagonal(flows: DataFrame, n_keys: int = 100, seed: int = 0) -> DataFrame:
    """Flows from a place to itself for a seeded sample of places."""
    table = flow_table(flows)
    digest_sample = filters.sample_keys(table, "i", n_keys, seed)
    return digest_sample.filter(F.col("i") == F.col("j"))
