"""Jobs on the line list: cleaning, feed extract, submission counts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidewatch import constants as K
from tidewatch.functions import dates, text
from tidewatch.operators import calendar, crosswalk, flags, lineage_counts
from tidewatch.session import stored

CLEAN_COLUMNS = (
    "collection_date_text", "accession_id", "pango_lineage", "location_text",
    "region", "country", "division", "collect_date", "submit_date", "lag_days",
    "collect_yearweek", "collect_weekstartdate", "submit_yearweek",
    "submit_weekstartdate", "excluded", "abnormal_date", "suspect_sequence",
    "abnormal_gc_content", "any_abnormal",
)


def annotate(df: DataFrame, location: str = "Location", collected: str = "Collection date",
             submitted: str = "Submission date") -> DataFrame:
    """Location parts, corrected country, dates, lag, weeks."""
    parts = F.col("_parts")
    collect = dates.lenient_date(F.col(f"`{collected}`"))
    submit = dates.lenient_date(F.col(f"`{submitted}`"))
    return df.withColumn("_parts", F.split(f"`{location}`", "/")).withColumns({
        "region": text.trimmed_part(parts, 0),
        "country": text.trimmed_part(parts, 1),
        "division": text.trimmed_part(parts, 2, ""),
        "collect_date": collect,
        "submit_date": submit,
    }).withColumns({
        "country": text.fix_country_titlecased(F.col("country")),
        "lag_days": dates.lag_days(F.col("submit_date"), F.col("collect_date")),
        "collect_yearweek": dates.iso_yearweek(F.col("collect_date")),
        "submit_yearweek": dates.iso_yearweek(F.col("submit_date")),
        "collect_weekstartdate": dates.week_start(F.col("collect_date")),
        "submit_weekstartdate": dates.week_start(F.col("submit_date")),
    })


def clean_line_list(metadata: DataFrame, exclusions: DataFrame, as_of: dt.date,
                    drop_abnormal: bool = False, check: bool = True, **flag_args) -> DataFrame:
    """Checked, flagged and annotated line list.

    Abnormal rows are only flagged unless ``drop_abnormal`` is set.
    """
    if check:
        flags.require_columns(metadata, K.METADATA_COLUMNS)
    flagged = flags.add_quality_flags(metadata, exclusions, as_of, **flag_args)
    out = annotate(flagged).withColumnsRenamed({
        "Collection date": "collection_date_text", "Accession ID": "accession_id",
        "Pango lineage": "pango_lineage", "Location": "location_text",
    }).select(*CLEAN_COLUMNS)
    return out.filter(~F.col("any_abnormal")) if drop_abnormal else out


def code_line_list(feed: DataFrame, country_codes: DataFrame, as_of: dt.date,
                   first: dt.date = K.FIRST_DATE) -> DataFrame:
    """Feed rows with country code and valid dates (the stricter preset).

    Needs text columns ``location``, ``collection_date``, ``submission_date``.
    ``country_codes`` is a crosswalk (see ``operators.crosswalk``).
    """
    part = lambda i: text.tight_part(F.col("_parts"), i)
    located = feed.drop("country").withColumn("_parts", F.split("location", "/")).withColumns({
        "continent": part(0), "country": part(1), "division": part(2), "place": part(3),
    }).withColumns({
        "country": text.fix_country_plain(F.col("country")),
        "division": text.fix_division(F.col("division")),
        "collection_date": dates.strict_date(F.col("collection_date")),
        "submission_date": dates.strict_date(F.col("submission_date")),
    }).drop("location", "_parts")
    dated = located.filter(
        F.col("collection_date").between(F.lit(first), F.lit(as_of))
        & F.col("submission_date").isNotNull())
    coded = crosswalk.add_code(dated, "country", country_codes, drop_unmatched=True)
    return coded.withColumnRenamed("place", "location")


def submission_grid(feed: DataFrame, country_codes: DataFrame) -> DataFrame:
    """Records per country and submission day, completed over observed values.

    The counts are stored, since days and countries are read from them again.
    """
    counted = feed.groupBy(
        text.location_part(F.col("location"), 1).alias("country"), "submission_date",
    ).agg(F.count("*").alias("n")).dropna(subset=["country", "submission_date"])
    return complete_submissions(stored(counted), country_codes)


def complete_submissions(counts: DataFrame, country_codes: DataFrame) -> DataFrame:
    """Feed counts completed over observed countries and days, with codes."""
    grid = calendar.observed_grid(counts, "country", "submission_date")
    return crosswalk.add_code(grid, "country", country_codes)


def lineage_check(feed: DataFrame, lineage: str, countries: Sequence[str]) -> DataFrame:
    return lineage_counts.lineage_mentions(
        feed, "country", "pango_lineage", lineage, countries)
