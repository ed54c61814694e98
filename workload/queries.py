"""One query per operator or job, over the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tidewatch import constants as K
from tidewatch.functions import dates, lineages, numbers, text
from tidewatch.operators import (
    calendar, columns, crosswalk, filters, flags, gates, lineage_counts, reconcile, reshape,
    rollups, trailing_counts, windows,
)
from tidewatch.plans import country_day, extracts, line_list, summary, toplines
from tidewatch.session import scratch_folder, stored
from tidewatch.sources import readers, schemas, writers
from tidewatch.streaming import feed as live
from workload import views as V

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def digits(df: DataFrame, *names: str, n: int = 6) -> DataFrame:
    """Round computed doubles for display."""
    return df.withColumns({c: F.round(c, n) for c in names})


# --- line list: flags, places, dates -------------------------------------------------

FLAG_ARGS = dict(human="Human", first=dt.date(1996, 1, 1))


@query
def line_list_flags(spark, sf):
    df = flags.require_columns(V.metadata(spark, sf), K.METADATA_COLUMNS)
    c = lambda n: F.col(f"`{n}`")
    return df.select(
        c("Accession ID").alias("accession_id"),
        flags.abnormal_date(c("Collection date"), V.AS_OF, dt.date(1996, 1, 1))
        .alias("abnormal_date"),
        flags.abnormal_date(c("Collection date"), V.AS_OF, dt.date(1996, 1, 1), inclusive=True)
        .alias("abnormal_date_inclusive"),
        flags.suspect_sequence(c("Sequence length"), c("N-Content"), c("Host"))
        .alias("suspect_sequence"),
        flags.abnormal_gc(c("GC-Content")).alias("abnormal_gc_content"),
    ).withColumn("any_abnormal", flags.any_flag(
        "abnormal_date", "suspect_sequence", "abnormal_gc_content"))


@query
def exclusion_flag(spark, sf):
    names = flags.exclusion_names(V.exclusion_lines(spark, sf))
    rows = V.table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus",
        F.concat(F.lit("hCoV-19/"), V.accession()).alias("virus_name"))
    return flags.flag_members(rows, "virus_name", names).groupBy(
        "l_returnflag", "l_linestatus", "excluded").agg(F.count("*").alias("n"))


@query
def exclusion_names(spark, sf):
    return flags.exclusion_names(V.exclusion_lines(spark, sf))


@query
def location_parts(spark, sf):
    rows = V.order_places(spark, sf).select(
        "o_orderkey", F.split(F.concat(
            F.col("region"), F.lit(" / "), V.spelling(F.col("n_nationkey")), F.lit("/ "),
            F.col("division"), F.lit(" /site/extra")), "/").alias("p"))
    tight = ("continent", "country", "division", "location")
    part = lambda n: text.trimmed_part(F.col("p"), n)
    return rows.select(
        "o_orderkey", *(text.tight_part(F.col("p"), i).alias(n) for i, n in enumerate(tight)),
        part(0).alias("region_part"), part(1).alias("country_part"), part(2).alias("_third"),
        text.trimmed_part(F.col("p"), 6, "").alias("missing_part"),
    ).withColumns({
        "title_cased": text.title_case(F.col("country_part")),
        "capitalised": text.capital_first(F.col("country_part")),
        "country_titlecased": text.fix_country_titlecased(F.col("country_part")),
        "country_plain": text.fix_country_plain(F.col("country_part")),
        "division_fixed": text.fix_division(
            F.when(F.col("_third") == "HOUSEHOLD", "DC").otherwise(F.col("_third"))),
    }).drop("_third")


@query
def iso_weeks(spark, sf):
    o = V.table(spark, sf, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"), "o_orderpriority")
    s = F.col("day").cast("string")
    mixed = F.when(F.col("o_orderkey") % 3 == 0, F.substring(s, 1, 7)).when(
        F.col("o_orderkey") % 3 == 1, s).otherwise(F.col("o_orderpriority"))
    return o.select(
        "o_orderkey", dates.iso_yearweek(F.col("day")).alias("yearweek"),
        dates.week_start(F.col("day")).alias("weekstart"),
        dates.is_sunday(F.col("day")).alias("sunday"),
        dates.lenient_date(mixed).alias("lenient"), dates.strict_date(mixed).alias("strict"))


@query
def time_of_day(spark, sf):
    return V.table(spark, sf, "events").select(
        "event_id", dates.time_of_day(F.col("ts")).alias("hours"),
        text.hour_stamp(F.col("ts")).alias("stamp"))


@query
def clean_line_list(spark, sf):
    exclusions = flags.exclusion_names(V.exclusion_lines(spark, sf))
    return line_list.clean_line_list(V.metadata(spark, sf), exclusions, V.AS_OF, **FLAG_ARGS)


@query
def clean_line_list_normal_rows(spark, sf):
    exclusions = flags.exclusion_names(V.exclusion_lines(spark, sf))
    return line_list.clean_line_list(
        V.metadata(spark, sf), exclusions, V.AS_OF, drop_abnormal=True, **FLAG_ARGS
    ).groupBy("country", "collect_yearweek").agg(
        F.count("*").alias("n"), F.max("lag_days").alias("max_lag"))


@query
def coded_line_list(spark, sf):
    feed = V.metadata(spark, sf).select(
        F.col("Accession ID").alias("accession_id"), F.lit("").alias("country"),
        F.col("Location").alias("location"), F.col("Submission date").alias("submission_date"),
        F.col("Collection date").alias("collection_date"),
        F.col("Pango lineage").alias("pango_lineage"))
    coded = line_list.code_line_list(feed, name_codes(spark, sf), V.AS_OF, V.FIRST)
    return coded.groupBy("code", "country", "division", "collection_date").agg(
        F.count("*").alias("n"), F.count("location").alias("n_places"))


@V.view
def name_codes(spark, sf) -> DataFrame:
    """Crosswalk over the plain-preset spellings of the nations."""
    names = V.table(spark, sf, "nation").select(
        text.fix_country_plain(V.spelling(F.col("n_nationkey"))).alias("name"),
        F.upper(F.substring(text.fix_country_plain(V.spelling(F.col("n_nationkey"))), 1, 3))
        .alias("code"))
    return crosswalk.build_crosswalk(
        names.filter(~F.col("name").isin("Kosovo", "Timor", "Denmark")), "name", "code",
        K.LINE_LIST_CODE_OVERRIDES)


@query
def country_crosswalk(spark, sf):
    rows = V.order_places(spark, sf).select(
        F.concat(F.lit("  "), F.upper(text.fix_country_plain(V.spelling(F.col("n_nationkey")))))
        .alias("country"))
    counts = rows.groupBy("country").agg(F.count("*").alias("n"))
    return crosswalk.add_code(counts, "country", name_codes(spark, sf))


def written_feed(spark, sf):
    """The line-list feed with country names as other files write them."""
    places = V.order_places(spark, sf)
    day = F.col("collection_date").cast("string")
    return V.table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate").join(
        places, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws(" / ", "region", V.written(F.col("n_nationkey")), "division").alias("location"),
        F.to_date("l_shipdate").cast("string").alias("submission_date"), day.alias("collection_date"))


def shipped_codes(spark, sf):
    """A country table in the spelling of statistics files, with the line list's overrides."""
    rows = crosswalk.literal_rows(spark, [
        ("Korea, Rep.", "KOR"), ("United States", "USA"), ("Russian Federation", "RUS"),
        ("Puerto Rico", "PRI"), ("Guinea-Bissau", "GNB")], ["name", "code"])
    return crosswalk.build_crosswalk(rows, "name", "code", K.LINE_LIST_CODE_OVERRIDES)


@query
def coded_written_names(spark, sf):
    """Records per code of a line list whose spellings the country table does not have."""
    coded = line_list.code_line_list(written_feed(spark, sf), shipped_codes(spark, sf), V.AS_OF, V.FIRST)
    return coded.groupBy("code", "country").agg(
        F.count("*").alias("n"), F.max("submission_date").alias("last_submission"))


@query
def unmatched_written_names(spark, sf):
    rows = V.order_places(spark, sf).select(V.written(F.col("n_nationkey")).alias("country"))
    return crosswalk.unmatched_names(rows, "country", shipped_codes(spark, sf))


@query
def names_of_codes(spark, sf):
    """Orders per code, with the code's English name."""
    rows = V.order_places(spark, sf).select(V.written(F.col("n_nationkey")).alias("country"))
    counts = rows.groupBy("country").agg(F.count("*").alias("n"))
    coded = crosswalk.add_code(counts, "country", shipped_codes(spark, sf))
    return crosswalk.add_name(coded, "code")


@query
def coded_share_gate(spark, sf):
    rows = V.order_places(spark, sf).select(V.written(F.col("n_nationkey")).alias("country"))
    coded = crosswalk.add_code(rows, "country", shipped_codes(spark, sf))
    return digits(gates.evaluate(coded, [gates.coded_share("code")]), "observed")


@query
def continents_by_code(spark, sf):
    """The merged series with each day's continent taken from its code."""
    by_code = crosswalk.continents(V.case_series(spark, sf, aggregates=False))
    return crosswalk.add_continent(merged(spark, sf), "country_code", by_code).select(
        "country_code", "date", "continent", "new_cases")


@query
def unmatched_names(spark, sf):
    rows = V.order_places(spark, sf).select(
        text.fix_country_plain(V.spelling(F.col("n_nationkey"))).alias("country"))
    return crosswalk.unmatched_names(rows, "country", name_codes(spark, sf))


@query
def feed_lines(spark, sf):
    """Header-less feed rows of 7 or 8 fields, parsed with one schema."""
    from tidewatch.sources.schemas import FEED

    ll = V.line_list(spark, sf, lineage=True)
    line = F.concat_ws(
        ",", "accession_id", "country", F.concat_ws(" / ", "region", "country"),
        F.col("submission_date").cast("string"),
        F.col("collection_date").cast("string"), F.lit("G"), "pango_lineage",
        F.when(F.col("l_linenumber") > 3, "VOC"))
    parsed = ll.select(F.from_csv(line, FEED.simpleString()[7:-1].replace(":", " ")).alias("r"))
    return parsed.select("r.*").drop("variant").groupBy(
        "country", "location", "collection_date").agg(
        F.count("*").alias("n"), F.max("submission_date").alias("last_submission"))


# --- lineage counts --------------------------------------------------------------------

DAY_KEYS = ["collect_date", "collect_yearweek", "collect_weekstartdate", "country"]


@V.view
def weekly_clean(spark, sf):
    return V.clean_list(spark, sf).withColumns({
        "collect_yearweek": dates.iso_yearweek(F.col("collect_date")),
        "collect_weekstartdate": dates.week_start(F.col("collect_date"))})


@query
def lineage_counts_with_totals(spark, sf):
    return lineage_counts.counts_with_lineage(
        weekly_clean(spark, sf), DAY_KEYS, patterns=V.KEY_PATTERNS)


@query
def lineage_counts_by_day(spark, sf):
    return lineage_counts.count_by(
        weekly_clean(spark, sf), [*DAY_KEYS, "pango_lineage"], "accession_id")


@query
def lineage_totals_by_day(spark, sf):
    return lineage_counts.count_by(weekly_clean(spark, sf), DAY_KEYS, "accession_id")


@query
def key_lineages(spark, sf):
    p = V.table(spark, sf, "part")
    c = F.col("p_brand")
    return p.select(
        "p_partkey", lineages.key_lineage(
            c, V.KEY_PATTERNS, {"Brand#4": "Brand#4/5", "Brand#5": "Brand#4/5"}).alias("label"),
        lineages.lineage_in(c, V.KEY_PATTERNS).alias("matched"),
        lineages.variant_group(c, V.GROUPS).alias("group_name"))


@query
def lineage_conditional(spark, sf):
    return lineage_counts.family_counts(
        V.coded_list(spark, sf), ["code", "collection_date"], V.families())


@query
def country_day_counts(spark, sf):
    return lineage_counts.count_by(
        V.coded_list(spark, sf, lineage=False), ["code", "collection_date"],
        name="n_new_sequences")


@query
def submission_day_counts(spark, sf):
    return lineage_counts.count_by(
        V.coded_list(spark, sf, lineage=False), ["country", "submission_date"])


@query
def lineage_pivot(spark, sf):
    long = lineage_counts.counts_with_lineage(
        V.clean_list(spark, sf), ["collect_date", "country"], patterns=V.KEY_PATTERNS)
    return lineage_counts.pivot_lineages(long, ["collect_date", "country"])


@query
def lineage_columns(spark, sf):
    """The columns that the wide table takes from the data, as rows again."""
    wide = country_day.wide_counts(V.clean_list(spark, sf), patterns=V.KEY_PATTERNS)
    keys = ["collect_date", "country"]
    return reshape.melt(wide, keys, [c for c in wide.columns if c not in keys]).filter(
        F.col("value").isNotNull())


@query
def variant_groups(spark, sf):
    wide = country_day.wide_counts(V.clean_list(spark, sf), patterns=["Brand#*"])
    return lineage_counts.variant_group_columns(wide, V.GROUPS).select(
        "collect_date", "country", *V.GROUPS, "who_other")


@query
def distinct_lineages(spark, sf):
    rows = V.line_list(spark, sf, lineage=True)
    return rows.select("region", "pango_lineage", "country").distinct().groupBy("region").agg(
        F.countDistinct("pango_lineage").alias("n_lineages"),
        F.countDistinct("country").alias("n_countries"),
        F.bool_or(F.col("pango_lineage") == "Brand#2").alias("present"))


@query
def lineage_check(spark, sf):
    return line_list.lineage_check(
        V.line_list(spark, sf, lineage=True), "Brand#2", ["NATION_0", "NATION_16"])


@query
def lineage_extract(spark, sf):
    return V.line_list(spark, sf, lineage=True).filter(
        F.col("pango_lineage") == "Brand#2").select(
        "accession_id", "country", "collection_date", "submission_date", "pango_lineage")


# --- completion -----------------------------------------------------------------------------

@query
def densified_series(spark, sf):
    counts = lineage_counts.count_by(
        V.coded_list(spark, sf, lineage=False), ["code", "collection_date"])
    dense = calendar.densify(counts, ["code"], V.FIRST, V.LAST, "collection_date")
    return calendar.zero_fill(dense, ["n"])


@query
def observed_grid(spark, sf):
    counts = lineage_counts.count_by(
        V.coded_list(spark, sf, lineage=False), ["country", "submission_date"])
    return calendar.observed_grid(counts, "country", "submission_date")


@query
def submission_grid(spark, sf):
    return line_list.submission_grid(
        V.line_list(spark, sf).select(
            F.concat_ws(" / ", "region", "country").alias("location"), "submission_date"),
        crosswalk.build_crosswalk(V.country_dimension(spark, sf), "country", "code"))


# --- cases and merges --------------------------------------------------------------------------

@query
def case_series(spark, sf):
    return country_day.load_cases(
        V.case_series(spark, sf), dt.date(1995, 2, 1), K.AGGREGATE_CODES_9, "case_")


@query
def case_codes_filtered(spark, sf):
    kept = filters.without_values(
        V.case_series(spark, sf), "iso_code", ["OWID_ASI", "OWID_EUR", "N01"])
    return kept.groupBy("iso_code").agg(
        F.count("*").alias("n_days"), F.max("date").alias("last_day"))


@query
def case_merge_full(spark, sf):
    seq = lineage_counts.count_by(
        V.clean_list(spark, sf, lineage=False), ["collect_date", "country"], "accession_id")
    cases = V.case_series(spark, sf).filter(F.col("new_cases") > 1).select(
        F.date_add("date", 1).alias("collect_date"), F.col("location").alias("country"),
        "new_cases")
    return reconcile.merge_full(seq, cases, ["collect_date", "country"])


@query
def case_merge_left(spark, sf):
    seq = lineage_counts.count_by(
        V.coded_list(spark, sf, lineage=False), ["code", "collection_date"],
        name="n_new_sequences").withColumnsRenamed(
        {"code": "iso_code", "collection_date": "date"})
    cases = filters.without_values(
        V.case_series(spark, sf), "iso_code", K.AGGREGATE_CODES_15).select(
        "iso_code", "date", "new_cases")
    return reconcile.merge_left(cases, seq, ["iso_code", "date"])


@query
def region_join(spark, sf):
    daily = lineage_counts.count_by(
        V.clean_list(spark, sf, lineage=False), ["country", "collect_date"])
    return crosswalk.add_dimension(
        daily, V.regions(spark, sf).unionByName(V.regions(spark, sf)),
        {"country": "Entity"}, {"WHO region": "who_region"})


@query
def lag_stats(spark, sf):
    return rollups.lag_stats(V.clean_list(spark, sf, lineage=False))


@V.view
def regional_clean(spark, sf):
    ll = V.clean_list(spark, sf, lineage=False).withColumnRenamed("region", "continent")
    return crosswalk.add_dimension(
        ll, V.regions(spark, sf), {"country": "Entity"}, {"WHO region": "who_region"}
    ).withColumn("collect_weekstartdate", dates.week_start(F.col("collect_date")))


@query
def regional_lag_stats(spark, sf):
    return rollups.regional_lag_stats(regional_clean(spark, sf))


@V.view
def regional_cases(spark, sf):
    cases = filters.without_values(
        V.case_series(spark, sf), "iso_code", K.AGGREGATE_CODES_9)
    return crosswalk.add_dimension(
        cases, V.regions(spark, sf), {"location": "Entity"}, {"WHO region": "who_region"})


@query
def region_rollup(spark, sf):
    df = regional_cases(spark, sf).withColumn("week", dates.week_start(F.col("date")))
    return rollups.location_rollup(
        df, ["week"], ["new_cases", "people_vaccinated", "population"])


@query
def weekly_rollup(spark, sf):
    df = regional_cases(spark, sf).withColumns({
        "weekstart": dates.week_start(F.col("date")),
        "yearweek": dates.iso_yearweek(F.col("date"))})
    return rollups.weekly_rollup(
        df, ["weekstart", "yearweek"], ["new_cases", "people_vaccinated"], "location",
        ["population", "who_region", "continent"])


@query
def country_day_wide(spark, sf):
    cases = country_day.load_cases(V.case_series(spark, sf, aggregates=False), V.FIRST)
    out = country_day.country_day_wide(
        V.clean_list(spark, sf), cases, V.regions(spark, sf), patterns=V.KEY_PATTERNS)
    return digits(out, "case_new_cases_smoothed")


@V.view
def merged(spark, sf):
    return country_day.merged_series(
        V.coded_list(spark, sf), V.case_series(spark, sf, aggregates=False), V.families(),
        V.AS_OF, V.FIRST)


@query
def merged_series(spark, sf):
    return merged(spark, sf)


@query
def ratio_columns(spark, sf):
    df = merged(spark, sf).select(
        "country_code", "date", "n_new_sequences", "new_cases", "population")
    out = country_day.ratio_columns(df, "n_new_sequences", "new_cases", "population")
    return digits(out, "sequences_over_new_cases", "new_cases_per_mil")


# --- windows ------------------------------------------------------------------------------------

@V.view
def dense_counts(spark, sf):
    counts = lineage_counts.count_by(
        V.coded_list(spark, sf, lineage=False), ["code", "collection_date"]
    ).withColumnRenamed("collection_date", "date")
    return calendar.zero_fill(calendar.densify(counts, ["code"], V.FIRST, V.LAST), ["n"])


@query
def rolling_sums(spark, sf):
    return digits(country_day.rolling_series(merged(spark, sf), "fam_2"),
                  "percent_of_cases_seq_last_30_days").select(
        "country_code", "date", "rolling_cases_last_30_days", "rolling_cases_last_7_days",
        "rolling_seq_last_30_days", "rolling_seq_last_7_days", "rolling_family_last_7_days",
        "percent_of_cases_seq_last_30_days", "rolling_pct_of_seq")


@query
def centred_mean(spark, sf):
    n = F.when(F.dayofyear("date") % 50 != 0, F.col("n"))
    w = lambda k: windows.centred_mean(n, ["code"], "date", k)
    return dense_counts(spark, sf).select(
        "code", "date", w(7).alias("mean_7"), w(30).alias("mean_30"))


@query
def lag_ratio(spark, sf):
    out = windows.add_lag_ratio(dense_counts(spark, sf), "n", ["code"], "date", 7)
    return digits(out, "r")


@query
def fill_then_diff(spark, sf):
    c = V.case_series(spark, sf).select("iso_code", "date", "people_vaccinated")
    return c.withColumn("new_people_vaccinated", windows.daily_from_cumulative(
        F.col("people_vaccinated"), ["iso_code"], "date"))


@query
def running_total(spark, sf):
    return toplines.cumulative_feed(V.feed_counts(spark, sf))


@query
def latest_snapshot(spark, sf):
    return windows.latest_snapshot(V.snapshots(spark, sf), "timestamp")


@query
def nearest_snapshot(spark, sf):
    out = windows.daily_snapshot(V.snapshots(spark, sf), "timestamp", "nearest")
    return out.select("date", "code", "confirmed", "timestamp", "time_diff")


@query
def nearest_event(spark, sf):
    """On raw events: ties within the same minute stay."""
    e = V.table(spark, sf, "events").select("event_id", "ts")
    return windows.daily_snapshot(e, "ts", "nearest").select("event_id", "date")


@query
def earliest_snapshot(spark, sf):
    out = windows.daily_snapshot(V.snapshots(spark, sf), "timestamp", "earliest")
    return out.select("date", "code", "confirmed", "timestamp", "time_diff")


@query
def two_day_change(spark, sf):
    daily = V.table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.count("*").alias("orders"), F.countDistinct("o_custkey").alias("customers"))
    return windows.two_day_change(daily, "date", ["orders", "customers"], V.LAST)


# --- submission-aware counts ----------------------------------------------------------------------

@V.view
def thirty_day(spark, sf, end=V.LAST):
    return trailing_counts.with_lag_30(trailing_counts.trailing_counts(
        V.line_list(spark, sf).select("collection_date", "submission_date"),
        "collection_date", "submission_date", V.FIRST, end))


@query
def seq_last_30(spark, sf):
    return digits(thirty_day(spark, sf), "r")


@query
def seq_last_30_by_country(spark, sf):
    return trailing_counts.trailing_counts(
        V.coded_list(spark, sf, lineage=False), "collection_date", "submission_date",
        V.FIRST, V.LAST, ["code"])


@query
def submission_aware_series(spark, sf):
    out = country_day.submission_aware_series(
        V.coded_list(spark, sf, lineage=False), merged(spark, sf), V.SERIES_CODES,
        dt.date(1999, 11, 1), V.LAST, dt.date(1999, 12, 1))
    return digits(out, "pct_cases_seq_last_30_days")


@query
def seq_refresh(spark, sf):
    """Series stored up to the end of 2000, brought up to date."""
    master = stored(thirty_day(spark, sf, dt.date(2000, 12, 31)))
    out = trailing_counts.refresh_series(
        master, V.line_list(spark, sf).select("collection_date", "submission_date"),
        "collection_date", "submission_date", V.LAST)
    return digits(out, "r")


# --- country summary -------------------------------------------------------------------------------

@V.view
def codes(spark, sf):
    return crosswalk.build_crosswalk(V.country_dimension(spark, sf), "country", "code")


@V.view
def tests_by_country(spark, sf):
    names = crosswalk.build_crosswalk(
        V.country_dimension(spark, sf), "country", "code", K.TESTING_CODE_OVERRIDES)
    return summary.testing_metrics(V.testing(spark, sf), names, V.AS_OF)


TEST_DOUBLES = ("max_new_tests_cap_avg", "cap_cum_tests", "cum_tpr")
RECENT_DOUBLES = (
    "cases_per_100k_last_30_days", "percent_of_cases_sequenced_last_30_days",
    "per_capita_seq_rate_in_last_30_days", "max_prevalence_variant_pct")


@query
def testing_metrics(spark, sf):
    return digits(tests_by_country(spark, sf), *TEST_DOUBLES)


@query
def recent_metrics(spark, sf):
    return digits(summary.recent_metrics(merged(spark, sf), V.AS_OF, "fam_2"), *RECENT_DOUBLES)


@query
def recent_with_testing(spark, sf):
    out = summary.with_testing(
        summary.recent_metrics(merged(spark, sf), V.AS_OF), tests_by_country(spark, sf))
    return digits(out, *RECENT_DOUBLES, *TEST_DOUBLES, "tests_per_100k_in_last_7_days",
                  "tests_per_100k_in_last_30_days", "positivity_in_last_7_days",
                  "positivity_in_last_30_days")


@V.view
def family_summary(spark, sf, family):
    return summary.lineage_summary(
        merged(spark, sf), tests_by_country(spark, sf), V.geometry(spark, sf),
        V.lat_long(spark, sf), family, V.AS_OF)


@query
def country_summary(spark, sf):
    out = family_summary(spark, sf, "fam_2").select(*summary.LINEAGE_OUTPUT)
    return digits(out, "percent_of_cases_sequenced_last_30_days")


@query
def country_summary_second_family(spark, sf):
    out = family_summary(spark, sf, "fam_4_5").select(*summary.LINEAGE_OUTPUT)
    return digits(out, "percent_of_cases_sequenced_last_30_days")


@query
def summary_gates(spark, sf):
    df = family_summary(spark, sf, "fam_4_5")
    return digits(gates.evaluate(df, summary.lineage_gates(
        df, V.HOME, V.NEIGHBOUR, min_share=None)), "observed")


@query
def summary_gates_with_share(spark, sf):
    df = family_summary(spark, sf, "fam_2")
    return digits(gates.evaluate(df, summary.lineage_gates(
        df, V.HOME, None, min_share=50)), "observed")


@query
def line_list_gates(spark, sf):
    ll = V.line_list(spark, sf).select("submission_date", "code", "country")
    return gates.evaluate(gates.condensed(ll, ["code", "country"], ["submission_date"]), [
        gates.line_list_age("submission_date", V.AS_OF),
        gates.codes_match_names("code", "country"),
        gates.has_rows("n_rows"),
    ])


@query
def series_gates(spark, sf):
    m = merged(spark, sf).withColumn("seq_code", F.when(
        F.col("n_new_sequences") > 0, F.col("country_code")))
    m = gates.condensed(m, ["seq_code", "country_code"], ["date", "n_new_sequences"])
    return gates.evaluate(m, [
        gates.fewer_sequence_countries("seq_code", "country_code"),
        gates.sequences_age("date", "n_new_sequences", V.AS_OF, 10),
        gates.sequences_age("date", "n_new_sequences", V.AS_OF, 4),
        gates.series_ends("date", V.AS_OF),
    ])


@query
def snapshot_gate(spark, sf):
    return gates.evaluate(V.snapshots(spark, sf), [gates.snapshot_today("timestamp", V.AS_OF)])


@query
def threshold_labels(spark, sf):
    out = summary.label_threshold(summary.with_testing(
        summary.recent_metrics(merged(spark, sf), V.AS_OF), tests_by_country(spark, sf)))
    return digits(out.select(
        "country_code", "max_prevalence_variant_pct", "log10_max_prevalence_variant_pct",
        "max_prevalence_variant_pct_flags", "max_prevalence_variant_pct_w_pct"),
        "log10_max_prevalence_variant_pct")


@query
def detection_threshold(spark, sf):
    """Threshold and its labels per customer, over their number of orders."""
    n = V.table(spark, sf, "customer").select("c_custkey").join(
        V.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
            F.count("*").alias("n")), "c_custkey", "left").fillna(0, ["n"])
    x = numbers.detection_threshold(F.col("n"))
    tpr = F.col("n") / 1000
    return n.select(
        "c_custkey", "n", F.round(x, 6).alias("threshold"),
        numbers.threshold_label(numbers.floor_threshold(x), tpr).alias("label"),
        numbers.threshold_label(numbers.floor_threshold(x), tpr, "%").alias("label_pct"),
        numbers.detected(F.col("n")).alias("seen"),
        numbers.null_if_zero(F.col("n")).alias("n_na"),
        numbers.panel_text(F.round(tpr, 3), F.col("n") * 7).alias("panel"))


# --- two sources and toplines ------------------------------------------------------------------------

@query
def reconcile_sources(spark, sf):
    return toplines.reconcile_latest(V.feed_counts(spark, sf), V.snapshots(spark, sf))


@query
def reconcile_totals(spark, sf):
    return reconcile.global_totals(
        toplines.reconcile_latest(V.feed_counts(spark, sf), V.snapshots(spark, sf)),
        "cum_seq", "confirmed")


@query
def reconciled_summary(spark, sf):
    out = toplines.reconcile_summary(
        summary.recent_metrics(merged(spark, sf), V.AS_OF),
        toplines.reconcile_latest(V.feed_counts(spark, sf), V.snapshots(spark, sf)))
    mapped = summary.add_map_columns(out, V.geometry(spark, sf), V.lat_long(spark, sf))
    return mapped.select("geometry", "latitude", "longitude", "Name", "max_cases",
                         "max_cases_na", "cum_seq", "cum_seq_na", "cases_per_100k_last_7_days")


@V.view
def daily_snapshots(spark, sf, pick="earliest"):
    clean = toplines.clean_snapshots(V.snapshots(spark, sf))
    return windows.daily_snapshot(clean, "timestamp", pick)


@query
def snapshots_by_day(spark, sf):
    return toplines.snapshots_by_day(daily_snapshots(spark, sf, "nearest"))


@query
def feed_by_day(spark, sf):
    return toplines.feed_by_day(toplines.cumulative_feed(V.feed_counts(spark, sf)))


@V.view
def reconciled_days(spark, sf):
    return toplines.reconcile_daily(
        toplines.cumulative_feed(V.feed_counts(spark, sf)), daily_snapshots(spark, sf))


@query
def reconcile_daily(spark, sf):
    return reconciled_days(spark, sf)


@V.view
def global_totals(spark, sf):
    return toplines.global_daily(country_day.rolling_series(merged(spark, sf)), V.LAST)


@query
def global_daily(spark, sf):
    return global_totals(spark, sf)


@query
def global_daily_90(spark, sf):
    """Cut to 90 days before the roll-up."""
    return toplines.global_daily(
        country_day.rolling_series(merged(spark, sf)), V.LAST, series_days=90)


@query
def topline_series(spark, sf):
    return toplines.topline_series(global_totals(spark, sf), thirty_day(spark, sf))


def line_cube(spark, sf, lineage=True):
    """The line list as a stored cube; a job reads its records through it once."""
    families = V.families() if lineage else {}
    return lineage_counts.record_cube(V.coded_list(spark, sf, lineage), families), families


def merged_from(spark, sf, cube, families):
    return country_day.merged_series(
        cube, V.case_series(spark, sf, aggregates=False), families, V.AS_OF, V.FIRST, weight="n")


def series_by_day(spark, sf):
    cube, _ = line_cube(spark, sf, lineage=False)
    daily = toplines.reconcile_daily(
        toplines.cumulative_feed(lineage_counts.submissions(cube)), daily_snapshots(spark, sf))
    totals = toplines.global_daily(
        country_day.rolling_series(merged_from(spark, sf, cube, {})), V.LAST)
    recent = trailing_counts.with_lag_30(trailing_counts.trailing_counts(
        cube, "collection_date", "submission_date", V.FIRST, V.LAST, weight="n"))
    return toplines.global_series(daily, totals, recent)


@query
def global_series(spark, sf):
    return series_by_day(spark, sf)


@query
def topline_table(spark, sf):
    return toplines.toplines(series_by_day(spark, sf), V.AS_OF)


# --- vaccination ---------------------------------------------------------------------------------------

@query
def cumulative_vaccination(spark, sf):
    daily = country_day.load_cases(V.case_series(spark, sf), V.FIRST)
    return country_day.cumulative_vaccination(
        daily.drop("people_vaccinated", "people_fully_vaccinated"), "location", "date").select(
        "location", "date", "people_vaccinated", "people_vaccinated_per_hundred",
        "people_fully_vaccinated", "people_fully_vaccinated_per_hundred")


@query
def reported_vaccination(spark, sf):
    return country_day.reported_vaccination(V.case_series(spark, sf))


@query
def reported_vaccination_daily(spark, sf):
    return country_day.reported_vaccination(V.case_series(spark, sf), weekly=False)


@query
def vaccination_overwrite(spark, sf):
    return country_day.weekly_vaccination(
        V.case_series(spark, sf), F.initcap(F.coalesce("continent", "location")),
        ["people_vaccinated_per_hundred", "people_fully_vaccinated_per_hundred"])


# --- extracts -------------------------------------------------------------------------------------------

@query
def tracker_table(spark, sf):
    return reshape.tracker_table(V.tracker_pages(spark, sf))


@query
def capture_snapshot(spark, sf):
    pages = V.tracker_pages(spark, sf).withColumn(
        "taken", F.timestamp_add("HOUR", F.col("doc_id").cast("int"),
                                 F.lit(dt.datetime(2001, 1, 1)).cast("timestamp_ntz")))
    known = V.table(spark, sf, "benchmark").select(
        F.explode(F.split("text", "\\s+")).alias("name")).filter("name <> ''").select(
        "name", F.upper(F.substring("name", 1, 3)).alias("code"))
    out = extracts.capture_snapshot(
        pages, crosswalk.build_crosswalk(known, "name", "code"), "taken", by_words=False)
    return out.groupBy("code", F.to_date("timestamp").alias("date")).agg(
        F.count("*").alias("n_rows"), F.sum("confirmed").alias("confirmed"),
        F.sum("probable").alias("probable"))


DASH_DAY = dt.date(2001, 7, 2)
DASH_COUNTRIES = [f"NATION_{i}" for i in range(1, 21)]


@V.view
def board(spark, sf):
    counts = V.line_list(spark, sf).groupBy("country").agg(
        F.count("*").alias("omicron_variant"))
    cases = extracts.dashboard_cases(V.case_series(spark, sf), DASH_DAY, DASH_COUNTRIES)
    region = V.regions(spark, sf).unionByName(V.regions(spark, sf)).select(
        F.col("Entity").alias("country"), F.col("WHO region").alias("who_region"))
    return extracts.dashboard(counts, cases, region)


@query
def dashboard_extract(spark, sf):
    return board(spark, sf)


@query
def dashboard_by_region(spark, sf):
    return extracts.dashboard_by_region(board(spark, sf))


@query
def dashboard_top(spark, sf):
    return extracts.top_countries(board(spark, sf), 4)


@query
def dashboard_geometry(spark, sf):
    shapes = V.geometry(spark, sf).withColumnRenamed("country_code", "code")
    return extracts.dashboard_geometry(board(spark, sf), shapes.unionByName(shapes))


@query
def literal_counts(spark, sf):
    """Inline literal rows joined to the cases of one day."""
    from tidewatch.sources.readers import literal_table

    counts = literal_table(spark, [("NATION_3", 9), ("NATION_7", 4), ("Elsewhere", 2)],
                           ["country", "omicron_variant"])
    cases = V.case_series(spark, sf).groupBy(F.col("location").alias("country")).agg(
        F.sum("new_cases").alias("cases"))
    return counts.join(cases, "country")


@V.view
def places(spark, sf):
    return V.nations(spark, sf).select(
        F.col("country").alias("NAME"), F.col("code").alias("ISO3"),
        F.col("n_nationkey").cast("string").alias("id"), F.col("region").alias("REGION"))


@query
def map_attributes(spark, sf):
    cube, families = line_cube(spark, sf, lineage=False)
    recent = summary.recent_metrics(merged_from(spark, sf, cube, families), V.AS_OF).select(
        "country_code", "max_prevalence_variant_pct")
    out = extracts.map_attributes(
        recent, places(spark, sf).drop("id"), lineage_counts.submissions(cube))
    return digits(out, "log10_max_prevalence_variant_pct")


@query
def map_polygons(spark, sf):
    """Customers stand in for polygon vertices."""
    vertices = V.table(spark, sf, "customer").select(
        F.col("c_nationkey").cast("string").alias("id"), F.col("c_acctbal").alias("long"),
        F.col("c_custkey").alias("vertex"))
    cube, families = line_cube(spark, sf, lineage=False)
    recent = summary.recent_metrics(merged_from(spark, sf, cube, families), V.AS_OF).select(
        "country_code", "sequences_in_last_30_days")
    return extracts.map_polygons(
        vertices, places(spark, sf), recent, lineage_counts.submissions(cube))


@query
def flow_table(spark, sf):
    return extracts.flow_table(V.flows(spark, sf))


@query
def flow_diagonal(spark, sf):
    return extracts.flow_diagonal(stored(V.flows(spark, sf)), 50, seed=7)  # flows are landed files


@query
def state_melt(spark, sf):
    st = V.state_table(spark, sf)
    numeric = st.select(
        "State", *(text.parse_grouped_int(F.col(f"`{c}`")).cast("double").alias(c)
                   for c in ("Genomes shared", "Reported COVID-19 cases")),
        "% of cases sequenced and shared",
        F.col("Median days to deposition").cast("double").alias("Median days to deposition"))
    return reshape.melt(numeric, ["State"], numeric.columns[1:])


@query
def state_clean_names(spark, sf):
    return columns.clean_names(V.state_table(spark, sf))


@query
def snake_names(spark, sf):
    st = V.state_table(spark, sf).drop("% of cases sequenced and shared")
    return columns.prefix_columns(columns.snake_blanks(st), "us_", ["state"])


@query
def topline_carousel(spark, sf):
    days = reconciled_days(spark, sf)
    at = lambda c, d: F.max(F.when(F.col("date") == F.lit(d), F.col(c)))
    today, before = dt.date(2001, 8, 1), dt.date(2001, 7, 31)
    row = days.agg(
        F.max("date").alias("submission_date"),
        at("n_countries_all", today).alias("n_countries_all"),
        at("n_cases_all", today).alias("n_cases_all"), at("n_seq", today).alias("n_seq"),
        (at("n_countries_all", today) - at("n_countries_all", before))
        .alias("daily_inc_countries"),
        (at("n_seq", today) - at("n_seq", before)).alias("daily_inc_seq"),
        (at("n_cases_all", today) - at("n_cases_all", before)).alias("daily_inc_all_cases"))
    return reshape.labelled_rows(row, K.CAROUSEL_ROWS, "submission_date")


@query
def metrics_by_type(spark, sf):
    """One-row metrics of two kinds to one row per kind."""
    now = V.table(spark, sf, "lineitem").agg(
        F.count("*").alias("n_items"), F.countDistinct("l_orderkey").alias("n_orders"),
        F.count_if(F.col("l_returnflag") == "R").alias("change_items"),
        F.max("l_linenumber").alias("change_orders"))
    return reshape.metrics_by_type(now, ("n", "change"), ("items", "orders"))


# --- filters and set operators --------------------------------------------------------------------------

@query
def trailing_windows(spark, sf):
    o = V.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"), "o_totalprice")
    return filters.in_trailing(o, "day", V.LAST, K.SERIES_SPAN).groupBy("day").agg(
        F.count("*").alias("n"),
        F.count_if(dates.trailing(F.col("day"), V.LAST, K.WEEK_SPAN)).alias("n_week"),
        F.count_if(dates.trailing(F.col("day"), V.LAST, K.MONTH_SPAN)).alias("n_month"))


@query
def days_picked(spark, sf):
    o = V.table(spark, sf, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"))
    return filters.on_days(o, "day", [V.LAST, V.LAST - dt.timedelta(days=6)])


@query
def calendar_bounds(spark, sf):
    o = V.table(spark, sf, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"))
    return filters.in_dates(o, "day", dt.date(1999, 1, 1), dt.date(1999, 12, 31))


@query
def up_to_latest(spark, sf):
    items = V.table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(
        F.count("*").alias("n"))
    orders = V.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"))
    return filters.up_to_latest(items, "day", orders, "day")


@query
def sundays_only(spark, sf):
    o = V.table(spark, sf, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"))
    return filters.sundays(o, "day")


@query
def null_rows_removed(spark, sf):
    c = V.case_series(spark, sf).select("iso_code", "date", "continent", "people_vaccinated")
    return c.dropna(subset=["continent", "people_vaccinated"])


@query
def sampled_keys(spark, sf):
    return filters.sample_keys(
        V.table(spark, sf, "orders").select("o_custkey", "o_orderkey"), "o_custkey", 20, 3)


@query
def columns_reshaped(spark, sf):
    df = rollups.lag_stats(V.clean_list(spark, sf, lineage=False), ["country"])
    kept = columns.drop_matching(df, lambda c: c.endswith(("_q1", "_q3")))
    renamed = columns.rename(kept, {"seq_count": "n"})
    return columns.prefix_columns(renamed, "seq_", ["country", "n"])


@query
def rows_bound(spark, sf):
    c = V.table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    s = V.table(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return columns.bind_rows(c, s)


@query
def distinct_rows(spark, sf):
    return V.table(spark, sf, "events").select(
        F.to_date("ts").alias("day"), "event_type", "user_id").distinct()


@query
def first_per_key(spark, sf):
    e = V.table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    return crosswalk.one_per_key(e, ["user_id"], [F.col("ts"), F.col("event_id")])


@query
def sorted_series(spark, sf):
    return V.feed_counts(spark, sf).orderBy("country", "submission_date")


# --- files and sinks: the given tables as landed files, read back by the library ------------------

def landed(df: DataFrame, name: str, sep: str = ",", header: bool = True) -> str:
    """``df`` as delimited files in a new folder."""
    path = f"{scratch_folder(df.sparkSession)}/{name}"
    df.write.option("header", header).option("sep", sep).csv(path)
    return path


@query
def metadata_files(spark, sf):
    """The metadata extract from files whose columns differ in order and number."""
    rows = V.metadata(spark, sf)
    first = F.pmod(F.crc32(F.col("Accession ID").cast("binary")), F.lit(2)) == 0
    one = landed(rows.filter(first), "given", "\t")
    other = rows.filter(~first).select(*(F.col(f"`{c}`") for c in rows.columns[::-1]), F.lit(1).alias("extra"))
    back = readers.read_delimited(spark, [one, landed(other, "turned", "\t")], schemas.METADATA, sep="\t")
    return back.groupBy(F.col("Location").alias("location"), F.col("Collection date").alias("collected")).agg(
        F.count("*").alias("n"), F.sum("Sequence length").alias("total_length"),
        F.count("N-Content").alias("n_content"), F.max("Submission date").alias("last_submission"))


@query
def case_files(spark, sf):
    """The case series from a file, three of its columns."""
    series = V.case_series(spark, sf)
    wide = series.select(*(F.col(f.name) if f.name in series.columns else F.lit(None).cast("string").alias(f.name)
                           for f in schemas.CASES))
    return readers.read_cases(spark, landed(wide, "cases"), ["iso_code", "date", "new_cases"])


#: Batches that a feed comes in, and records of a landed file, about.
FEED_BATCHES, FILE_RECORDS = 6, 500_000


def landing_files(n_records: int, least: int) -> int:
    """Files of bounded size for so many records: a multiple of ``least``."""
    return least * max(1, -(-n_records // (least * FILE_RECORDS)))


@query
def submission_files(spark, sf):
    """Submissions per place and day from a folder of tab-separated files."""
    rows = V.line_list(spark, sf, lineage=True).select(
        F.col("accession_id").alias("Accession ID"), F.concat_ws(" / ", "region", "country").alias("Location"),
        F.col("submission_date").alias("Submission date"), F.col("pango_lineage").alias("Lineage"))
    n_files = landing_files(V.table(spark, sf, "lineitem").count(), 20)
    back = readers.read_submissions(spark, landed(rows.repartition(n_files), "submissions", "\t"))
    return back.groupBy("location", "submission_date").agg(
        F.count("*").alias("n"), F.countDistinct("lineage").alias("n_lineages"))


@query
def geometry_files(spark, sf):
    shapes = V.geometry(spark, sf).withColumnRenamed("country_code", "3-letter ISO code")
    return readers.read_geometry(spark, landed(shapes.select("Name", "3-letter ISO code", "geometry"), "shapes", "\t"))


@query
def country_files(spark, sf):
    """The country dimension, with a code that must not be read as null."""
    n = V.nations(spark, sf)
    rows = n.select(
        F.col("country").alias("Country"), (F.col("n_nationkey") * 1.5).alias("Longitude"),
        (F.col("n_nationkey") * -2.25).alias("Latitude"), F.col("region").alias("World Bank region"),
        (F.col("n_nationkey") * 1000).alias("Population (2019)"), F.substring("region", 1, 3).alias("World Bank region (short)"),
        F.when(F.col("n_nationkey") == 12, "NA").otherwise(F.substring("code", 2, 2)).alias("2-letter ISO code"),
        F.col("code").alias("3-letter ISO code"))
    return readers.read_countries(spark, landed(rows, "countries")).select(
        "country", "longitude", "population_2019", "x2_letter_iso_code", "x3_letter_iso_code")


@query
def csv_sink(spark, sf):
    """Daily submissions written twice as CSV and read back."""
    path = f"{scratch_folder(spark)}/out"
    for _ in range(2):
        writers.write_csv(V.feed_counts(spark, sf), path)
    return readers.read_delimited(spark, path, schemas.FEED_COUNTS)


@query
def snapshot_master(spark, sf):
    """Scrapes added to the master in two overlapping runs; each counts once."""
    path = f"{scratch_folder(spark)}/master"
    rows = V.snapshots(spark, sf)
    day = F.dayofmonth("timestamp")
    for part in (day <= 20, day >= 10, day >= 25):
        writers.write_snapshot(rows.filter(part), path)
    return spark.read.parquet(path).select(
        "code", "location", "confirmed", "probable", "timestamp", "snapshot_day", "snapshot_hour")


@query
def seq_kept_up(spark, sf):
    """The 30-day series of every country, kept up as feed files land, with compactions."""
    folder = scratch_folder(spark)
    rows = V.line_list(spark, sf, lineage=True).select(
        "accession_id", "country", F.concat_ws(" / ", "region", "country").alias("location"), "submission_date",
        "collection_date", F.lit("G").alias("clade"), "pango_lineage")
    n_files = landing_files(V.table(spark, sf, "lineitem").count(), FEED_BATCHES)
    rows.repartition(n_files).write.csv(f"{folder}/landing")
    feed = live.landed_feed(spark, f"{folder}/landing", files_per_batch=n_files // FEED_BATCHES)
    live.keep_deltas(feed, f"{folder}/deltas", f"{folder}/checkpoint", keys=["country"],
                     compact_every=2).awaitTermination()
    out = live.current_series(spark, f"{folder}/deltas", V.FIRST, V.LAST, ["country"])
    return digits(out.select("country", "date", "n", "n_lag_30", "r"), "r")
