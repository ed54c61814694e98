import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch import constants as K
from tidewatch.operators import (
    calendar, columns, crosswalk, filters, flags, gates, lineage_counts, reconcile, reshape,
    rollups, trailing_counts, windows,
)
from tidewatch.plans import country_day, summary, toplines

D = dt.date


def listed(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_missing_columns_raise(frame):
    with pytest.raises(ValueError, match="b"):
        flags.require_columns(frame([(1,)], "a int"), ["a", "b"])


def test_quality_flags(frame):
    rows = frame([
        ("2019-12-01", 30000, 0.01, 0.38, "Human"), ("2019-12-02", 20000, None, None, "Human"),
        ("2021-05", 20001, None, 0.25, "Human"), ("2021-06-30", 30000, 0.02, 0.3, "Human"),
        ("2021-07-01", 30000, 0.0, 0.3, "Bat"), (None, None, None, 0.3, None),
    ], "d string, len int, n double, gc double, host string")
    got = rows.select(
        flags.abnormal_date(F.col("d"), D(2021, 6, 30)),
        flags.abnormal_date(F.col("d"), D(2021, 6, 30), inclusive=True),
        flags.suspect_sequence(F.col("len"), F.col("n"), F.col("host")),
        flags.abnormal_gc(F.col("gc"))).collect()
    assert [tuple(r) for r in got] == [
        (True, False, False, False), (False, False, True, True), (True, True, False, True),
        (False, False, True, False), (True, True, True, False), (True, True, True, False)]


def test_testing_metrics_keep_countries_without_code(frame):
    dim = frame([("Peru", "PER"), ("Nowhere", None)], "name string, code string")
    names = crosswalk.build_crosswalk(dim, "name", "code", K.TESTING_CODE_OVERRIDES)
    rows = [(name, "country", D(2021, 1, d), 10.0, 1.0, float(d), n, n * d, 1.0 * d)
            for d in range(1, 32) for name, n in (("Peru", 10.0), ("Kosovo", 20.0), ("Atlantis", 5.0), ("Utopia", 7.0))]
    rows += [("Asia", "region", D(2021, 1, 1), 1.0, 1.0, 1.0, 99.0, 99.0, 9.0)]
    df = frame(rows, "name string, set string, time date, pop_100k double, cap_new_tests double, "
                     "cap_cum_tests double, all_new_tests double, all_cum_tests double, all_cum_cases double")
    got = {r.code: r for r in summary.testing_metrics(df, names, D(2021, 2, 1)).collect()}
    assert set(got) == {"PER", "XKX", None}
    assert [got[c].tests_in_last_7_days for c in ("PER", "XKX", None)] == [70.0, 140.0, 84.0]
    assert [got[c].max_new_tests_cap_avg for c in ("PER", "XKX", None)] == [1.0, 2.0, 0.6]


def test_exclusions_flag_without_dropping(frame):
    lines = frame([("a/1",), ("",), ("# note",), ("a/1",)], "value string")
    names = flags.exclusion_names(lines)
    assert listed(names, "name") == [("hCoV-19/a/1",)]
    df = frame([("hCoV-19/a/1",), ("a/1",), (None,)], "v string")
    got = {r.v: r.excluded for r in flags.flag_members(df, "v", names).collect()}
    assert got == {"hCoV-19/a/1": True, "a/1": False, None: False}


def test_empty_exclusion_list(frame):
    df = frame([("x",)], "v string")
    names = flags.exclusion_names(frame([], "value string"))
    assert flags.flag_members(df, "v", names).first().excluded is False


def test_clean_names(frame):
    df = columns.clean_names(frame([(1, 2, 3, 4)], "`3-letter ISO code` int, `N-Content` int, "
                                                   "`% of x` int, `n content` int"))
    assert df.columns == ["x3_letter_iso_code", "n_content", "percent_of_x", "n_content_2"]


def test_filters_keep_rows_without_a_value(frame):
    df = frame([("OWID_WRL",), ("USA",), (None,)], "iso string")
    assert filters.without_values(df, "iso", K.AGGREGATE_CODES_9).count() == 2
    assert len(K.AGGREGATE_CODES_9) == 9 and len(K.AGGREGATE_CODES_15) == 15


def test_sampled_keys_are_stable(spark):
    df = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
    a = filters.sample_keys(df, "k", 7, 1)
    b = filters.sample_keys(df.repartition(13), "k", 7, 1)
    assert a.select("k").distinct().count() == 7 and a.count() == 140
    assert listed(a, "id") == listed(b, "id")


def test_crosswalk_overrides_and_repeats(frame):
    dim = frame([("United States", "USA"), ("United States", "USA"), ("Kosovo", "KOS"),
                 ("Namibia", "NA")], "name string, code string")
    cw = crosswalk.build_crosswalk(dim, "name", "code", K.TESTING_CODE_OVERRIDES)
    assert listed(cw, "name_key") == [("kosovo", "XKX"), ("namibia", "NAM"),
                                      ("unitedstates", "USA")]
    facts = frame([("united states",), ("Nowhere",), (None,)], "country string")
    got = {r.country: r.code for r in crosswalk.add_code(facts, "country", cw).collect()}
    assert got == {"united states": "USA", "Nowhere": None, None: None}
    assert crosswalk.add_code(facts, "country", cw, drop_unmatched=True).count() == 1
    assert {r.country for r in crosswalk.unmatched_names(facts, "country", cw).collect()} == {
        "Nowhere", None}


def test_dimension_join_loses_only_identical_rows(frame):
    facts = frame([("a",), ("b",), (None,)], "k string")
    dim = frame([("a", 1), ("a", 1), ("a", 2), (None, 3)], "key string, v int")
    out = crosswalk.add_dimension(facts, dim, {"k": "key"}, {"v": "v"})
    assert sorted(map(tuple, out.collect()), key=str) == [("a", 1), ("a", 2), ("b", None), (None, None)]
    one = gates.evaluate(dim.dropna().distinct(), [gates.extra_rows(["key"])]).first()
    assert (one.observed, one.passed) == (1.0, False)


def test_map_keeps_every_shape(frame):
    shapes = frame([("P1", "Peru", "PER"), ("P2", "Peru", "PER"), ("P2", "Peru", "PER")],
                   "geometry string, Name string, country_code string")
    places = frame([("PER", 1.0, 2.0), ("PER", 1.0, 2.0), ("TCD", 3.0, 4.0)],
                   "country_code string, latitude double, longitude double")
    out = summary.add_map_columns(frame([("PER", 7)], "country_code string, n int"), shapes, places)
    assert sorted(map(tuple, out.select("country_code", "geometry", "n").collect()), key=str) == [
        ("PER", "P1", 7), ("PER", "P2", 7), ("TCD", None, None)]


def test_running_total_of_a_shared_code(frame):
    day = D(2021, 1, 1)
    for rows in ([("B", "X", day, 5), ("A", "X", day, 2)], [("A", "X", day, 2), ("B", "X", day, 5)]):
        out = toplines.cumulative_feed(
            frame(rows, "country string, code string, submission_date date, n bigint"))
        assert listed(out.select("country", "cum_seq"), "country") == [("A", 2), ("B", 7)]


def test_gates_on_condensed_rows(frame):
    df = frame([("X", "A", D(2021, 1, 1)), ("X", "A", D(2021, 1, 3)), ("X", "B", None)],
               "code string, country string, day date")
    small = gates.condensed(df, ["code", "country"], ["day"])
    assert small.count() == 2
    assert [(r.observed, r.passed) for r in gates.evaluate(small, [
        gates.line_list_age("day", D(2021, 1, 8)), gates.codes_match_names("code", "country"),
        gates.has_rows("n_rows")]).collect()] == [(5.0, True), (-1.0, False), (3.0, True)]
    assert gates.evaluate(small.limit(0), [gates.has_rows("n_rows")]).first().passed is False


def test_densify_fills_gaps_once(frame):
    facts = frame([("x", D(2021, 1, 1), 1), ("x", D(2021, 1, 3), 2), ("y", D(2021, 1, 9), 3)],
                  "k string, date date, n int")
    dense = calendar.zero_fill(
        calendar.densify(facts, ["k"], D(2021, 1, 1), D(2021, 1, 3)), ["n"])
    assert listed(dense, "k", "date") == [
        ("x", D(2021, 1, 1), 1), ("x", D(2021, 1, 2), 0), ("x", D(2021, 1, 3), 2),
        ("y", D(2021, 1, 1), 0), ("y", D(2021, 1, 2), 0), ("y", D(2021, 1, 3), 0)]
    again = calendar.densify(dense, ["k"], D(2021, 1, 1), D(2021, 1, 3))
    assert listed(again.select(*dense.columns), "k", "date") == listed(dense, "k", "date")


def test_observed_grid(frame):
    facts = frame([("x", D(2021, 1, 1), 1), ("y", D(2021, 1, 5), 2)],
                  "c string, d date, n int")
    assert listed(calendar.observed_grid(facts, "c", "d"), "c", "d") == [
        ("x", D(2021, 1, 1), 1), ("x", D(2021, 1, 5), None), ("y", D(2021, 1, 1), None),
        ("y", D(2021, 1, 5), 2)]


def series(frame, values):
    return frame([("k", D(2021, 1, 1) + dt.timedelta(i), v) for i, v in enumerate(values)],
                 "k string, date date, x double")


def test_centred_mean_of_even_width(frame):
    df = series(frame, [float(i) for i in range(6)])
    got = [r[0] for r in df.select(
        "date", windows.centred_mean(F.col("x"), ["k"], "date", 4).alias("m"))
        .orderBy("date").select("m").collect()]
    # one row back, two ahead
    assert got == [None, 1.5, 2.5, 3.5, None, None]


def test_null_voids_centred_mean(frame):
    df = series(frame, [1.0, None, 3.0, 4.0, 5.0])
    got = [r[1] for r in df.select(
        "date", windows.centred_mean(F.col("x"), ["k"], "date", 3)).orderBy("date").collect()]
    assert got == [None, None, None, 4.0, None]


def test_daily_from_cumulative(frame):
    df = series(frame, [None, 5.0, None, 8.0])
    got = [r[1] for r in df.select(
        "date", windows.daily_from_cumulative(F.col("x"), ["k"], "date")).orderBy("date").collect()]
    assert got == [None, 5.0, 0.0, 3.0]


def test_daily_snapshot_picks(frame):
    at = lambda h, m: dt.datetime(2021, 12, 1, h, m)
    df = frame([("a", at(9, 0)), ("b", at(12, 30)), ("c", at(13, 30)), ("d", at(20, 0))],
               "code string, timestamp timestamp")
    pick = lambda p: {r.code for r in windows.daily_snapshot(df, "timestamp", p).collect()}
    assert pick("nearest") == {"b", "c"}
    assert pick("earliest") == {"a"}
    assert {r.code for r in windows.latest_snapshot(df, "timestamp").collect()} == {"d"}
    with pytest.raises(ValueError):
        windows.daily_snapshot(df, "timestamp", "best")


def literal_counts(records, start, end, span=29):
    out, day = [], start
    while day <= end:
        out.append((day, sum(
            1 for c, s in records
            if c and s and day - dt.timedelta(span) <= c <= day and s <= day)))
        day += dt.timedelta(1)
    return out


RECORDS = [
    (D(2020, 12, 20), D(2020, 12, 25)),    # open before the series starts
    (D(2020, 11, 1), D(2021, 1, 5)),       # submitted too late to ever count
    (D(2021, 1, 10), D(2021, 1, 4)),       # submitted before collected
    (D(2021, 1, 10), D(2021, 2, 9)), (D(2021, 1, 10), D(2021, 2, 8)),
    (D(2021, 1, 15), None), (None, D(2021, 1, 15)),
    (D(2021, 3, 30), D(2021, 6, 1)),
]


def test_trailing_counts_equal_the_literal_form(frame):
    df = frame(RECORDS, "c date, s date")
    start, end = D(2021, 1, 1), D(2021, 3, 1)
    got = listed(trailing_counts.trailing_counts(df, "c", "s", start, end), "date")
    assert got == literal_counts(RECORDS, start, end)


def test_trailing_counts_on_random_records(spark):
    import random

    rng = random.Random(7)
    day = lambda: D(2021, 1, 1) + dt.timedelta(rng.randrange(120))
    records = [(day(), day()) for _ in range(400)]
    start, end = D(2021, 2, 1), D(2021, 4, 15)
    df = spark.createDataFrame(records, "c date, s date")
    assert listed(trailing_counts.trailing_counts(df, "c", "s", start, end), "date") == \
        literal_counts(records, start, end)


def test_refresh_equals_full_run(frame):
    df = frame(RECORDS, "c date, s date")
    start, mid, end = D(2021, 1, 1), D(2021, 1, 20), D(2021, 3, 1)
    full = trailing_counts.with_lag_30(
        trailing_counts.trailing_counts(df, "c", "s", start, end))
    old = trailing_counts.with_lag_30(
        trailing_counts.trailing_counts(df, "c", "s", start, mid))
    new = trailing_counts.refresh_series(old, df, "c", "s", end)
    assert listed(new, "date") == listed(full, "date")


def test_trailing_counts_plan_has_no_range_join(frame):
    df = frame(RECORDS, "c date, s date")
    out = trailing_counts.trailing_counts(df, "c", "s", D(2021, 1, 1), D(2021, 3, 1))
    plan = out._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_counts_with_totals(frame):
    df = frame([("k", "BA.2", "1"), ("k", "BA.2", "2"), ("k", None, "3"), ("k", "Z", None),
                (None, "BA.2", "5")], "c string, pango_lineage string, accession_id string")
    got = listed(lineage_counts.counts_with_lineage(df, ["c"]).select(
        "c", "pango_lineage", "n", "key_lineages"), "key_lineages")
    assert got == [("k", None, 3, "All lineages"), ("k", "BA.2", 2, "BA.2"),
                   ("k", "Z", 0, "Other lineages")]


def test_variant_groups_add_up(frame):
    wide = frame([(10, 3, None, 2, 1)], "`All lineages` int, `BA.1` int, `AY.4` int, "
                                        "`B.1.1.7` int, `Other lineages` int")
    r = lineage_counts.variant_group_columns(wide).first().asDict()
    assert (r["who_omicron"], r["who_delta"], r["who_alpha"], r["who_other"]) == (3, 0, 2, 5)
    assert sum(r[g] for g in K.VARIANT_GROUPS) + r["who_other"] == r["All lineages"]


def line_rows(frame, *names):
    day = D(2021, 1, 1)
    return frame([(day, "Peru", n, f"E{i}") for i, n in enumerate(names)],
                 "collect_date date, country string, pango_lineage string, accession_id string")


def test_lineage_columns_come_from_the_data(frame):
    rows = line_rows(frame, "BA.2", "BA.5", "XX", None, "BA.2")
    wide = country_day.wide_counts(rows, patterns=["BA.*"])
    assert wide.columns == ["collect_date", "country", "All lineages", "BA.2", "BA.5", "Other lineages"]
    assert tuple(wide.first())[2:] == (5, 2, 1, 1)
    more = country_day.wide_counts(rows.union(line_rows(frame, "BA.7")), patterns=["BA.*"])
    assert set(more.columns) - set(wide.columns) == {"BA.7"}


def test_a_lineage_without_a_column_raises(frame):
    rows = line_rows(frame, "BA.2", "BA.5", "XX")
    with pytest.raises(Exception, match="label without a column: BA.5"):
        country_day.wide_counts(rows, ["BA.2"], ["BA.*"]).collect()
    listed_all = country_day.wide_counts(rows, ["BA.2", "BA.5", "BA.9"], ["BA.*"]).first()
    assert tuple(listed_all)[2:] == (3, 1, 1, None, 1)


def test_pivot_of_present_labels(frame):
    long = frame([("a", "BA.2", 1), ("a", "x", 2), ("b", None, 4), ("b", "x", 5)],
                 "k string, key_lineages string, n long")
    wide = lineage_counts.pivot_lineages(long, ["k"])
    assert wide.columns == ["k", "BA.2", "x"]
    assert listed(wide, "k") == [("a", 1, 2), ("b", None, 5)]
    back = reshape.melt(wide, ["k"], ["BA.2", "x"]).dropna()
    assert listed(back, "k", "variable") == [("a", "BA.2", 1), ("a", "x", 2), ("b", "x", 5)]
    with pytest.raises(ValueError, match="more than 1 labels"):
        lineage_counts.present_labels(long, most=1)
    assert lineage_counts.pivot_lineages(long.limit(0), ["k"]).collect() == []


def test_wide_table_of_unknown_lineages(frame):
    clean = line_rows(frame, "BA.2", "XY.1", None).withColumn("submit_date", F.lit(D(2021, 1, 5)))
    cases = frame([(D(2021, 1, 1), "Peru", "South America", 10.0, 1.0, 1.0, 1.0, 1.0)],
                  "date date, location string, continent string, population double, new_cases double, "
                  "new_cases_smoothed double, new_people_vaccinated double, new_people_fully_vaccinated double")
    regions = frame([("Peru", "AMRO")], "Entity string, `WHO region` string")
    out = country_day.country_day_wide(clean, cases, regions, patterns=["BA.*", "XY.*"])
    row = out.filter("seq_country = 'Peru'").first().asDict()
    assert (row["All lineages"], row["BA.2"], row["XY.1"], row["Other lineages"]) == (3, 1, 1, None)


def test_lineage_order():
    assert lineage_counts.lineage_order(["BA.2", "x", "AY.4"]) == [
        "All lineages", "AY.4", "BA.2", "Other lineages"]


def test_lag_stats_interpolate(frame):
    df = frame([("k", 1), ("k", 2), ("k", 4), ("k", 10), ("k", None), (None, 3)],
               "c string, lag_days int")
    r = rollups.lag_stats(df, ["c"]).collect()
    assert [tuple(x) for x in r] == [("k", 4, 3.0, 1, 10, 1.75, 5.5)]


def test_location_rollup(frame):
    df = frame([("w", "Asia", "SEARO", 1.0), ("w", "Asia", None, None), ("w", None, None, 2.0),
                ("v", "Asia", None, None)],
               "week string, continent string, who_region string, x double")
    got = listed(rollups.location_rollup(df, ["week"], ["x"]).select(
        "week", "aggregate_location", "x"), "week", "aggregate_location")
    assert got == [("v", "Asia", 0.0), ("v", "Global", 0.0), ("w", "Asia", 1.0),
                   ("w", "Global", 3.0), ("w", "WHO Region: SEARO", 1.0)]


def test_overwrite_reported(frame):
    own = frame([("Asia", 1, 5.0), ("Asia", 2, 6.0), ("Peru", 1, 7.0)],
                "place string, week int, x double")
    reported = frame([("Asia", 1, 50.0)], "place string, week int, x double")
    got = listed(rollups.overwrite_reported(own, reported, ["place", "week"], "place", ["x"]),
                 "place", "week")
    assert got == [("Asia", 1, 50.0), ("Asia", 2, None), ("Peru", 1, 7.0)]


def test_cells_to_table(frame):
    head = [f"h{i}" for i in range(7)]
    row = lambda name, c, p: [name, c, "", p, "", "", ""]
    cells = head + row("Réunion (France)", "1,234", "5") + row("Peru", "x", "") + [
        "total (worldwide)", "9,999", "junk"]
    df = frame([(1, cells), (2, head), (3, None)], "page int, cells array<string>")
    got = listed(reshape.tracker_table(df), "page", "row")
    assert got == [(1, 0, "Réunion (France)", 1234, 5), (1, 1, "Peru", None, None)]


def test_melt_keeps_nulls(frame):
    df = frame([("Ohio", 1.0, None)], "State string, a double, b double")
    assert listed(reshape.melt(df, ["State"], ["a", "b"]), "variable") == [
        ("Ohio", "a", 1.0), ("Ohio", "b", None)]


def test_carousel_golden(frame):
    row = frame([(D(2021, 12, 8), 55, 1863, 1058, 1, 218, 451)],
                "submission_date date, n_countries_all bigint, n_cases_all bigint, n_seq bigint, "
                "daily_inc_countries bigint, daily_inc_seq bigint, daily_inc_all_cases bigint")
    got = listed(reshape.labelled_rows(row, K.CAROUSEL_ROWS, "submission_date").select(
        "order", "Total"), "order")
    assert got == [(1, 1863), (2, 55), (3, 1058), (4, 451), (5, 1), (6, 218)]


def test_reconcile(frame):
    a = frame([("x", 5), ("y", 2)], "code string, seq bigint")
    b = frame([("x", 3), ("x", 3), ("z", None)], "code string, confirmed bigint")
    rec = reconcile.reconcile(a, b, ["code"], "seq", "confirmed")
    assert listed(rec, "code") == [("x", 5, 3, 5), ("y", 2, None, 2), ("z", None, None, None)]
    assert tuple(reconcile.global_totals(rec, "seq", "confirmed").first()) == (7, 2, 3, 4, 7, 2)


def test_gates(frame):
    df = frame([("USA", D(2021, 1, 1), 5)], "code string, day date, n int")
    result = gates.evaluate(df, [
        gates.line_list_age("day", D(2021, 1, 8)),
        gates.line_list_age("day", D(2021, 1, 9)),
        gates.country_above("code", "CAN", "n", 10, "canada"),
    ])
    assert [r.passed for r in result.collect()] == [True, False, False]
    with pytest.raises(ValueError, match="canada"):
        gates.enforce(result)
    assert gates.evaluate(df.limit(0), [gates.has_rows()]).first().passed is False


def test_full_join_keyed_equals_full_join(frame):
    big = frame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    small = frame([("a", 10), ("z", 20), (None, 30)], "k string, w int")
    got = crosswalk.full_join_keyed(big, small, "k")
    want = big.join(small, "k", "full")
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(
        map(tuple, want.collect()), key=key)


def test_densify_from_the_first_day_seen(frame):
    facts = frame([("x", D(2021, 1, 2), 1), ("y", D(2021, 1, 3), 3)], "k string, date date, n int")
    dense = calendar.densify(facts, ["k"], None, D(2021, 1, 3))
    assert listed(dense, "k", "date") == [
        ("x", D(2021, 1, 2), 1), ("x", D(2021, 1, 3), None),
        ("y", D(2021, 1, 2), None), ("y", D(2021, 1, 3), 3)]


def test_densify_equals_grid_join(frame):
    day = lambda i: D(2021, 1, i)
    rows = [("a", day(1), 1), ("a", day(5), 2), ("a", day(5), 3), ("a", day(9), 4),
            ("b", day(2), 5), ("c", day(12), 6), ("c", day(20), 7), ("d", None, 8),
            ("e", day(4), 9), ("e", day(8), 10), ("f", day(3), 11), (None, day(5), 12),
            ("g", None, 13), ("g", day(6), 14)]
    facts = frame(rows, "k string, date date, n int")
    start, end = day(4), day(10)
    got = calendar.densify(facts, ["k"], start, end)
    want = calendar.day_grid(facts, ["k"], start, end).join(facts, ["k", "date"], "left")
    assert got.columns == want.columns
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(
        map(tuple, want.collect()), key=key)


def test_densify_rows_without_a_day(frame):
    facts = frame([("A", None, 1), ("A", None, 2), ("A", D(2021, 1, 2), 3), ("B", None, 4), ("B", None, 5)],
                  "code string, date date, n int")
    got = listed(calendar.densify(facts, ["code"], D(2021, 1, 1), D(2021, 1, 3)), "code", "date")
    days = [D(2021, 1, d) for d in (1, 2, 3)]
    assert got == [("A", days[0], None), ("A", days[1], 3), ("A", days[2], None)] + [("B", d, None) for d in days]


def test_reconcile_matches_null_codes(frame):
    a = frame([(None, "d", 5), ("A", "d", 1)], "code string, day string, x int")
    b = frame([(None, "d", 7), ("B", "d", 2)], "code string, day string, y int")
    got = {r.code: tuple(r) for r in reconcile.reconcile(a, b, ["code", "day"], "x", "y").collect()}
    assert got == {None: (None, "d", 5, 7, 7), "A": ("A", "d", 1, None, 1), "B": ("B", "d", None, 2, 2)}
