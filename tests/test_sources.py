import datetime as dt
import os
import time

import pytest

from tidewatch.operators import trailing_counts
from tidewatch.plans import extracts, line_list
from tidewatch.operators import crosswalk, flags
from tidewatch.session import shared_folder
from tidewatch.sources import readers, schemas, writers
from tidewatch.streaming import feed as live
from tidewatch import constants as K

D = dt.date


def listed(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_country_dimension_with_bom_and_na(spark, tmp_path):
    path = put(tmp_path / "c.csv", "﻿Country,Longitude,Latitude,World Bank region,"
               "Population (2019),World Bank region (short),2-letter ISO code,3-letter ISO code\n"
               "Namibia,17.0,-22.5,Africa,2494530,AFR,NA,NAM\n"
               "United States,-77.0,38.9,Other,328239523,Other,US,USA\n"
               "United States,-77.0,38.9,Other,328239523,Other,US,USA\n")
    df = readers.read_countries(spark, path)
    assert "x3_letter_iso_code" in df.columns
    rows = {r.x2_letter_iso_code: r for r in df.collect()}
    assert rows["NA"].country == "Namibia" and rows["NA"].population_2019 == 2494530
    cw = crosswalk.build_crosswalk(df, "country", "x3_letter_iso_code")
    assert cw.count() == 2


def test_feed_of_both_widths(spark, tmp_path):
    put(tmp_path / "a.csv", "E1,Peru,A / Peru,2021-02-02,2021-01-01,G,BA.2\n")
    put(tmp_path / "b.csv", "E2,Chad,A / Chad,2021-02-03,2021-01-02,G,BA.1,VOC\n"
        "E3,Chad,A / Chad,bad,2021-01-02,G,,\n")
    df = readers.read_feed(spark, str(tmp_path))
    assert df.columns == ["accession_id", "country", "location", "submission_date",
                          "collection_date", "clade", "pango_lineage"]
    got = {r.accession_id: (r.submission_date, r.pango_lineage) for r in df.collect()}
    assert got == {"E1": (D(2021, 2, 2), "BA.2"), "E2": (D(2021, 2, 3), "BA.1"),
                   "E3": (None, None)}


def test_folder_of_submissions(spark, tmp_path):
    head = "Accession ID\tLocation\tSubmission date\tLineage\n"
    put(tmp_path / "1.tsv", head + "E1\tAfrica / Chad\t2021-12-01\tB.1\n")
    put(tmp_path / "2.tsv", head + "E2\tAfrica / Chad\t2021-12-01\tB.1\n"
        "E3\tAsia / Iran\t2021-12-03\tB.1\n")
    df = readers.read_submissions(spark, str(tmp_path))
    cw = crosswalk.build_crosswalk(
        readers.literal_table(spark, [("Chad", "TCD")], ["n", "c"]), "n", "c")
    got = sorted((r.country, str(r.submission_date), r.n or 0, r.code or "")
                 for r in line_list.submission_grid(df, cw).collect())
    assert got == [("Chad", "2021-12-01", 2, "TCD"), ("Chad", "2021-12-03", 0, "TCD"),
                   ("Iran", "2021-12-01", 0, "IRN"), ("Iran", "2021-12-03", 1, "IRN")]


def test_case_scan_reads_only_needed_columns(spark, tmp_path):
    names = schemas.CASES.fieldNames()
    path = put(tmp_path / "cases.csv", ",".join(names) + "\n" + ",".join(
        ["PER", "", "Peru", "2021-01-01"] + ["1"] * (len(names) - 4)) + "\n")
    df = readers.read_cases(spark, path, ["iso_code", "date"])
    assert [tuple(r) for r in df.collect()] == [("PER", D(2021, 1, 1))]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<iso_code:string,date:date>" in plan


def metadata_row(**over):
    row = dict.fromkeys(K.METADATA_COLUMNS)
    row |= {"Virus name": "hCoV-19/x/1", "Accession ID": "E1", "Collection date": "2021-03-02",
            "Location": "Europe / england / Kent", "Sequence length": 29000, "Host": "Human",
            "Pango lineage": "B.1", "Submission date": "2021-03-12", "N-Content": 0.01,
            "GC-Content": 0.38}
    return tuple((row | over)[c] for c in K.METADATA_COLUMNS)


def test_clean_metadata_from_tsv(spark, tmp_path):
    rows = [metadata_row(), metadata_row(**{"Collection date": "2021-03", "Location": "Asia/Iran"}),
            metadata_row(**{"Virus name": "hCoV-19/bad/9", "Pango lineage": None})]
    text = "\t".join(K.METADATA_COLUMNS) + "\n" + "".join(
        "\t".join("" if v is None else str(v) for v in r) + "\n" for r in rows)
    df = readers.read_metadata(spark, put(tmp_path / "m.tsv", text))
    lines = readers.read_lines(spark, put(tmp_path / "x.txt", "# comment\n\nbad/9\n"))
    out = line_list.clean_line_list(df, flags.exclusion_names(lines), D(2021, 12, 1)).collect()
    got = [(r.country, r.division, str(r.collect_date), r.lag_days, r.collect_yearweek, r.excluded,
            r.abnormal_date, r.any_abnormal) for r in out]
    assert sorted(got) == [
        ("Iran", "", "2021-03-01", 11, "2021-W09", False, True, True),
        ("United Kingdom", "Kent", "2021-03-02", 10, "2021-W09", False, False, False),
        ("United Kingdom", "Kent", "2021-03-02", 10, "2021-W09", True, False, True)]
    with pytest.raises(ValueError):
        line_list.clean_line_list(df.drop("Host"), flags.exclusion_names(lines), D(2021, 12, 1))


CASE_ROW = {"iso_code": "PER", "location": "Peru", "date": "2021-01-01", "population": "33000000",
            "people_vaccinated": "12", "new_cases": "3"}


def case_file(path, header):
    return put(path, ",".join(header) + "\n" + ",".join(CASE_ROW.get(c, "") for c in header) + "\n")


@pytest.mark.parametrize("change", [
    lambda names: names[::-1], lambda names: ["extra", *names[:9], "other", *names[9:]],
    lambda names: ["\ufeff" + names[0], *names[1:]]])
def test_columns_are_read_by_name(spark, tmp_path, change):
    path = case_file(tmp_path / "c.csv", change(schemas.CASES.fieldNames()))
    df = readers.read_cases(spark, path)
    assert df.schema == schemas.CASES
    row = df.first()
    assert (row.location, row.date, row.population, row.people_vaccinated, row.new_cases) == (
        "Peru", D(2021, 1, 1), 33000000.0, 12.0, 3.0)


def test_narrow_files(spark, tmp_path):
    path = case_file(tmp_path / "c.csv", ["date", "iso_code"])
    assert [tuple(r) for r in readers.read_cases(spark, path, ["iso_code"]).collect()] == [("PER",)]
    with pytest.raises(ValueError, match="population"):
        readers.read_cases(spark, path)


def test_headers_that_differ_between_files(spark, tmp_path):
    folder = tmp_path / "two words"
    folder.mkdir()
    names = schemas.CASES.fieldNames()
    for i, header in enumerate((names, names[::-1], ["more", *names])):
        case_file(folder / f"{i}.csv", header)
    put(folder / "3.csv", "")
    rows = readers.read_cases(spark, str(folder)).collect()
    assert len(rows) == 3 and len(set(rows)) == 1 and rows[0].population == 33000000.0


def jobs_of(spark, name, run):
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        run()
        return len(sc.statusTracker().getJobIdsForGroup(name))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def many_case_files(folder, n, headers):
    folder.mkdir()
    names = schemas.CASES.fieldNames()
    for i in range(n):
        case_file(folder / f"{i:03d}.csv", names[i % headers:] + names[:i % headers])
    return str(folder)


@pytest.mark.parametrize("headers, sizes", [(1, (50, 100)), (3, (100, 150))])
def test_jobs_do_not_grow_with_files(spark, tmp_path, headers, sizes):
    few, many = (many_case_files(tmp_path / str(n), n, headers) for n in sizes)
    jobs = [jobs_of(spark, path, lambda: readers.read_cases(spark, path)) for path in (few, many)]
    assert jobs[0] == jobs[1] <= 4 + headers
    start = time.perf_counter()
    df = readers.read_cases(spark, many)
    assert time.perf_counter() - start < 10
    assert df.count() == sizes[1] and df.distinct().count() == 1


def test_headers_of_split_and_odd_files(spark, tmp_path):
    names = schemas.CASES.fieldNames()
    folder = tmp_path / "odd"
    folder.mkdir()
    body = ",".join(CASE_ROW.get(c, "") for c in names) + "\n"
    put(folder / "long.csv", ",".join(names) + "\n" + body * 40_000)
    put(folder / "longer.csv", "\n" + ",".join(names[::-1]) + "\n"
        + ",".join(CASE_ROW.get(c, "") for c in names[::-1]) + "\n" + "," * (len(names) - 1) + "\n"
        + (" " * 1000 + "," * (len(names) - 1) + "\n") * 5000)
    put(folder / "blank first.csv", "\n\n" + ",".join(f'"{c}"' for c in names) + "\n" + body)
    put(folder / "blank.csv", "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300k")
    try:
        df = readers.read_cases(spark, str(folder))
        assert df.filter("location = 'Peru'").count() == 40_002
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_metadata_without_host(spark, tmp_path):
    names = [c for c in K.METADATA_COLUMNS if c != "Host"]
    with pytest.raises(ValueError, match="Host"):
        readers.read_metadata(spark, put(tmp_path / "m.tsv", "\t".join(names) + "\n"))


def test_geometry_with_swapped_columns(spark, tmp_path):
    path = put(tmp_path / "g.txt", "Name\t3-letter ISO code\tgeometry\nPeru\tPER\tPOLY((1,2))\n")
    assert [tuple(r) for r in readers.read_geometry(spark, path).collect()] == [
        ("POLY((1,2))", "Peru", "PER")]


def test_sinks(spark, frame, tmp_path):
    df = frame([("a", 1), ("b", 2)], "k string, n int")
    writers.write_csv(df, str(tmp_path / "csv"))
    writers.write_csv(df, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 2
    writers.append_rows(df, str(tmp_path / "log"))
    writers.append_rows(df, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 4


def test_snapshots_are_added_once(spark, frame, tmp_path):
    path = str(tmp_path / "snap")
    at = lambda h: frame([("Peru", 5, dt.datetime(2021, 12, 1, h))],
                         "location string, confirmed int, timestamp timestamp")
    for h in (9, 12, 12):
        writers.write_snapshot(at(h), path)
    rows = spark.read.parquet(path)
    assert rows.count() == 2
    assert {r.snapshot_hour for r in rows.collect()} == {"2021-12-01-09", "2021-12-01-12"}


def test_snapshots_of_one_hour_are_kept(spark, frame, tmp_path):
    path = str(tmp_path / "snap")
    for minute in (5, 40, 40):
        writers.write_snapshot(frame([("Peru", minute, dt.datetime(2021, 12, 1, 12, minute))],
                                     "location string, confirmed int, timestamp timestamp"), path)
    assert sorted(r.confirmed for r in spark.read.parquet(path).collect()) == [5, 40]


def test_refreshed_master(spark, frame, tmp_path):
    records = frame([(D(2021, 1, 1), D(2021, 1, 5)), (D(2021, 1, 20), D(2021, 1, 21))],
                    "c date, s date")
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    full = lambda end: trailing_counts.with_lag_30(
        trailing_counts.trailing_counts(records, "c", "s", D(2021, 1, 1), end))
    writers.write_table(full(D(2021, 1, 10)), a)
    writers.refresh_master(spark, a, b, records, "c", "s", D(2021, 2, 20))
    got = spark.read.parquet(b).orderBy("date").collect()
    assert got == full(D(2021, 2, 20)).orderBy("date").collect()
    with pytest.raises(ValueError):
        writers.refresh_master(spark, a, a + "/", records, "c", "s", D(2021, 2, 20))


def test_feed_kept_up_incrementally(spark, tmp_path):
    landing, deltas = tmp_path / "in", str(tmp_path / "deltas")
    landing.mkdir()
    line = "{},Peru,A / Peru,{},{},G,BA.2\n"
    put(landing / "1.csv", line.format("E1", "2021-01-05", "2021-01-01"))

    def run():
        q = live.keep_deltas(live.landed_feed(spark, str(landing)), deltas,
                             str(tmp_path / "checkpoint"))
        q.awaitTermination(120)

    run()
    put(landing / "2.csv", line.format("E2", "2021-01-20", "2021-01-03")
        + line.format("E3", "2021-01-20", "2021-01-18"))
    run()
    run()
    feed = readers.read_feed(spark, str(landing))
    want = trailing_counts.with_lag_30(trailing_counts.trailing_counts(
        feed, "collection_date", "submission_date", D(2021, 1, 1), D(2021, 3, 1)))
    got = live.current_series(spark, deltas, D(2021, 1, 1), D(2021, 3, 1))
    assert got.orderBy("date").collect() == want.orderBy("date").collect()
    assert max(r.n for r in got.collect()) == 3
    with pytest.raises(ValueError, match="another checkpoint"):
        live.keep_deltas(live.landed_feed(spark, str(landing)), deltas, str(tmp_path / "new"))


@pytest.mark.parametrize("compact_every", [100, 2])
def test_series_of_three_countries_kept_up(spark, tmp_path, compact_every):
    landing, deltas, root = tmp_path / "in", str(tmp_path / "deltas"), str(tmp_path / "checkpoint")
    landing.mkdir()
    line = "E,{0},A / {0},{1},{2},G,BA.2\n"
    start, end, keys = D(2021, 1, 1), D(2021, 3, 1), ["country"]

    def run():
        live.keep_deltas(live.landed_feed(spark, str(landing), files_per_batch=1), deltas, root, keys=keys,
                         compact_every=compact_every).awaitTermination(120)

    def check():
        feed = readers.read_feed(spark, str(landing))
        want = trailing_counts.with_lag_30(trailing_counts.trailing_counts(
            feed, "collection_date", "submission_date", start, end, keys), keys=keys)
        got = live.current_series(spark, deltas, start, end, keys)
        assert listed(got, "country", "date") == listed(want.select(got.columns), "country", "date")
        assert {r.country for r in got.collect()} <= {"Peru", "Chad", "Iran"}

    files = [[("Peru", "2021-01-05", "2021-01-01"), ("Chad", "2021-01-09", "2021-01-02")],
             [("Iran", "2021-01-20", "2021-01-18"), ("Peru", "2021-01-20", "2021-01-03")],
             [("Chad", "2021-02-25", "2021-01-30")],
             [("Peru", "2021-01-21", "2021-01-02"), ("Iran", "2021-02-02", "2021-02-01")],  # late
             [("Chad", "2021-02-01", "2021-01-30")]]
    for i, rows in enumerate(files):
        put(landing / f"{i}.csv", "".join(line.format(*r) for r in rows))
        if i != 2:
            run()
            check()
    run()
    live.compact_deltas(spark, deltas)
    live.compact_deltas(spark, deltas)
    check()
    put(landing / "9.csv", line.format("Peru", "2021-02-21", "2021-02-20"))
    run()
    check()
    live.compact_deltas(spark, deltas)
    check()
    left = [f for f in os.listdir(deltas) if f.startswith("batch_id=")]
    assert len(left) <= 2 + compact_every and "batch_id=0" not in left


def test_a_batch_run_again_after_a_compaction(spark, tmp_path):
    """The newest batch may be stored twice; a compaction must not hold it."""
    landing, deltas = tmp_path / "in", str(tmp_path / "deltas")
    landing.mkdir()
    for i in range(3):
        put(landing / f"{i}.csv", f"E{i},Peru,A / Peru,2021-01-0{i + 1},2021-01-01,G,BA.2\n")
    feed = live.landed_feed(spark, str(landing), files_per_batch=1)
    live.keep_deltas(feed, deltas, str(tmp_path / "checkpoint")).awaitTermination(120)
    before = listed(live.current_series(spark, deltas, D(2021, 1, 1), D(2021, 1, 9)), "date")
    newest = spark.read.parquet(deltas).filter("batch_id = 2").cache()
    newest.count()
    live.compact_deltas(spark, deltas, 99)
    newest.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(deltas)
    assert listed(live.current_series(spark, deltas, D(2021, 1, 1), D(2021, 1, 9)), "date") == before
    assert [r[1] for r in before][-1] == 3


def test_master_of_day_partitions(spark, frame, tmp_path):
    path, other = str(tmp_path / "snap"), str(tmp_path / "compacted")
    at = lambda day, hour, n, place="Peru": (place, n, None if day is None else dt.datetime(2021, 12, day, hour, n % 60))
    schema = "location string, confirmed int, timestamp timestamp"
    scrapes = [[at(1, h, h), at(1, h, h, "Chad")] for h in (9, 12, 12, 23)] + [[at(2, 0, 5), at(1, 9, 10)]] + [[at(None, 0, 0)]] * 2
    for rows in scrapes + scrapes:
        writers.write_snapshot(frame(rows, schema), path)
    want = sorted({r for rows in scrapes for r in rows}, key=str)
    for where in (path, other):
        got = spark.read.parquet(where).select("location", "confirmed", "timestamp")
        assert sorted(map(tuple, got.collect()), key=str) == want
        days = [f for f in os.listdir(where) if f.startswith("snapshot_day=")]
        assert len(days) == 3
        assert all(len([f for f in os.listdir(f"{where}/{d}") if f.endswith(".parquet")]) == 1 for d in days)
        writers.compact_snapshots(spark, path, other)
    with pytest.raises(ValueError):
        writers.compact_snapshots(spark, path, path + "/")


def test_compaction_of_one_partition_a_scrape(spark, frame, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    rows = frame([("Peru", h, dt.datetime(2021, 12, 1 + h % 2, h)) for h in range(20)],
                 "location string, confirmed int, timestamp timestamp")
    rows.selectExpr("*", "date_format(timestamp, 'yyyy-MM-dd-HH') AS snapshot_hour", "'m00s00' AS snapshot_time").write.partitionBy(
        "snapshot_hour", "snapshot_time").parquet(old)
    writers.compact_snapshots(spark, old, new)
    got = spark.read.parquet(new)
    assert sorted(r.confirmed for r in got.collect()) == list(range(20))
    assert got.filter("snapshot_hour = '2021-12-02-13'").count() == 1
    assert len([f for f in os.listdir(new) if f.startswith("snapshot_day=")]) == 2


def test_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark, "/tmp/x") == (named or "/tmp/x")
    if named is None:
        with pytest.raises(ValueError):
            shared_folder(spark)


def test_flow_keys_split_per_row(frame):
    df = frame([("2021-06-07_2021-06-13", "1 1", 2.0), ("2021-06-14_2021-06-20", "2 3", 4.0)],
               "`Group.1` string, `Group.2` string, x double")
    got = [tuple(r) for r in extracts.flow_table(df).orderBy("i").collect()]
    assert got == [(D(2021, 6, 7), D(2021, 6, 13), 1, 1, 2.0),
                   (D(2021, 6, 14), D(2021, 6, 20), 2, 3, 4.0)]
    assert extracts.flow_diagonal(df).count() == 1


def test_geometry(spark, tmp_path):
    path = put(tmp_path / "g.txt", "geometry\tName\t3-letter ISO code\nPOLY((1,2))\tPeru\tPER\n")
    df = readers.read_geometry(spark, path)
    assert [tuple(r) for r in df.collect()] == [("POLY((1,2))", "Peru", "PER")]
