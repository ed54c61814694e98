"""Country names as people write them."""

import pytest
from pyspark.sql import functions as F

from tidewatch import constants as K
from tidewatch.functions import places
from tidewatch.operators import crosswalk, gates
from tidewatch.plans import extracts, line_list

import datetime as dt

WRITTEN = {
    "KOR": ["South Korea", "Republic of Korea", "Korea, Rep.", "Korea", "Korea (South)"],
    "PRK": ["North Korea", "Korea, Dem. People's Rep.", "Democratic People's Republic of Korea"],
    "RUS": ["Russia", "Russian Federation"],
    "IRN": ["Iran", "Iran, Islamic Rep.", "Iran (Islamic Republic of)"],
    "CZE": ["Czechia", "Czech Republic", "Czech republic"],
    "SYR": ["Syria", "Syrian Arab Republic"],
    "LAO": ["Laos", "Lao PDR", "Lao People's Democratic Republic"],
    "CIV": ["Côte d'Ivoire", "Côte d’Ivoire", "Cote dIvoire", "Ivory Coast"],
    "USA": ["USA", "U.S.A.", "U.S.", "United States", "United States of America"],
    "GBR": ["UK", "U.K.", "United Kingdom", "Great Britain"],
    "MKD": ["Macedonia", "North Macedonia"],
    "CPV": ["Cape Verde", "Cabo Verde"],
    "MMR": ["Burma", "Myanmar", "Myanmar (Burma)"],
    "SWZ": ["Swaziland", "Eswatini"],
    "COD": ["Congo, Dem. Rep.", "Congo (Kinshasa)", "DR Congo", "Democratic Republic of Congo"],
    "COG": ["Congo, Rep.", "Republic of the Congo", "Congo (Brazzaville)"],
    "VIR": ["U.S. Virgin Islands", "Virgin Islands (U.S.)", "United States Virgin Islands"],
    "VGB": ["British Virgin Islands"],
    "PNG": ["Papua New Guinea"], "GNQ": ["Equatorial Guinea"], "GNB": ["Guinea Bissau"], "GIN": ["Guinea"],
    "NER": ["Niger"], "NGA": ["Nigeria"], "DMA": ["Dominica"], "DOM": ["Dominican Republic"],
    "SSD": ["South Sudan"], "SDN": ["Sudan"], "ASM": ["American Samoa"], "WSM": ["Samoa"],
    "HKG": ["Hong Kong SAR, China"], "MAC": ["Macao SAR, China"], "TWN": ["Taiwan, China"], "CHN": ["China"],
    "REU": ["Réunion (France)", "Reunion"], "MAF": ["Saint Martin (French part)"],
    "FSM": ["Micronesia (country)", "Micronesia, Fed. Sts."], "TLS": ["Timor", "Timor-Leste"],
    "VNM": ["Viet Nam", "Vietnam"], "TUR": ["Türkiye", "Turkey"], "MEX": ["México"], "VCT": ["St Vincent & Grenadines"],
    "TTO": ["Trinidad and Tobago"], "BHS": ["Bahamas, The"], "BOL": ["Bolivia (Plurinational State of)"],
    None: ["Northern Ireland", "New Mexico", "Serbia and Montenegro", "Virgin Islands", "England", "total",
           "Kosovo", "", " ", "()", None],
}


def test_names_by_words(frame):
    rows = [(n, code) for code, names in WRITTEN.items() for n in names]
    df = frame(rows, "name string, code string").withColumn("got", places.country_by_words(F.col("name")))
    wrong = [tuple(r) for r in df.filter("not (code <=> got)").collect()]
    assert not wrong
    upper = df.withColumn("got", places.country_by_words(F.upper(F.concat(F.lit("  "), "name"))))
    assert upper.filter("not (code <=> got)").count() == 0


def test_every_listed_country_finds_itself(frame):
    countries = places.iso_countries()
    assert len({c for c, _ in countries}) == len(countries) > 240
    df = frame(list(countries), "code string, name string")
    assert df.filter(places.country_by_words(F.col("name")) != F.col("code")).count() == 0
    assert df.filter(places.country_by_words(F.col("name")).isNull()).count() == 0


def test_rules_are_words_that_names_can_have(spark):
    for _, needs, bars in places.name_rules():
        assert needs and not set(needs) & set(bars)
        assert not {*needs, *bars} & {*K.NAME_CONNECTORS, *K.NAME_ABBREVIATIONS}


@pytest.fixture
def table(frame):
    dim = frame([("Korea, Rep.", "KOR"), ("Peru", "PER"), ("Kosovo", "KSV")], "name string, code string")
    return crosswalk.build_crosswalk(dim, "name", "code", K.LINE_LIST_CODE_OVERRIDES)


def test_the_table_decides_first(frame, table):
    df = frame([("Kosovo",), ("Peru",), ("South Korea",), ("Nowhere",), (None,)], "country string")
    got = {r.country: r.code for r in crosswalk.add_code(df, "country", table).collect()}
    assert got == {"Kosovo": "XKX", "Peru": "PER", "South Korea": "KOR", "Nowhere": None, None: None}
    exact = {r.country: r.code for r in crosswalk.add_code(df, "country", table, by_words=False).collect()}
    assert exact == got | {"South Korea": None}
    assert crosswalk.add_code(df, "country", table, drop_unmatched=True).count() == 3
    assert {r.country for r in crosswalk.unmatched_names(df, "country", table).collect()} == {"Nowhere", None}


def test_line_list_keeps_known_countries(frame, table):
    names = ["South Korea", "Russia", "Iran", "Czechia", "Laos", "Syria", "Cape Verde", "USA", "UK", "Côte d'Ivoire",
             "Macedonia", "Burma", "Swaziland", "Republic of Korea", "United States of America"]
    feed = frame([(f"X / {n} / Y", "2021-02-02", "2021-01-01") for n in [*names, "Nowhere"]],
                 "location string, submission_date string, collection_date string")
    coded = line_list.code_line_list(feed, table, dt.date(2021, 3, 1))
    assert coded.count() == len(names)
    assert {r.code for r in coded.collect()} == {
        "KOR", "RUS", "IRN", "CZE", "LAO", "SYR", "CPV", "USA", "GBR", "CIV", "MKD", "MMR", "SWZ"}


def test_gate_on_names_without_a_code(frame, table):
    df = crosswalk.add_code(frame([("Peru",)] * 18 + [("Nowhere",)] * 2, "country string"), "country", table)
    one = gates.evaluate(df, [gates.coded_share("code"), gates.coded_share("code", 0.9)]).collect()
    assert [(r.observed, r.passed) for r in one] == [(0.9, False), (0.9, True)]


def test_names_and_continents_of_codes(frame):
    df = frame([("KOR", None), ("USA", "x"), ("XKX", "Europe"), (None, None)], "code string, continent string")
    named = {r.code: r.country_name for r in crosswalk.add_name(df, "code").collect()}
    assert named == {"KOR": "South Korea", "USA": "United States", "XKX": None, None: None}
    series = frame([("KOR", "Asia"), ("KOR", None), ("USA", "North America"), (None, "Asia")],
                   "iso_code string, continent string")
    by_code = crosswalk.continents(series)
    got = {r.code: r.continent for r in crosswalk.add_continent(df, "code", by_code).collect()}
    assert got == {"KOR": "Asia", "USA": "Americas", "XKX": None, None: None}


def test_snapshot_of_written_names(frame, table):
    head = ["Location", "Confirmed", "", "Probable", "", "", ""]
    row = lambda name: [name, "1,200", "", "3", "", "", ""]
    end = [K.TABLE_END_MARK, *[""] * 6]
    cells = [*head, *row("Réunion (France)"), *row("South Korea"), *row("Atlantis"), *end]
    pages = frame([(cells, dt.datetime(2021, 12, 22, 13))], "cells array<string>, taken timestamp")
    got = {r.location: r.code for r in extracts.capture_snapshot(pages, table, "taken").collect()}
    assert {got[x] for x in got if x.startswith("R")} == {"REU"}
    assert got["South Korea"] == "KOR" and got["Atlantis"] is None


def test_one_read_of_the_facts(spark, table, tmp_path):
    spark.range(10).selectExpr("'Iran' AS country", "id").write.parquet(str(tmp_path / "facts"))
    df = crosswalk.add_code(spark.read.parquet(str(tmp_path / "facts")), "country", table, drop_unmatched=True)
    assert df.count() == 10
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") <= 2  # AQE shows plans twice
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [country") == 1


def test_words_of_a_name_are_taken_once(spark, table):
    df = spark.range(2).select(F.concat(F.lit("Iran"), F.col("id").cast("string")).alias("country"))
    # two expressions for the whole name, two for the part before a parenthesis
    counts = [out._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") for out in (
        df.select(places.country_by_words(F.col("country")).alias("code")),
        crosswalk.add_code(df, "country", table, drop_unmatched=True))]
    assert counts == [4, 4]


def test_known_names_replace_a_column_in_place(frame, table):
    df = frame([("old", "Peru", 1), ("old", "Nowhere", 2)], "code string, country string, n int")
    out = crosswalk.add_code(df, "country", table, drop_unmatched=True)
    assert [tuple(r) for r in out.collect()] == [("PER", "Peru", 1)]
    assert out.columns == df.columns
