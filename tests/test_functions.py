import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import dates, lineages, numbers, text

D = dt.date


def column(spark, values, kind, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("x"))).collect()]


def test_title_case_keeps_listed_words(spark):
    got = column(spark, ["SOUTH africa", "isle of man", "cote d'Ivoire", "a  b", None], "string",
                 text.title_case)
    assert got == ["South Africa", "Isle of Man", "Cote d'Ivoire", "a  B", None]


def test_titlecased_fixes(spark):
    got = column(spark, ["usa", "PUERTO RICO", "u.s. virgin islands", "Jerusalem", "czech republic",
                         "republic of the congo", "france"], "string", text.fix_country_titlecased)
    # the case-blind USA test also finds the letters inside Jerusalem
    assert got == ["United States", "United States", "United States", "United States", "Czechia",
                   "Congo", "France"]


def test_plain_fixes(spark):
    got = column(spark, ["USA", "Usa", "usa", "czech republic", "Czech republic", "cote dIvoire",
                         "M?xico", "peru"], "string", text.fix_country_plain)
    assert got == ["United States", "United States", "Usa", "Czech Republic", "Czech Republic",
                   "Cote d'Ivoire", "Mexico", "Peru"]


@pytest.mark.parametrize("loc,want", [
    ("Europe / Spain / Madrid / X / Y", ["Europe", "Spain", "Madrid", "X"]),
    ("Europe/Spain", ["Europe", "Spain", None, None]),
    ("Europe /Spain/ Madrid", ["Europe", "Spain", "Madrid", None]),
    ("Europe / / Madrid", ["Europe", "", "Madrid", None]),
    ("a  /  b", ["a ", " b", None, None]),
])
def test_tight_parts(spark, loc, want):
    p = F.split(F.lit(loc), "/")
    row = spark.range(1).select(*(text.tight_part(p, i) for i in range(4))).first()
    assert list(row) == want


def test_location_part(spark):
    assert column(spark, ["Europe /  Spain ", "Europe"], "string",
                  lambda c: text.location_part(c, 1)) == ["Spain", None]
    assert column(spark, ["A / B"], "string", lambda c: text.location_part(c, 2, "")) == [""]


def test_numbers_as_text(spark):
    assert column(spark, ["12,881", "886", "n/a", None], "string", text.parse_grouped_int) == [
        12881, 886, None, None]
    assert column(spark, [1234567, -5], "bigint", text.grouped_int) == ["1,234,567", "-5"]
    assert column(spark, [12.0, 12.5], "double", text.number_text) == ["12", "12.5"]


def test_plus_uses_the_number(spark):
    got = column(spark, [3, 0, -2], "int", lambda c: text.with_plus(c.cast("string"), c))
    assert got == ["+ 3", "0", "-2"]


def test_dates(spark):
    days = ["2021-05", "2021-05-09", "2021-13-01", "junk", None]
    assert column(spark, days, "string", dates.lenient_date) == [
        D(2021, 5, 1), D(2021, 5, 9), None, None, None]
    assert column(spark, days, "string", dates.strict_date) == [
        None, D(2021, 5, 9), None, None, None]


def test_iso_weeks(spark):
    days = [D(2021, 1, 3), D(2021, 1, 4), D(2020, 12, 28)]
    assert column(spark, days, "date", dates.iso_yearweek) == ["2020-W53", "2021-W01", "2020-W53"]
    assert column(spark, days, "date", dates.week_start) == [
        D(2020, 12, 28), D(2021, 1, 4), D(2020, 12, 28)]
    assert column(spark, days, "date", dates.is_sunday) == [True, False, False]


def test_empty_day_sequence(spark):
    row = spark.range(1).select(dates.day_sequence(D(2021, 1, 2), D(2021, 1, 1))).first()
    assert row[0] == []


def test_division_by_zero_is_null(spark):
    assert column(spark, [0, 4], "bigint", lambda c: numbers.percent(F.lit(1), c)) == [None, 25.0]


def test_threshold(spark):
    got = column(spark, [0, 1, 100], "bigint", numbers.detection_threshold)
    assert got[0] == 100.0 and got[1] == pytest.approx(95.0)
    assert got[2] == pytest.approx(100 * (1 - 0.05 ** 0.01))


def test_threshold_floor_and_label(spark):
    assert column(spark, [0.0004, 0.014, 12.346, None], "double", numbers.floor_threshold) == [
        0.01, 0.01, 12.35, None]
    rows = spark.createDataFrame(
        [(0.01, 0.1), (95.0, 0.1), (95.0, 0.001), (95.0, None), (12.5, None)],
        "x double, t double")
    got = [r[0] for r in rows.select(
        numbers.threshold_label(F.col("x"), F.col("t"), "%")).collect()]
    assert got == ["<0.01%", "not estimated, insufficient recent sequencing",
                   "minimal recent COVID cases",
                   "not estimated, insufficient recent sequencing", "12.5%"]


def test_panel_and_dots(spark):
    rows = spark.createDataFrame(
        [(None, 0), (12.5, 99), (50.0, 100), (7.25, 101), (None, None)], "s double, n bigint")
    got = [r[0] for r in rows.select(numbers.panel_text(F.col("s"), F.col("n"))).collect()]
    assert got == ["No sequences were submitted from last week", "12.5 %*", "50 %", "7.25 %",
                   None]
    rows = spark.createDataFrame([(None, 0), (None, 3), (4.0, 3)], "s double, n bigint")
    got = [r[0] for r in rows.select(numbers.dots_value(F.col("s"), F.col("n"))).collect()]
    assert got == [None, 0.0, 4.0]


def test_larger_of_skips_null(spark):
    rows = spark.createDataFrame([(1, None), (None, None), (2, 5)], "a int, b int")
    got = [r[0] for r in rows.select(numbers.larger_of(F.col("a"), F.col("b"))).collect()]
    assert got == [1, None, 5]


def test_lineages(spark):
    names = ["BA.2", "BA.2.12.1", "XBA.2", "BA.4", "B.1.429", "AY.4", "Q", None]
    fam = lambda mode: column(spark, names, "string",
                              lambda c: lineages.lineage_family(c, ["BA.2"], mode))
    assert fam("substring") == [True, True, True, False, False, False, False, None]
    assert fam("prefix") == [True, True, False, False, False, False, False, None]
    assert fam("exact") == [True, False, False, False, False, False, False, None]
    assert column(spark, names, "string", lineages.key_lineage) == [
        "BA.2", "BA.2.12.1", "Other lineages", "BA.4", "B.1.427/429", "AY.4", "Other lineages",
        "Other lineages"]
    assert column(spark, names[:7], "string", lineages.variant_group) == [
        "who_omicron", "who_omicron", "who_other", "who_omicron", "who_other", "who_delta",
        "who_other"]
    assert lineages.match_names(["AY.*", "B.1"], ["B.1", "AY.4", "AYX", "B.1.1"]) == [
        "AY.4", "B.1"]
    with pytest.raises(ValueError):
        lineages.lineage_family(F.col("x"), ["BA.2"], "regex")
