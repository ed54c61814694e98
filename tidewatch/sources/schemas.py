"""Explicit schemas of the landed files (nothing is inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

from tidewatch import constants as K


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


_S, _D, _L, _F, _TS = (
    T.StringType(), T.DateType(), T.LongType(), T.DoubleType(), T.TimestampNTZType())

_NUMERIC_METADATA = {"Sequence length": _L, "N-Content": _F, "GC-Content": _F}
METADATA = T.StructType([
    T.StructField(name, _NUMERIC_METADATA.get(name, _S)) for name in K.METADATA_COLUMNS])

FEED = _schema(
    accession_id=_S, country=_S, location=_S, submission_date=_D, collection_date=_D,
    clade=_S, pango_lineage=_S, variant=_S)
SUBMISSIONS = T.StructType([
    T.StructField("Accession ID", _S), T.StructField("Location", _S),
    T.StructField("Submission date", _D), T.StructField("Lineage", _S)])
CASES = _schema(
    iso_code=_S, continent=_S, location=_S, date=_D, total_cases=_F, new_cases=_F,
    new_cases_smoothed=_F, total_deaths=_F, new_deaths=_F, population=_F,
    people_vaccinated=_F, people_fully_vaccinated=_F, people_vaccinated_per_hundred=_F,
    people_fully_vaccinated_per_hundred=_F)
TESTING = T.StructType([
    T.StructField("name", _S), T.StructField("unit", _S), T.StructField("set", _S),
    T.StructField("time", _D), T.StructField("pop_100k", _F),
    T.StructField("cap_new_tests", _F), T.StructField("cap_cum_tests", _F),
    T.StructField("all_new_tests", _F), T.StructField("all_cum_tests", _F),
    T.StructField("all_cum_cases", _F)])
SNAPSHOTS = _schema(location=_S, confirmed=_L, probable=_L, code=_S, timestamp=_TS)
FEED_COUNTS = _schema(country=_S, submission_date=_D, n=_L, code=_S)
SERIES = _schema(date=_D, n=_L, n_lag_30=_L, r=_F)
COUNTRIES = T.StructType([
    T.StructField("Country", _S), T.StructField("Longitude", _F),
    T.StructField("Latitude", _F), T.StructField("World Bank region", _S),
    T.StructField("Population (2019)", _L),
    T.StructField("World Bank region (short)", _S),
    T.StructField("2-letter ISO code", _S), T.StructField("3-letter ISO code", _S)])
GEOMETRY = T.StructType([
    T.StructField("geometry", _S), T.StructField("Name", _S),
    T.StructField("3-letter ISO code", _S)])
FLOWS = T.StructType([
    T.StructField("Group.1", _S), T.StructField("Group.2", _S), T.StructField("x", _F)])
