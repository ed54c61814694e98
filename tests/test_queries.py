"""Every query against its SQL on the smallest tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import check_oracle
from workload import queries as W
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in check_oracle.TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


def test_entry(spark):
    assert E.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_same_as_sql(spark, con, name):
    line, ok = check_oracle.compare(name, spark, con, SF)
    assert ok, line


def test_lineage_columns_add_up(spark):
    wide = E.queries()["lineage_pivot"](spark, SF)
    parts = [c for c in wide.columns if c.startswith("Brand#") or c == "Other lineages"]
    total = sum(F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in parts)
    assert len(parts) == 13 and wide.filter(total != F.col("`All lineages`")).count() == 0


@pytest.mark.parametrize("name, folder, least", [("seq_kept_up", "landing", 6), ("submission_files", "submissions", 20)])
def test_landed_files_grow_in_number_not_in_size(spark, con, tmp_path, monkeypatch, name, folder, least):
    """So does what the task that writes one reads."""
    monkeypatch.setattr(W, "FILE_RECORDS", 100)
    monkeypatch.setattr(W, "scratch_folder", lambda spark: str(tmp_path))
    line, ok = check_oracle.compare(name, spark, con, SF)
    assert ok, line
    sizes = [sum(1 for _ in p.open()) for p in tmp_path.rglob("*.csv") if folder in p.parts]
    assert len(sizes) > least and len(sizes) % least == 0
    assert max(sizes) <= 150 < sum(sizes) / least
