"""How often the jobs read their largest tables, in the plans that run."""

import os
import re

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as E
from tidewatch.operators import filters, lineage_counts, windows

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture
def plan_of(spark):
    """The physical plan with its subqueries; what is reused is named, not repeated."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def scans(plan, table):
    return len(re.findall(rf"FileScan parquet.*{table}\.parquet", plan))


@pytest.mark.parametrize("name, table, most", [
    ("topline_table", "lineitem", 0), ("topline_table", "orders", 1), ("global_series", "lineitem", 0),
    ("map_attributes", "lineitem", 0), ("map_polygons", "lineitem", 0), ("map_polygons", "orders", 1),
    ("latest_snapshot", "events", 1), ("reconciled_summary", "events", 1),
    ("nearest_snapshot", "events", 1), ("nearest_event", "events", 1), ("topline_table", "events", 1),
    ("seq_refresh", "lineitem", 1), ("submission_grid", "lineitem", 0), ("flow_diagonal", "lineitem", 0), ("vaccination_overwrite", "orders", 1)])
def test_scans(spark, plan_of, name, table, most):
    """The line list is read by the job that stores its cube, and not again."""
    assert scans(plan_of(E.queries()[name](spark, SF)), table) <= most


def test_cube_reads_the_line_list_once(spark, plan_of, monkeypatch):
    seen = []
    monkeypatch.setattr(lineage_counts, "stored", lambda df: seen.append(df) or df)
    E.queries()["topline_table"](spark, SF)
    assert [scans(plan_of(df), "lineitem") for df in seen] == [1]


def test_newest_rows_are_picked_before_they_move(spark, plan_of):
    df = spark.range(1000).withColumn("ts", F.col("id") % 50)
    newest = windows.latest_snapshot(df, "ts")
    assert "WindowGroupLimit" in plan_of(newest)
    assert newest.count() == 20 and newest.columns == ["id", "ts"]


def test_sampled_rows_do_not_move(spark, plan_of):
    df = spark.range(1000).withColumn("k", F.col("id") % 50)
    picked = filters.sample_keys(df, "k", 7, 1)
    assert picked.count() == 140
    assert "Join" not in plan_of(picked)
    assert filters.sample_keys(df, "k", 99).count() == 1000
    assert filters.sample_keys(df.limit(0), "k", 7).count() == 0
