"""Sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.functions.text import hour_stamp
from tidewatch.operators.trailing_counts import refresh_series
from tidewatch.session import has_files, stored


def write_csv(df: DataFrame, path: str) -> None:
    """Replace ``path`` with a headed CSV folder."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_snapshot(df: DataFrame, path: str, timestamp: str = "timestamp") -> None:
    """Add scrapes to the master table, which has one partition a day, sorted by time.

    A scrape is known by its time of capture, so writing it again replaces its rows and adds
    none; others of the same day or hour stay.  Only the days of ``df`` are rewritten, from a
    copy in the shared folder, so the table is never read while it is written.  One writer
    at a time.  Rows without a time are one scrape.
    """
    spark = df.sparkSession
    new = stored(_dated(df, timestamp))
    if has_files(spark, path):
        times = new.select(F.col("snapshot_day").alias("_day"), F.col(timestamp).alias("_time")).distinct()
        days = [r[0] for r in times.select("_day").distinct().collect()]  # days written now
        old = spark.read.parquet(path)
        touched = old.filter(F.col("snapshot_day").isin(days) | F.col("snapshot_day").isNull())
        others = touched.join(times, F.col(timestamp).eqNullSafe(F.col("_time")), "left_anti")
        new = stored(others.unionByName(new, allowMissingColumns=True))
    (new.hint("rebalance", "snapshot_day").sortWithinPartitions("snapshot_day", timestamp)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("snapshot_day").parquet(path))


def _dated(df: DataFrame, timestamp: str) -> DataFrame:
    return df.withColumns({
        "snapshot_hour": hour_stamp(F.col(timestamp)), "snapshot_day": F.to_date(timestamp)})


def compact_snapshots(spark: SparkSession, path: str, out_path: str, timestamp: str = "timestamp") -> None:
    """Rewrite a master table of any partitioning as one of day partitions, in a new folder."""
    if path.rstrip("/") == out_path.rstrip("/"):
        raise ValueError("the compacted table needs its own folder")
    rows = spark.read.parquet(path).drop("snapshot_hour", "snapshot_time", "snapshot_day")
    write_snapshot(rows, out_path, timestamp)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def refresh_master(spark: SparkSession, master_path: str, out_path: str, records: DataFrame,
                   collected: str, submitted: str, end: dt.date) -> None:
    """Write the master series, refreshed up to ``end``, to a new folder.

    The old master is read while the new one is written, so they must differ.
    """
    if master_path.rstrip("/") == out_path.rstrip("/"):
        raise ValueError("the refreshed series needs its own folder")
    write_table(refresh_series(
        spark.read.parquet(master_path), records, collected, submitted, end), out_path)
