"""Incremental upkeep of the 30-day series as feed files land, also per country.

Each micro-batch of line-list records adds its net openings per key and day to a delta table.
The series at any time is the running sum over that table, so a late submission changes only
the days from its submission on.  Old batches are summed into one table from time to time, so
a reader sees a bounded number of partitions.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidewatch import constants as K
from tidewatch.operators.trailing_counts import counts_from_deltas, day_deltas, with_lag_30
from tidewatch.session import has_files, shared_folder, stored
from tidewatch.sources import schemas


def landed_feed(spark: SparkSession, folder: str, schema: StructType = schemas.FEED,
                files_per_batch: int = 1000) -> DataFrame:
    return (spark.readStream.schema(schema).option("header", False)
            .option("maxFilesPerTrigger", files_per_batch).csv(folder))


def keep_deltas(feed: DataFrame, delta_path: str, checkpoint: str | None = None,
                span: int = K.MONTH_SPAN, keys: Sequence[str] = (),
                compact_every: int = 100) -> StreamingQuery:
    """Process everything that has landed and stop.

    A batch owns one partition of the delta table; a batch that is run again
    after a failure overwrites its own partition.  Each delta table has its own
    default checkpoint.  A table without the checkpoint it was written with raises:
    a new one would number its batches from 0 again and overwrite some of them.

    ``keys`` are columns of the feed, such as the country, for a series each; a delta table
    has the same keys always.  Every ``compact_every`` batches the ones before are summed.
    """
    own = hashlib.sha256(delta_path.rstrip("/").encode()).hexdigest()[:16]
    root = checkpoint or f"{shared_folder(feed.sparkSession)}/feed_deltas-{own}"

    spark = feed.sparkSession
    if has_files(spark, delta_path) and not has_files(spark, f"{root}/metadata"):
        raise ValueError(f"{delta_path} was written with another checkpoint than {root}")

    def store(batch: DataFrame, batch_id: int) -> None:
        (day_deltas(batch, "collection_date", "submission_date", keys, span)
         .withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(delta_path))
        if batch_id and batch_id % compact_every == 0:
            compact_deltas(batch.sparkSession, delta_path, batch_id - 1)

    return (feed.writeStream.foreachBatch(store).option("checkpointLocation", root)
            .trigger(availableNow=True).start())


def _compacted_path(delta_path: str) -> str:
    """Readers of the batches skip folders that begin with an underscore."""
    return f"{delta_path.rstrip('/')}/_compacted"


def _newest_compaction(spark: SparkSession, delta_path: str) -> int:
    """The last batch that a compaction holds, -1 without one; from folder names alone."""
    path = _compacted_path(delta_path)
    if not has_files(spark, f"{path}/upto=*"):
        return -1
    return spark.read.parquet(path).agg(F.max("upto")).first()[0]


def current_deltas(spark: SparkSession, delta_path: str) -> DataFrame:
    """(keys, date, delta) of all batches: the newest compaction and the batches after it."""
    upto = _newest_compaction(spark, delta_path)
    batches = spark.read.parquet(delta_path).filter(F.col("batch_id") > upto).drop("batch_id")
    if upto < 0:
        return batches
    return batches.unionByName(
        spark.read.parquet(_compacted_path(delta_path)).filter(F.col("upto") == upto).drop("upto"))


def compact_deltas(spark: SparkSession, delta_path: str, upto: int | None = None) -> None:
    """Sum the batches up to ``upto``, by default all but the newest, into one partition.

    The newest batch may be run again after a failure, so it is left out.  The sum appears as
    one renamed folder, whose name says which batches it holds; a reader takes the newest and
    the batches after it, so it sees no batch twice, whenever it looks.  Batches that the
    compaction before this one held are removed, later ones stay for readers under way.
    """
    held = _newest_compaction(spark, delta_path)
    ids = spark.read.parquet(delta_path).agg(F.max("batch_id")).first()[0]
    upto = ids - 1 if upto is None else min(upto, ids - 1)
    if upto <= held:
        return
    batches = spark.read.parquet(delta_path).filter(F.col("batch_id").between(held + 1, upto))
    rows = batches.drop("batch_id")
    if held >= 0:
        rows = rows.unionByName(spark.read.parquet(_compacted_path(delta_path))
                                .filter(F.col("upto") == held).drop("upto"))
    keys = [c for c in rows.columns if c != "delta"]
    summed = stored(rows.groupBy(*keys).agg(F.sum("delta").alias("delta")).filter("delta <> 0"))
    (summed.withColumn("upto", F.lit(upto)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("upto").parquet(_compacted_path(delta_path)))
    _remove(spark, delta_path, "batch_id", held)
    _remove(spark, _compacted_path(delta_path), "upto", held - 1)


def _remove(spark: SparkSession, path: str, column: str, last: int) -> None:
    """Remove the partitions of ``column`` up to ``last``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in fs.listStatus(folder):
        name = found.getPath().getName()
        if name.startswith(f"{column}=") and int(name.split("=")[1]) <= last:
            fs.delete(found.getPath(), True)


def current_series(spark: SparkSession, delta_path: str, start: dt.date, end: dt.date,
                   keys: Sequence[str] = ()) -> DataFrame:
    """The series from start to end with lag and ratio, from the delta table; one per key."""
    deltas = current_deltas(spark, delta_path)
    return with_lag_30(counts_from_deltas(deltas, start, end, keys), keys=keys)
