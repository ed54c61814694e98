"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Wide projections generate methods above the JIT's default size limit, which
    # would then be interpreted.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def build_session(app: str = "tidewatch", master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the library's settings; ``extra`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, fallback: str | None = None) -> str:
    """The folder the cluster names for checkpoints; ``fallback`` if it names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if fallback is None:
        raise ValueError("spark.checkpoint.dir is not set and no folder was given")
    return fallback


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in the shared one.  Only a session on one machine that names none gets a
    temporary one."""
    local = spark.sparkContext.master.split("[")[0] == "local"
    return f"{shared_folder(spark, tempfile.gettempdir() if local else None)}/tidewatch-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, for tables that several plans read.

    What was written needs no lineage: a lost executor costs its tasks, not the table.
    """
    path = f"{scratch_folder(df.sparkSession)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def has_files(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.text(path).inputFiles())
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
