"""Readers of landed files."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewatch.operators.columns import clean_names
from tidewatch.operators.crosswalk import literal_rows
from tidewatch.sources import schemas


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: StructType,
                   sep: str = ",", header: bool = True,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """A file, folder or list of both; columns by name, with the types of ``schema``.

    Files may order their columns differently and have others besides.  Files of one
    header are one scan, which parses just the columns asked for (all of ``schema``
    unless ``columns`` are given); a header without one of them raises.  Without a
    header, columns go by position.  Only the parser's empty field is null, so codes
    such as ``NA`` stay text.  A value that is not of its type is null.
    """
    paths = [path] if isinstance(path, str) else list(path)
    names = schema.fieldNames() if columns is None else list(columns)
    read = spark.read.option("header", header).option("sep", sep).option("enforceSchema", True)
    pick = lambda df: df.select(*(F.col(f"`{c}`") for c in names))
    if not header:
        return pick(read.schema(schema).csv(paths))
    scans = []
    for found, files in _files_by_header(spark, paths, sep).items():
        missing = [c for c in names if c not in found]
        if missing:
            raise ValueError(f"Missing column(s) in {files[0]}: " + ", ".join(missing))
        fields = [schema[c] if c in schema.names else StructField(c, StringType()) for c in found]
        scans.append(pick(read.schema(StructType(fields)).csv(files)))
    return reduce(DataFrame.union, scans) if scans else pick(spark.createDataFrame([], schema))


#: Files up to this size are read whole to learn their header.
SMALL_FILE = 4 << 20


def _files_by_header(spark: SparkSession, paths: list[str],
                     sep: str) -> dict[tuple[str, ...], list[str]]:
    """The files under ``paths`` by their header; files without a line are left out.

    Two jobs whatever the number of files.  Small files are packed and read through.  Of the
    others each split is a task of its own, which takes one batch of lines and stops, so some
    kilobytes are read; only the split at a file's beginning answers.
    """
    def lines(session: SparkSession) -> DataFrame:
        return session.read.text(paths).select(
            "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_block_start").alias("start"))

    small = (lines(spark).filter((F.col("size") <= SMALL_FILE) & F.col("value").rlike("[^\ufeff\\s]"))
             .withColumn("line", F.monotonically_increasing_id())
             .groupBy("file").agg(F.min_by("value", F.struct("start", "line")).alias("value")))
    own = spark.newSession()
    own.conf.set("spark.sql.files.openCostInBytes", str(1 << 40))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    large = lines(own).filter(F.col("size") > SMALL_FILE).drop("size").mapInArrow(
        _first_line, "value string, file string")
    groups: dict[tuple[str, ...], list[str]] = {}
    for found in (small, large):
        for line, files in found.groupBy("value").agg(F.sort_array(F.collect_list("file"))).collect():
            header = tuple(next(csv.reader([line.removeprefix("\ufeff")], delimiter=sep)))
            groups.setdefault(header, []).extend(unquote(f) for f in files)
    return dict(sorted(groups.items(), key=lambda g: min(g[1])))


def _first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows and batch.column("start")[0].as_py():
            return
        for i, line in enumerate(batch.column("value").to_pylist()):
            if line.strip("\ufeff \t\r"):
                yield batch.select(["value", "file"]).slice(i, 1)
                return


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The full metadata extract, tab separated."""
    return read_delimited(spark, path, schemas.METADATA, sep="\t")


def read_cases(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    return read_delimited(spark, path, schemas.CASES, columns=columns)


def read_submissions(spark: SparkSession, folder: str) -> DataFrame:
    """All tab-separated files of a folder as one table with clean names."""
    return clean_names(read_delimited(spark, folder, schemas.SUBMISSIONS, sep="\t"))


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """The header-less line-list feed, 7 or 8 columns wide.

    A 7-column row leaves the eighth column null, so one schema reads both
    widths, also mixed in one folder; the surplus column is dropped.
    """
    return read_delimited(spark, path, schemas.FEED, header=False).drop("variant")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line (column ``value``), for exclusion lists."""
    return spark.read.text(path)


def read_geometry(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.GEOMETRY, sep="\t").select(
        "geometry", "Name", F.col("`3-letter ISO code`").alias("country_code"))


def read_countries(spark: SparkSession, path: str) -> DataFrame:
    """The country dimension with clean names (``x3_letter_iso_code`` ...)."""
    return clean_names(read_delimited(spark, path, schemas.COUNTRIES))


def literal_table(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """An inline table of constants."""
    return literal_rows(spark, rows, names)
