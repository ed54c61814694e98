"""Long, wide and cell-list reshapes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tidewatch import constants as K
from tidewatch.functions.text import parse_grouped_int


def cells_to_rows(pages: DataFrame, cells: str, names: Mapping[str, int],
                  skip: int = K.TABLE_WIDTH, width: int = K.TABLE_WIDTH,
                  end_mark: str = K.TABLE_END_MARK) -> DataFrame:
    """Fold a page's flat list of table cells into rows.

    The first ``skip`` cells are the header; the table ends before the first
    ``end_mark`` (at the last cell without one); cells that do not fill a row
    are left out.  ``names`` maps output columns to 1-based cell positions.  One
    page is one row and stays in its task: no shuffle.
    """
    c = F.col(cells)
    mark = F.array_position(c, end_mark).cast("int")
    stop = F.when(mark > 0, mark - 1).otherwise(F.size(c))
    n_rows = F.floor((stop - skip) / width).cast("int")
    rows = F.when(n_rows > 0, F.transform(
        F.sequence(F.lit(0), n_rows - 1),
        lambda r: F.struct(
            r.alias("row"),
            *(F.get(c, r * width + skip + pos - 1).alias(n) for n, pos in names.items())),
    ))
    return pages.select(*(x for x in pages.columns if x != cells), F.inline(rows))


def tracker_table(pages: DataFrame, cells: str = "cells") -> DataFrame:
    """Location, confirmed and probable counts of a tracker page."""
    rows = cells_to_rows(pages, cells, {"location": 1, "confirmed": 2, "probable": 4})
    return rows.withColumns({
        "confirmed": parse_grouped_int(F.col("confirmed")),
        "probable": parse_grouped_int(F.col("probable")),
    })


def melt(df: DataFrame, ids: Sequence[str], columns: Sequence[str],
         variable: str = "variable", value: str = "value") -> DataFrame:
    quoted = lambda names: [F.col(f"`{c}`") for c in names]
    return df.unpivot(quoted(ids), quoted(columns), variable, value)


def metrics_by_type(df: DataFrame, metrics: Sequence[str], types: Sequence[str],
                    sep: str = "_") -> DataFrame:
    """Columns ``<metric>_<type>`` to one row per type and one column per metric."""
    columns = [f"{m}{sep}{t}" for m in metrics for t in types]
    numeric = df.select(*(F.col(c).cast("double").alias(c) for c in columns))
    parts = F.split("name", sep)
    return (
        numeric.unpivot([], columns, "name", "value")
        .select(F.get(parts, F.lit(0)).alias("metric"),
                F.get(parts, F.lit(1)).alias("type"), "value")
        .groupBy("type").pivot("metric", list(metrics)).agg(F.first("value"))
    )


def labelled_rows(df: DataFrame, columns: Mapping[str, tuple], day: str) -> DataFrame:
    """One-row table to labelled metric rows (text, source, value, display order)."""
    rows = F.array(*(
        F.struct(F.lit(text).alias("Metric"), F.lit(source).alias("Source"),
                 F.col(c).cast("bigint").alias("Total"), F.lit(order).alias("order"))
        for c, (text, source, order) in columns.items()
    ))
    return df.select(F.col(day).alias("Submission Date"), F.inline(rows))
