"""Quality flags on the line list (rows are flagged, not dropped)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch import constants as K


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Return ``df``; raise when a column is missing."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError("Missing column(s): " + ", ".join(missing))
    return df


def abnormal_date(
    text: Column, as_of: dt.date, first: dt.date = K.FIRST_DATE, inclusive: bool = False
) -> Column:
    """True unless a full date after ``first`` and not after ``as_of``.

    The comparison is on the text, so a partial date such as ``2021-05`` is
    abnormal as well.
    """
    lower = text >= first.isoformat() if inclusive else text > first.isoformat()
    good = (F.length(text) == 10) & lower & (text <= as_of.isoformat())
    return ~F.coalesce(good, F.lit(False))


def suspect_sequence(
    length: Column, n_content: Column, host: Column,
    min_length: float = K.MIN_SEQUENCE_LENGTH, max_n: float = K.MAX_N_CONTENT,
    human: str = K.HUMAN_HOST,
) -> Column:
    n_ok = n_content.isNull() | (n_content < max_n)
    good = (length > min_length) & n_ok & (host == human)
    return ~F.coalesce(good, F.lit(False))


def abnormal_gc(gc: Column, low: float = K.GC_LOW, high: float = K.GC_HIGH) -> Column:
    return ~F.coalesce((gc > low) & (gc < high), F.lit(False))


def exclusion_names(lines: DataFrame, column: str = "value",
                    prefix: str = K.EXCLUSION_PREFIX) -> DataFrame:
    """One distinct, prefixed name per usable line of an exclusion list."""
    line = F.col(column)
    return (
        lines.filter((line != "") & ~line.startswith("#"))
        .select(F.concat(F.lit(prefix), line).alias("name"))
        .distinct()
    )


def flag_members(df: DataFrame, key: str, names: DataFrame, name_col: str = "name",
                 flag: str = "excluded") -> DataFrame:
    """Add ``flag``: is ``key`` one of ``names``?  No row is dropped or repeated.

    No broadcast hint: the list is outside data, so Spark decides by its size.
    """
    listed = names.select(F.col(name_col).alias("_listed")).distinct()
    return (
        df.join(listed, F.col(key) == F.col("_listed"), "left")
        .withColumn(flag, F.col("_listed").isNotNull())
        .drop("_listed")
    )


def any_flag(*flags: str) -> Column:
    out = F.col(flags[0])
    for name in flags[1:]:
        out = out | F.col(name)
    return out


def add_quality_flags(
    df: DataFrame, exclusions: DataFrame, as_of: dt.date, *,
    name: str = "Virus name", collected: str = "Collection date",
    length: str = "Sequence length", n_content: str = "N-Content",
    gc: str = "GC-Content", host: str = "Host", human: str = K.HUMAN_HOST,
    first: dt.date = K.FIRST_DATE, inclusive: bool = False,
) -> DataFrame:
    """The four flags and their disjunction."""
    c = lambda n: F.col(f"`{n}`")
    return (
        flag_members(df, f"`{name}`", exclusions, flag="excluded")
        .withColumns({
            "abnormal_date": abnormal_date(c(collected), as_of, first, inclusive),
            "suspect_sequence": suspect_sequence(
                c(length), c(n_content), c(host), human=human),
            "abnormal_gc_content": abnormal_gc(c(gc)),
        })
        .withColumn("any_abnormal", any_flag(
            "excluded", "abnormal_date", "suspect_sequence", "abnormal_gc_content"))
    )
