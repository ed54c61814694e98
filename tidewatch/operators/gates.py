"""Data-quality gates: one row per gate, from one aggregate pass."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Gate:
    """``observed`` is an aggregate; the gate passes when ``observed op threshold``."""

    name: str
    observed: Column
    op: str
    threshold: float

    def row(self) -> Column:
        seen = self.observed.cast("double")
        limit = F.lit(float(self.threshold))
        test = {
            ">": seen > limit, ">=": seen >= limit, "<": seen < limit,
            "<=": seen <= limit, "==": seen == limit,
        }[self.op]
        return F.struct(
            F.lit(self.name).alias("gate"), seen.alias("observed"),
            limit.alias("threshold"), F.coalesce(test, F.lit(False)).alias("passed"))


def evaluate(df: DataFrame, gates: Sequence[Gate]) -> DataFrame:
    """(gate, observed, threshold, passed); an unobserved value fails."""
    packed = df.agg(F.array(*(g.row() for g in gates)).alias("_g"))
    return packed.select(F.inline("_g"))


def condensed(df: DataFrame, keys: Sequence[str], largest: Sequence[str]) -> DataFrame:
    """One row per combination of ``keys``, with maxima and the number of rows.

    Gates that count distinct keys run on this small table instead of the records,
    which several distinct counts would multiply.
    """
    return df.groupBy(*keys).agg(
        *(F.max(c).alias(c) for c in largest), F.count("*").alias("n_rows"))


def enforce(result: DataFrame) -> DataFrame:
    """Raise when a gate failed.  The result holds a handful of rows."""
    failed = result.filter(~F.col("passed")).collect()
    if failed:
        raise ValueError("Failed gates: " + ", ".join(
            f"{r['gate']} (observed {r['observed']}, threshold {r['threshold']})"
            for r in failed))
    return result


def _age(day: Column, as_of: dt.date) -> Column:
    return F.datediff(F.lit(as_of), F.max(day))


def line_list_age(submitted: str, as_of: dt.date, days: int = 7) -> Gate:
    return Gate("line_list_age_days", _age(F.col(submitted), as_of), "<=", days)


def codes_match_names(code: str, name: str) -> Gate:
    """As many codes as names."""
    gap = F.countDistinct(code) - F.countDistinct(name)
    return Gate("codes_minus_names", gap, "==", 0)


def coded_share(code: str, least: float = 0.95) -> Gate:
    """Rows that have a country code, as a share of all rows."""
    return Gate("coded_share", F.count(code) / F.count("*"), ">=", least)


def fewer_sequence_countries(seq_code: str, case_code: str) -> Gate:
    gap = F.countDistinct(case_code) - F.countDistinct(seq_code)
    return Gate("case_minus_sequence_countries", gap, ">", 0)


def sequences_age(day: str, n: str, as_of: dt.date, days: int) -> Gate:
    seen = F.when(F.col(n) > 0, F.col(day))
    return Gate("last_sequence_age_days", _age(seen, as_of), "<=", days)


def series_ends(day: str, as_of: dt.date) -> Gate:
    """The series ends the day before ``as_of``."""
    return Gate("series_age_days", _age(F.col(day), as_of), "==", 1)


def _of(code: str, who: str, column: str) -> Column:
    return F.max(F.when(F.col(code) == who, F.col(column)))


def country_above(code: str, who: str, column: str, limit: float, name: str) -> Gate:
    return Gate(name, _of(code, who, column), ">", limit)


def none_above(column: str, limit: float, name: str) -> Gate:
    return Gate(name, F.count_if(F.col(column) > limit), "==", 0)


def columns_present(df: DataFrame, names: Sequence[str]) -> Gate:
    missing = len(set(names) - set(df.columns))
    return Gate("missing_columns", F.max(F.lit(missing)), "==", 0)


def country_not_null(code: str, who: str, column: str) -> Gate:
    return Gate("reported_case_values",
                F.count(F.when(F.col(code) == who, F.col(column))), ">", 0)


def snapshot_today(ts: str, as_of: dt.date) -> Gate:
    return Gate("snapshot_age_days", _age(F.to_date(ts), as_of), "==", 0)


def has_rows(n: str | None = None) -> Gate:
    """Rows, or the sum of a column that counts them."""
    return Gate("rows", F.coalesce(F.sum(n), F.lit(0)) if n else F.count("*"), ">", 0)


def extra_rows(keys: Sequence[str]) -> Gate:
    """Different dimension rows beyond one per key."""
    return Gate("extra_dimension_rows",
                F.count("*") - F.countDistinct(F.struct(*keys)), "==", 0)
