"""Two sources of case counts side by side."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame, functions as F

from tidewatch.functions.numbers import larger_of


def reconcile(a: DataFrame, b: DataFrame, keys: list[str], a_value: str, b_value: str,
              best: str = "max_cases") -> DataFrame:
    """Full outer join, larger value of the two.

    ``a`` holds one row per key (it is an aggregate).  Repeated rows of ``b`` are
    removed before the join, which gives the same rows as removing them after it
    and joins less.  Null keys match each other.
    """
    other = b.distinct().withColumnsRenamed({k: f"_{k}" for k in keys})
    same = functools.reduce(operator.and_, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
    rest = [c for c in (*a.columns, *b.columns) if c not in keys]
    return (
        a.join(other, same, "full")
        .select(*(F.coalesce(k, f"_{k}").alias(k) for k in keys), *rest)
        .withColumn(best, larger_of(F.col(a_value), F.col(b_value)))
    )


def global_totals(rec: DataFrame, seq: str, confirmed: str, best: str = "max_cases") -> DataFrame:
    """One row of worldwide sums and counts."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return rec.agg(
        total(best).alias("n_total_cases"),
        F.count(best).alias("n_countries_w_cases"),
        total(confirmed).alias("n_confirmed_cases"),
        (total(best) - total(confirmed)).alias("diff_total_and_confirmed"),
        total(seq).alias("n_seq"),
        F.count(seq).alias("n_seq_countries"),
    )


def merge_full(seq: DataFrame, cases: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on shared key names; the keys are coalesced."""
    return seq.join(cases, keys, "full")


def merge_left(cases: DataFrame, seq: DataFrame, keys: list[str]) -> DataFrame:
    """Keep the case rows; sequence-only rows go."""
    return cases.join(seq, keys, "left")
