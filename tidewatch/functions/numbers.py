"""Numeric, conditional and null-handling expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidewatch import constants as K
from tidewatch.functions.text import number_text


def ratio(a: Column, b: Column, scale: float | None = None) -> Column:
    """``scale * a / b``; null instead of a division by zero."""
    top = a.cast("double") if scale is None else F.lit(float(scale)) * a
    return F.try_divide(top, b.cast("double"))


def percent(a: Column, b: Column, digits: int | None = None) -> Column:
    value = ratio(a, b, 100.0)
    return value if digits is None else F.round(value, digits)


def per_100k(x: Column, population: Column) -> Column:
    return ratio(x, population, 100000.0)


def per_million(x: Column, population: Column) -> Column:
    return F.try_divide(x.cast("double"), population / F.lit(1e6))


def per_hundred(x: Column, population: Column) -> Column:
    return F.round(F.try_divide(x.cast("double"), population / F.lit(100.0)), 2)


def detection_threshold(n: Column, confidence: float = K.CONFIDENCE) -> Column:
    """Prevalence (%) a variant may have and still be missed by ``n`` sequences."""
    miss = F.lit(1.0 - confidence)
    return F.when(n == 0, F.lit(100.0)).otherwise(
        F.lit(100.0) * (F.lit(1.0) - F.pow(miss, F.lit(1.0) / n))
    )


def unit_interval(x: Column) -> Column:
    return F.when(x.between(0, 1), x)


def non_negative(x: Column) -> Column:
    return F.when(x >= 0, x)


def larger_of(a: Column, b: Column) -> Column:
    """Larger of the two, ignoring nulls."""
    return F.greatest(a, b)


def null_if_zero(x: Column) -> Column:
    return F.when(x != 0, x)


def zero_if_null(x: Column) -> Column:
    return F.coalesce(x, F.lit(0))


def log10_threshold(x: Column) -> Column:
    return F.log10(x)


def floor_threshold(x: Column) -> Column:
    """Two digits, never below 0.01; null stays null."""
    return F.when(x.isNotNull(), F.greatest(F.round(x, 2), F.lit(0.01)))


def threshold_label(x: Column, cum_positivity: Column, suffix: str = "") -> Column:
    """Display text of a floored threshold; the last matching rule wins."""
    return (
        F.when((cum_positivity < 0.002) & (x >= 95), K.MINIMAL_CASES)
        .when(x >= 95, K.INSUFFICIENT_SEQUENCING)
        .when(x <= 0.01, "<0.01" + suffix)
        .otherwise(F.concat(number_text(x), F.lit(suffix)))
    )


def detected(n: Column) -> Column:
    return F.when(n > 0, "Yes").otherwise("No")


def dots_value(share: Column, n_total: Column) -> Column:
    """Null when never detected, 0 when detected but absent last week."""
    return F.when(n_total > 0, F.coalesce(share, F.lit(0.0)))


def panel_text(share: Column, n_last_week: Column) -> Column:
    return (
        F.when(n_last_week == 0, K.NO_RECENT_SEQUENCES)
        .when(n_last_week < 100, F.concat(number_text(share), F.lit(" %*")))
        .when(n_last_week >= 100, F.concat(number_text(share), F.lit(" %")))
    )


def percent_change(change: Column, now: Column, digits: int = 1) -> Column:
    """Change relative to the value before it."""
    return F.round(ratio(change, now - change, 100.0), digits)
