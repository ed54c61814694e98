"""Lineage predicates and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from tidewatch import constants as K
from tidewatch.functions.text import contains_any, value_map


def split_patterns(patterns: Sequence[str]) -> tuple[list[str], list[str]]:
    """Exact names and prefixes (``AY.*`` gives the prefix ``AY.``)."""
    exact = [p for p in patterns if "*" not in p]
    prefixes = [p.replace("*", "") for p in patterns if "*" in p]
    return exact, prefixes


def lineage_in(lineage: Column, patterns: Sequence[str]) -> Column:
    """Exact membership, or a prefix match for wildcard patterns."""
    exact, prefixes = split_patterns(patterns)
    tests = [lineage.isin(exact)] if exact else []
    tests += [lineage.startswith(p) for p in prefixes]
    return reduce(lambda a, b: a | b, tests)


def match_names(patterns: Sequence[str], present: Sequence[str]) -> list[str]:
    """The names in ``present`` that the patterns select, sorted."""
    exact, prefixes = split_patterns(patterns)
    return sorted(
        name for name in set(present)
        if name in exact or any(name.startswith(p) for p in prefixes)
    )


def key_lineage_patterns(
    groups: Mapping[str, Sequence[str]] = K.VARIANT_GROUPS,
    others: Sequence[str] = K.OTHER_KEY_LINEAGES,
) -> list[str]:
    return [p for members in groups.values() for p in members] + list(others)


def key_lineage(
    lineage: Column,
    patterns: Sequence[str] | None = None,
    merges: Mapping[str, str] = K.LINEAGE_MERGES,
) -> Column:
    """The lineage itself when it is a key lineage, else the rest label."""
    wanted = key_lineage_patterns() if patterns is None else patterns
    label = F.when(lineage_in(lineage, wanted), lineage).otherwise(K.OTHER_LINEAGES)
    return value_map(label, merges)


def lineage_family(lineage: Column, marks: Sequence[str], mode: str = "substring") -> Column:
    """Family test.

    ``substring`` finds the mark anywhere in the name, ``prefix`` only the mark
    itself and names below it, ``exact`` the mark alone.
    """
    if mode == "substring":
        return contains_any(lineage, marks)
    if mode == "exact":
        return lineage.isin(list(marks))
    if mode == "prefix":
        return lineage_in(lineage, [*marks, *(m + ".*" for m in marks)])
    raise ValueError(f"unknown mode: {mode}")


def variant_group(
    lineage: Column, groups: Mapping[str, Sequence[str]] = K.VARIANT_GROUPS,
    rest: str = "who_other",
) -> Column:
    """Group name of a lineage, ``rest`` when it belongs to none."""
    out = None
    for name, members in groups.items():
        hit = lineage_in(lineage, members)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(rest)
