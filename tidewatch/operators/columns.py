"""Operators on the set of columns."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def clean_name(name: str) -> str:
    """Lower case, anything but letters and digits to ``_``, no leading digit."""
    text = name.strip().lower().replace("%", "_percent_").replace("#", "_number_")
    text = re.sub(r"[^0-9a-z]+", "_", text).strip("_")
    return "x" + text if text[:1].isdigit() else text


def clean_names(df: DataFrame) -> DataFrame:
    """All columns renamed by :func:`clean_name`; repeats get ``_2``, ``_3`` ..."""
    seen: dict[str, int] = {}
    names = []
    for old in df.columns:
        new = clean_name(old)
        seen[new] = seen.get(new, 0) + 1
        names.append(new if seen[new] == 1 else f"{new}_{seen[new]}")
    return df.toDF(*names)


def snake_blanks(df: DataFrame) -> DataFrame:
    """Lower case, blanks to ``_``; other characters stay."""
    return df.toDF(*("_".join(c.lower().split()) for c in df.columns))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def prefix_columns(df: DataFrame, prefix: str, only: Sequence[str] | None = None) -> DataFrame:
    """Prefix all columns, or just those listed in ``only``."""
    return df.toDF(*(
        prefix + c if only is None or c in only else c for c in df.columns
    ))


def drop_matching(df: DataFrame, test: Callable[[str], bool]) -> DataFrame:
    return df.select(*(F.col(f"`{c}`") for c in df.columns if not test(c)))


def bind_rows(*frames: DataFrame) -> DataFrame:
    """Union by name; a column missing on one side is null there."""
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def split_key(df: DataFrame, column: str, sep: str, names: Sequence[str], kind: str) -> DataFrame:
    """Split a composite text key into typed columns, row by row."""
    parts = F.split(F.col(f"`{column}`"), re.escape(sep))
    return df.withColumns({
        n: F.get(parts, F.lit(i)).try_cast(kind) for i, n in enumerate(names)
    })
