"""Counts per country, day and lineage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch import constants as K
from tidewatch.functions.lineages import key_lineage, match_names
from tidewatch.session import stored


def count_by(df: DataFrame, keys: Sequence[str], counted: str | None = None,
             name: str = "n") -> DataFrame:
    """Rows (or non-null ``counted`` values) per key; rows with a null key go."""
    what = F.count("*") if counted is None else F.count(counted)
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(what.alias(name))


def counts_with_lineage(
    df: DataFrame, keys: Sequence[str], lineage: str = "pango_lineage",
    counted: str = "accession_id", patterns: Sequence[str] | None = None,
    merges: Mapping[str, str] = K.LINEAGE_MERGES, name: str = "n",
) -> DataFrame:
    """Per key and lineage, plus one ``All lineages`` row per key.

    The records are aggregated once, by key and lineage; the totals (which
    include records without a lineage) come from those counts.
    """
    per_lineage = (
        df.dropna(subset=list(keys)).groupBy(*keys, lineage)
        .agg(F.count(counted).alias("_n"))
    )
    both = per_lineage.groupingSets(
        [[*(F.col(k) for k in keys), F.col(lineage)], [F.col(k) for k in keys]],
        *keys, lineage,
    ).agg(F.sum("_n").alias(name), F.grouping(lineage).alias("_total"))
    own = key_lineage(F.col(lineage), patterns, merges)
    return (
        both.filter((F.col("_total") == 1) | F.col(lineage).isNotNull())
        .withColumn("key_lineages",
                    F.when(F.col("_total") == 1, K.ALL_LINEAGES).otherwise(own))
        .drop("_total")
    )


def family_counts(df: DataFrame, keys: Sequence[str], families: Mapping[str, Column],
                  total: str = "n_new_sequences", rest: str = "other",
                  weight: str | None = None) -> DataFrame:
    """All records, records per family and the remainder, in one aggregate.

    With ``weight`` a row of ``df`` stands for that many records: it is a row of
    :func:`record_cube`, which has the families as columns.
    """
    if weight is None:
        counts = df.groupBy(*keys).agg(
            F.count("*").alias(total),
            *(F.count_if(test).alias(name) for name, test in families.items()))
    else:
        counts = df.groupBy(*keys).agg(
            F.sum(weight).alias(total), *(F.sum(name).alias(name) for name in families))
    remainder = F.col(total)
    for name in families:
        remainder = remainder - F.col(name)
    return counts.withColumn(rest, remainder)


CUBE_KEYS = ("country", "code", "collection_date", "submission_date")


def record_cube(records: DataFrame, families: Mapping[str, Column], keys: Sequence[str] = CUBE_KEYS,
                name: str = "n") -> DataFrame:
    """Records and records per family by country and both dates, stored once.

    Counts by collection day, by submission day and by both come from this small table, so a
    job with several of them reads its records once.  It lies in the shared folder: a lost
    executor costs no second read either.
    """
    return stored(records.groupBy(*keys).agg(
        F.count("*").alias(name), *(F.count_if(test).alias(f) for f, test in families.items())))


def submissions(cube: DataFrame, keys: Sequence[str] = ("country", "code", "submission_date"),
                name: str = "n") -> DataFrame:
    """Records per country and submission day, from a cube."""
    return cube.groupBy(*keys).agg(F.sum(name).alias(name))


def lineage_order(columns: Sequence[str]) -> list[str]:
    """All lineages, dotted names sorted, other lineages."""
    dotted = sorted(c for c in columns if "." in c)
    return [K.ALL_LINEAGES, *dotted, K.OTHER_LINEAGES]


#: Labels that become columns at most; a table with more is not one to pivot.
MOST_LABELS = 5000


def present_labels(long: DataFrame, label: str = "key_lineages", most: int = MOST_LABELS) -> list[str]:
    """The labels that occur, sorted; raises if there are more than ``most``."""
    found = long.select(label).dropna().distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} labels in {label}")
    return sorted(r[0] for r in found)


def pivot_lineages(long: DataFrame, index: Sequence[str], values: Sequence[str] | None = None,
                   label: str = "key_lineages", measure: str = "n") -> DataFrame:
    """One column per label, in the order of ``values``; no label is lost.

    Without ``values`` the columns are the labels of the data: ``long``, which is to be
    aggregated already, is stored once and read for its labels and for the pivot.  With
    ``values`` no extra job runs, and a label that they do not list raises.
    """
    if values is None:
        long = stored(long)
        values = present_labels(long, label)
    kept = F.col(label).isNull() | F.col(label).isin(list(values))
    named = F.when(kept, F.col(label)).otherwise(
        F.raise_error(F.concat(F.lit("label without a column: "), F.col(label))))
    return (long.withColumn(label, named).groupBy(*index).pivot(label, list(values))
            .agg(F.sum(measure)))


def variant_group_columns(
    wide: DataFrame, groups: Mapping[str, Sequence[str]] = K.VARIANT_GROUPS,
    total: str = K.ALL_LINEAGES, rest: str = "who_other",
) -> DataFrame:
    """Row sums per variant group over lineage columns, and what is left."""
    def row_sum(names):
        out = F.lit(0).cast("bigint")
        for n in names:
            out = out + F.coalesce(F.col(f"`{n}`"), F.lit(0))
        return out

    members = {g: match_names(p, wide.columns) for g, p in groups.items()}
    listed = [n for names in members.values() for n in names]
    return wide.withColumns({
        **{g: row_sum(names) for g, names in members.items()},
        rest: F.col(f"`{total}`") - row_sum(listed),
    })


def lineage_mentions(df: DataFrame, country: str, lineage: str, mark: str,
                     countries: Sequence[str]) -> DataFrame:
    """Per listed country: records of one lineage; and whether it occurs at all."""
    is_mark = F.col(lineage) == mark
    return df.agg(
        *(F.count_if(is_mark & (F.col(country) == c)).alias(f"n_{i}")
          for i, c in enumerate(countries)),
        F.coalesce(F.bool_or(is_mark), F.lit(False)).alias("present"),
        F.countDistinct(lineage).alias("n_lineages"),
    )
