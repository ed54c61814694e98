"""Country name to code lookup and joins to small dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.functions import places
from tidewatch.functions.text import lookup, name_key
from tidewatch import constants as K


def one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in the given order (ties end on the order's last column).

    An aggregate over a struct: partial results are merged map side, so a hot
    key never collects its rows in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(ranked.alias("_r")).select(
        *keys, *(F.col("_r").getField(c).alias(c) for c in rest)
    ).select(*df.columns)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """Constant rows as part of the plan, so Spark knows that they are few."""
    structs = [F.struct(*(F.lit(v).alias(n) for n, v in zip(names, r))) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def build_crosswalk(
    dimension: DataFrame, name: str, code: str, overrides: Mapping[str, str] | None = None
) -> DataFrame:
    """(name_key, code), one row per normalised name; overrides come first."""
    rows = dimension.select(
        name_key(F.col(name)).alias("name_key"), F.col(code).alias("code"),
        F.lit(1).alias("_rank"),
    ).filter((F.col("name_key") != "") & F.col("code").isNotNull())
    if overrides:
        extra = literal_rows(dimension.sparkSession, list(overrides.items()), ["name", "code"])
        rows = rows.unionByName(extra.select(
            name_key(F.col("name")).alias("name_key"), "code", F.lit(0).alias("_rank")))
    return one_per_key(rows, ["name_key"], [F.col("_rank"), F.col("code")]).drop("_rank")


def add_code(df: DataFrame, name: str, crosswalk: DataFrame, code: str = "code",
             drop_unmatched: bool = False, by_words: bool = True) -> DataFrame:
    """Look up the code of a country name; unmatched names give null or go.

    The crosswalk decides first, by equal normalised names.  With ``by_words`` the words of a
    name that it does not list decide (see :func:`places.country_by_words`), in the same pass.
    """
    side = crosswalk.select(F.col("name_key").alias("_key"), F.col("code").alias("_exact"))
    listed = df.join(side, name_key(F.col(name)) == F.col("_key"),
                     "inner" if drop_unmatched and not by_words else "left")
    found = F.col("_exact")
    if by_words:
        found = F.coalesce(found, places.country_by_words(F.col(name)))
    if drop_unmatched and by_words:
        # Generated, since a filter on a projected column would look every name up twice.
        known = listed.select("*", F.stack(F.lit(1), found).alias("_found")).filter(F.col("_found").isNotNull())
        return known.withColumn(code, F.col("_found")).drop("_key", "_exact", "_found")
    return listed.withColumn(code, found).drop("_key", "_exact")


def add_name(df: DataFrame, code: str, name: str = "country_name") -> DataFrame:
    """The English name of a country code; null for codes that no country has."""
    side = places.country_names(df.sparkSession).select(
        F.col("code").alias("_code"), F.col("name").alias(name))
    return df.join(side, F.col(code) == F.col("_code"), "left").drop("_code")


def continents(series: DataFrame, code: str = "iso_code", continent: str = "continent") -> DataFrame:
    """(code, continent), one row per code of a case series; the Americas are one continent.

    Of several continents the first in order counts.
    """
    merged = F.coalesce(lookup(F.col(continent), K.CONTINENT_MERGES), F.col(continent))
    return series.groupBy(F.col(code).alias("code")).agg(F.min(merged).alias("continent")).dropna()


def add_continent(df: DataFrame, code: str, by_code: DataFrame, continent: str = "continent") -> DataFrame:
    """The continent of each row's code, also of rows that came without one."""
    side = by_code.select(F.col("code").alias("_code"), F.col("continent").alias("_continent"))
    return (df.drop(continent).join(side, F.col(code) == F.col("_code"), "left")
            .withColumnRenamed("_continent", continent).drop("_code"))


def unmatched_names(df: DataFrame, name: str, crosswalk: DataFrame, by_words: bool = True) -> DataFrame:
    """Names without a code, with the number of rows that carry them."""
    counts = df.groupBy(name).agg(F.count("*").alias("n_rows"))
    return add_code(counts, name, crosswalk, "_code", by_words=by_words).filter(
        F.col("_code").isNull()).drop("_code")


def add_dimension(df: DataFrame, dim: DataFrame, on: Mapping[str, str], keep: Mapping[str, str],
                  how: str = "left") -> DataFrame:
    """Join attributes of a dimension.

    ``on`` maps fact columns to dimension columns, ``keep`` maps dimension
    attributes to output names.  Identical dimension rows count once; a key with
    different attributes keeps them all (see :func:`gates.extra_rows`).
    """
    keys = [F.col(f"`{d}`").alias(f"_k{i}") for i, d in enumerate(on.values())]
    names = [f"_k{i}" for i in range(len(keys))]
    attrs = [F.col(f"`{d}`").alias(out) for d, out in keep.items()]
    side = dim.select(*keys, *attrs).dropna(subset=names).distinct()
    test = None
    for k, fact in zip(names, on):
        t = F.col(f"`{fact}`") == F.col(k)
        test = t if test is None else test & t
    return df.join(side, test, how).drop(*names)


def full_join_keyed(big: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """Full outer join with a ``small`` side of one row per key.

    Spark can neither broadcast a side of a full outer join nor split a hot key
    in it.  A left join allows both; the unmatched rows of ``small`` are added.
    """
    seen = big.select(key).dropna().distinct()
    unmatched = small.join(seen, key, "left_anti")
    return big.join(small, key, "left").unionByName(unmatched, allowMissingColumns=True)
