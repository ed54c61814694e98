"""Mixing sources to target weights by Pareto order sampling.

A source whose target is f times its size takes floor(f) whole copies of every document
for certain.  The rest of its target is drawn without replacement: documents are ranked
by their random odds over their inclusion odds (Pareto order sampling, Rosen 1997) and
taken in that order until the words fill the target.  The cut falls in one of
``BUCKETS`` buckets of the rank, found from a histogram; only that bucket is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, with_key, word_count

#: Buckets of the rank in each source; the sort of one task is a source's share of one.
BUCKETS = 4096
#: No document is taken more often than this.
MOST_COPIES = 3


def _random(doc_id: Column, seed: str) -> Column:
    """A number in (0, 1) that is a function of the id and the seed alone."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def source_targets(sizes: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """Targets of (source, source_size): weights 1, 2, 3 repeating in order of the name.

    Null comes last.  A target stops at ``most`` times its source's size and the excess is
    reshared by weight; the fixed point is min(most * size, level * weight) for the level
    at which the targets add up to all sizes.  One row per source, not per document, is
    put in order here.
    """
    order = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())
    everything = Window.partitionBy(F.lit(1))
    by_stop = Window.orderBy("stop", "nth").rowsBetween(Window.unboundedPreceding, -1)
    weighed = (sizes.withColumn("nth", F.row_number().over(order))
               .withColumn("weight", ((F.col("nth") - 1) % 3 + 1).cast("long"))
               .withColumn("most", F.col("source_size") * most)
               .withColumn("stop", F.col("most") / F.col("weight"))
               .withColumn("all_words", F.sum("source_size").over(everything))
               .withColumn("all_weight", F.sum("weight").over(everything))
               .withColumn("full", F.coalesce(F.sum("most").over(by_stop), F.lit(0)))
               .withColumn("full_weight", F.coalesce(F.sum("weight").over(by_stop), F.lit(0))))
    # The level if all sources that stop earlier are full; the first that fits is right.
    level = (F.col("all_words") - F.col("full")) / (F.col("all_weight") - F.col("full_weight"))
    fits = F.when(level <= F.col("stop"), level)
    return (weighed.withColumn("fit", fits)
            .withColumn("level", F.min_by("fit", F.when(F.col("fit").isNotNull(), F.col("full_weight")))
                        .over(everything))
            .select("source", "source_size", F.least(
                F.col("most").cast("double"),
                F.coalesce(F.col("level") * F.col("weight"), F.col("most").cast("double")))
                .alias("target")))


def mix_documents(docs: DataFrame, seed: str = "mix", most: int = MOST_COPIES) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies.

    ``docs`` needs doc_id, text and source; other columns are ignored.  Size counts words,
    0 for null or empty texts.  A null source is a source.  The draw is a function of
    doc_id and ``seed``, so reruns agree; repeated ids are told apart by size, and rows
    that are alike in both are interchangeable.  A source's taken words miss its target
    by at most half the document at the cut.  An empty table gives an empty result.
    """
    return _allocated(docs, seed, most).drop("key")


def repeat_mixed(docs: DataFrame, seed: str = "mix", most: int = MOST_COPIES) -> DataFrame:
    """The mix itself: each row of ``docs``, all columns, as often as it is taken.

    ``docs`` needs doc_id, text and source and may have any other columns, of any name and
    type.  Nulls, empty texts and ties are as in :func:`mix_documents`; rows that are alike
    share what was drawn for them.  An empty table gives an empty result.
    """
    keyed, key = with_key(docs)
    names = ["`" + c.replace("`", "``") + "`" for c in docs.columns]
    rows = keyed.select(F.col(key).alias("key"), F.struct(*names).alias("row"))
    taken = checkpointed(
        _allocated(keyed.select("doc_id", "text", "source", F.col(key).alias("mix_key")), seed, most)
        .groupBy("key").agg(F.sum("copies").alias("n_taken"), F.count("*").alias("n_rows"))
        .filter("n_taken > 0"))
    once = rows.join(taken.filter("n_rows = 1").select("key", F.col("n_taken").alias("times")), "key")
    alike = (rows.join(taken.filter("n_rows > 1"), "key")
             .withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("key")))
             .withColumn("times", F.expr("n_taken div n_rows + int(nth <= n_taken % n_rows)").cast("long"))
             .drop("nth", "n_taken", "n_rows"))
    return (once.unionByName(alike).filter("times > 0")
            .select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
            .select(*(F.col("row").getField(c).alias(c) for c in docs.columns)))


def _allocated(docs: DataFrame, seed: str, most: int) -> DataFrame:
    key = F.col("mix_key") if "mix_key" in docs.columns else F.lit(0).cast("long")
    rows = checkpointed(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"), _random(F.col("doc_id"), seed).alias("u"), key.alias("key")))
    sources = checkpointed(source_targets(
        rows.groupBy("source").agg(F.sum("size").alias("source_size")), most)
        .withColumn("wanted", F.when(F.col("source_size") > 0,
                                     F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
        .withColumn("whole", F.floor("wanted").cast("long"))
        .withColumn("chance", F.col("wanted") - F.col("whole"))
        .withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumnRenamed("source", "of"))
    same = F.col("source").eqNullSafe(F.col("of"))
    # q / (1 + q) for the Pareto rank q, the random odds over the inclusion odds.
    random, inclusion = F.col("u") * (1 - F.col("chance")), (1 - F.col("u")) * F.col("chance")
    ranked = (rows.join(sources, same)
              .withColumn("rank", random / (random + inclusion))
              .withColumn("bucket", F.least(F.floor(F.col("rank") * BUCKETS), F.lit(BUCKETS - 1))))
    upto = Window.partitionBy("of").orderBy("bucket")
    cuts = (ranked.filter("chance > 0").groupBy("of", "bucket")
            .agg(F.sum("size").alias("words"), F.first("extra").alias("extra"))
            .withColumn("filled", F.sum("words").over(upto) - F.col("words"))
            .filter("filled < extra and extra <= filled + words")
            .groupBy("of").agg(F.min("bucket").alias("cut"), F.min_by("filled", "bucket").alias("filled"))
            .withColumnRenamed("of", "cut_of"))
    judged = ranked.join(cuts, F.col("of").eqNullSafe(F.col("cut_of")), "left")
    at_cut = judged.filter("bucket = cut")
    order = Window.partitionBy("of").orderBy("rank", "doc_id", "size", "key").rowsBetween(
        Window.unboundedPreceding, 0)
    at_cut = at_cut.withColumn("sum", F.col("filled") + F.sum("size").over(order)).withColumn(
        "drawn", F.expr("sum <= extra or (sum - size < extra and sum - extra < extra - (sum - size))"))
    rest = judged.filter("cut is null or bucket <> cut").withColumn(
        "drawn", F.expr("cut is not null and bucket < cut"))
    columns = ["doc_id", "size", "source_size", "target", "whole", "drawn", "key"]
    copies = (F.col("whole") + F.col("drawn").cast("long")).cast("long")
    return (at_cut.select(columns).unionByName(rest.select(columns))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("size") * copies).cast("long").alias("taken"), copies.alias("copies"), "key"))
