"""Sharding by longest processing time: copies stay together, shards end near equal.

Groups (equal texts) are dealt from the largest to the smallest, each to the shard with
the least bytes.  Group sizes fall into classes: sizes below ``2 ** BITS`` are exact,
larger ones keep their ``BITS`` leading bits.  The heap runs over the classes, whose
number is bounded whatever the input; members of a class are interchangeable, so each
takes the shard that its place in the class was dealt.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, spread

#: Leading bits of a size that make its class: at most 2**12 + 51 * 2**11 classes.
BITS = 12
#: Bytes that a row takes besides its text.
ROW_BYTES = 16
#: Rows that are alike in id and text travel as one row for up to so many.
ALIKE = 4096


def deal(classes: list[tuple[int, int, int]], shards: int) -> list[tuple[int, list, list]]:
    """Deal (class, groups, bytes of all), largest class first, through a heap of loads.

    Returns for each class the places at which a shard's share begins, and the shards.
    """
    heap = [(0.0, s) for s in range(shards)]
    dealt = []
    for cls, count, total in sorted(classes, reverse=True):
        each = total / count
        shares = dict.fromkeys(range(shards), 0)
        left = count
        if count > 8 * shards:  # all of one size: fill up to a level at once
            low, high = heap[0][0], heap[0][0] + each * count
            for _ in range(80):
                level = (low + high) / 2
                need = sum(max(0, math.floor((level - x) / each)) for x, _ in heap)
                low, high = (level, high) if need <= count else (low, level)
            for x, s in heap:
                shares[s] = max(0, math.floor((low - x) / each))
            left -= sum(shares.values())
            heap = [(x + each * shares[s], s) for x, s in heap]
            heapq.heapify(heap)
        for _ in range(left):
            x, s = heap[0]
            heapq.heapreplace(heap, (x + each, s))
            shares[s] += 1
        begins, owners, at = [], [], 0
        for s, n in shares.items():
            if n:
                begins.append(at)
                owners.append(s)
                at += n
        dealt.append((cls, begins, owners))
    return dealt


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``docs`` needs doc_id and text; other columns are ignored.  Size is the text's UTF-8
    bytes plus 16; a null text has none, and null texts are one group.  Copies, repeated
    rows included, share a shard; slots run from 0 without gaps in order of a hash bucket
    and doc_id.  Documents without an id take slots like others.  text_crc32 of a null
    text is null.  An empty table gives an empty result.

    Rows alike in id and text are counted first and then travel in parts of ``ALIKE``, each
    in a bucket of its own, so a crowd of them is neither shuffled whole nor numbered in one task.
    """
    n = spread(docs.sparkSession)
    text = F.col("text")
    alike = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(F.sha2(text, 256), F.lit("")).alias("copy")).groupBy(
        "doc_id", "size", "text_crc32", "copy").agg(F.count("*").alias("alike"))
    rows = checkpointed(alike.withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(alike - 1) div {ALIKE}")))).withColumn(
        "alike", F.least(F.col("alike") - F.col("part") * ALIKE, F.lit(ALIKE))))
    groups = (rows.groupBy("copy").agg(F.sum(F.col("size") * F.col("alike")).alias("bytes"))
              .withColumn("drop_bits", F.greatest(F.length(F.bin("bytes")) - BITS, F.lit(0)))
              .select("copy", "bytes",
                      F.expr("shiftleft(shiftright(bytes, drop_bits), drop_bits)").alias("cls"),
                      F.pmod(F.xxhash64("copy"), F.lit(n)).alias("salt")))
    groups = checkpointed(groups)
    cells = groups.groupBy("cls", "salt").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    classes = [tuple(r) for r in cells.groupBy("cls").agg(
        F.sum("n"), F.sum("bytes")).collect()]  # bounded by BITS
    dealt = docs.sparkSession.createDataFrame(
        deal(classes, shards), "cls long, begins array<long>, owners array<int>")
    before = Window.partitionBy("cls").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select("cls", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("cls", "salt").orderBy("copy")) - 1
    placed = (groups.select("cls", "salt", "copy", place.alias("place"))
              .join(offsets, ["cls", "salt"]).join(dealt, "cls")
              .select("copy", F.expr(
                  "element_at(owners, size(filter(begins, b -> b <= place + offset)))")
                  .alias("shard")))
    home = checkpointed(rows.join(placed, "copy").withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "copy", "part"), F.lit(n))))
    counts = home.groupBy("shard", "bucket").agg(F.sum("alike").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("shard", "bucket",
                         F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    own = Window.partitionBy("shard", "bucket").orderBy("doc_id", "copy", "part").rowsBetween(
        Window.unboundedPreceding, 0)
    last = F.col("base") + F.col("upto") - 1
    return (home.withColumn("upto", F.sum("alike").over(own))
            .join(base, ["shard", "bucket"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
                    F.col("shard").cast("int").alias("shard"),
                    F.explode(F.sequence((last - F.col("alike") + 1).cast("long"), last.cast("long"))).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
