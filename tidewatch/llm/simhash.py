"""Near copies by SimHash, found with multi-index hashing.

A fingerprint is cut into segments.  Of two fingerprints that differ in at most ``bits``
bits, one segment differs in at most bits // segments of them, so each fingerprint looks
into the table of every segment at all values of that small Hamming ball; whatever is met
there is verified on the complete distance.  Fingerprints are made distinct first, so
exact copies cost one row.

A table entry that many fingerprints share would mean a quadratic number of comparisons.
Entries above ``CROWD`` are joined through midpoints instead: two fingerprints differ in
at most ``bits`` bits exactly if some value lies within half of them of both, and a value
has a bounded number of fingerprints around it.  If ``bits`` is odd, the value lies within
the lesser half of one and the greater half of the other.  A comparison costs about a
nanosecond and a midpoint a microsecond, hence the limit.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, checkpointed, runs_of, texts_of, with_key
from .components import components

WORDS = 4
SEED = 42
BITS = 4
#: Fingerprints in one table entry up to which a task compares them directly.
CROWD = 16384


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """The SimHash of a text's shingles; 0 if it has no word."""
    w = text.lower().split()
    if not w:
        return 0
    if len(w) <= words:
        return xxhash.xxh64_intdigest(b" ".join(w), seed=SEED)
    digest, join = functools.partial(xxhash.xxh64_intdigest, seed=SEED), b" ".join
    ones, n = np.zeros(64, np.int64), len(w) - words + 1
    for at in range(0, n, 65536):  # bounds memory on very long texts
        to = min(n, at + 65536)
        h = np.fromiter(map(digest, map(join, zip(*(w[at + j:to + j] for j in range(words)), strict=True))),
                        np.uint64, to - at)
        for b in range(0, 64, 8):
            byte = ((h >> np.uint64(b)) & np.uint64(255)).astype(np.uint8)
            ones[b:b + 8] += np.bincount(byte, minlength=256) @ _BYTE_BITS
    return int(sum(1 << b for b in np.flatnonzero(2 * ones > n).tolist()))


#: Row v has the eight bits of v, the lowest first.
_BYTE_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, fp): the fingerprint of each row's text as a signed long."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t, words) for t in texts_of(batch)], np.uint64)
            yield batch_of(schema, batch.column("doc_id"), fp.view(np.int64))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, fp long")


def segments_for(n: int, bits: int) -> int:
    """Few segments look up many values, many segments meet many strangers: about
    64 / log2(n) of them balance the two; any number gives the same links."""
    return max(2, min(bits + 1, round(64 / max(12.0, float(np.log2(max(n, 2)))))))


def _layout(segments: int) -> list[tuple[int, int]]:
    edges = [64 * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in itertools.pairwise(edges)]


def _ball(width: int, radius: int) -> np.ndarray:
    """All patterns of ``width`` bits with at most ``radius`` set, the empty one first."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1)
                     for c in itertools.combinations(range(width), r)], np.uint64)


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


_ENTRY = pa.schema([("entry", pa.int64()), ("fp", pa.int64()), ("home", pa.bool_())])


def _entries(segments: int, radius: int):
    """Table entries of fingerprints: home at their own values, visits in the ball around.

    Of two values that differ only one needs to visit: the one with the lower parity of
    bits if the parities differ, either if they are the same.
    """
    layout = _layout(segments)
    balls = [_ball(width, radius) for _, width in layout]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column("fp").to_numpy().view(np.uint64)
            for i in range(0, len(every), 4096):
                fp = every[i:i + 4096]
                for k, ((at, width), ball) in enumerate(zip(layout, balls, strict=True)):
                    value = (fp >> np.uint64(at)) & np.uint64((1 << width) - 1)
                    met = value[:, None] ^ ball[None, :]
                    odd_flips = (popcount(ball) & 1).astype(bool)
                    even = (popcount(value) & 1) == 0
                    go = even[:, None] | ~odd_flips[None, :]
                    who, flip = np.nonzero(go)
                    key = met[who, flip] * np.uint64(8) + np.uint64(k)
                    yield batch_of(_ENTRY, key.view(np.int64), fp[who].view(np.int64), flip == 0)

    return run


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _links_in(entry: np.ndarray, fp: np.ndarray, home: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Links that connect what the sorted entries have within ``bits``; homes come first.

    Entries of a few rows are compared by shifting the columns against themselves, all at
    once; larger ones row by row.  Only links that join two parts of an entry are kept.
    """
    n = len(entry)
    begin = np.flatnonzero(np.concatenate([[True], entry[1:] != entry[:-1]]))
    size = np.diff(np.append(begin, n))
    group = np.repeat(np.arange(len(begin)), size)
    size_of = size[group]
    small = size_of <= 16
    for lag in range(1, 16):
        i = np.flatnonzero(small[:-lag] & (group[lag:] == group[:-lag]) & home[:-lag]) if n > lag else []
        if not len(i):
            break
        near = popcount(fp[i] ^ fp[i + lag]) <= bits
        i = i[near]
        yield batch_of(_LINK, fp[i].view(np.int64), fp[i + lag].view(np.int64))
    for g in np.flatnonzero((size > 16)):
        f, h = fp[begin[g]:begin[g] + size[g]], home[begin[g]:begin[g] + size[g]]
        homes = int(h.sum())
        a, b = _forest(f, homes, bits)
        yield batch_of(_LINK, a.view(np.int64), b.view(np.int64))


def _forest(f: np.ndarray, homes: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of ``f`` under distance; a pair needs one of the homes."""
    left = np.ones(len(f), bool)
    a, b = [], []
    for root in range(homes):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue:
            i = queue.pop()
            reach = left.copy()
            if i >= homes:
                reach[homes:] = False  # two visitors meet elsewhere if they must
            j = np.flatnonzero(reach)
            j = j[popcount(f[j] ^ f[i]) <= bits]
            left[j] = False
            a.append(np.full(len(j), f[i], np.uint64))
            b.append(f[j])
            queue.extend(j.tolist())
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.uint64),) * 2


def _compare(bits: int):
    """Over partitions sorted by entry: an entry may span batches, so its rows are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)]
        for batch in batches:
            rows = [np.concatenate([k, x]) for k, x in zip(kept, (
                batch.column("entry").to_numpy(), batch.column("fp").to_numpy().view(np.uint64),
                batch.column("home").to_numpy(zero_copy_only=False)), strict=True)]
            if not len(rows[0]):
                continue
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            yield from _links_in(*(x[:cut] for x in rows), bits)
            kept = [x[cut:] for x in rows]
        if len(kept[0]):
            yield from _links_in(*kept, bits)

    return run


def _midpoint_links(fps: DataFrame, bits: int) -> DataFrame:
    """Links among ``fps`` through the values around each fingerprint.

    All around a value are linked to the least of those within half of ``bits`` of it.
    """
    half = bits // 2
    ball = _ball(64, bits - half)
    near = popcount(ball) <= half
    schema = pa.schema([*_LINK, ("near", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for i in range(0, len(fp), 64):
                some = fp[i:i + 64]
                around = (some[:, None] ^ ball).ravel()
                yield batch_of(schema, around.view(np.int64), np.repeat(some, len(ball)).view(np.int64),
                               np.tile(near, len(some)))

    around = fps.mapInArrow(run, "a long, b long, near boolean")
    # For an even number of bits all are near.
    least = around.groupBy("a").agg(F.min(F.when(F.col("near"), F.col("b"))).alias("m"), F.min("b").alias("n"),
                                    F.max("b").alias("x")).filter("m is not null and n < x")
    return (around.join(least.select("a", "m"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a <> b").distinct())


def _crowded(fps: DataFrame, segments: int, radius: int, crowd: int) -> DataFrame:
    """(entry,) with more than ``crowd`` rows; no other has more than twice as many.

    Rows come from homes at most ``radius`` away.  If there are many, then some come from
    homes with a share of ``crowd`` or more, of which there are few.
    """
    balls = [_ball(width, radius) for _, width in _layout(segments)]
    share = crowd // max(map(len, balls))
    homes = fps.mapInArrow(_entries(segments, 0), "entry long, fp long, home boolean")
    heavy = homes.groupBy("entry").agg(F.count("*").alias("n")).filter(f"n > {share}")
    schema = pa.schema([("entry", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for entry, n in zip(*(batch.column(c).to_pylist() for c in ("entry", "n")), strict=True):
                around = np.uint64(entry) ^ (balls[entry % 8] << np.uint64(3))
                yield batch_of(schema, around.view(np.int64), np.full(len(around), n))

    return heavy.mapInArrow(run, "entry long, n long").groupBy("entry").agg(
        F.sum("n").alias("n")).filter(f"n > {crowd}").select("entry")


def links(fps: DataFrame, bits: int = BITS, crowd: int = CROWD) -> DataFrame:
    """(a, b): links within ``bits`` that connect distinct fingerprints ``fps`` (fp).

    Not all pairs: any two fingerprints within ``bits`` are connected by links, and every
    link is within ``bits``.
    """
    segments = segments_for(fps.count(), bits)
    radius = bits // segments
    entries = fps.mapInArrow(_entries(segments, radius), "entry long, fp long, home boolean")
    crowds = checkpointed(_crowded(fps, segments, radius, crowd))
    if not crowds.isEmpty():
        many = checkpointed(entries.join(crowds, "entry", "left_semi").select("fp").distinct())
        through = _midpoint_links(many, bits)
        entries = entries.join(crowds, "entry", "left_anti")
    else:
        through = None
    direct = runs_of(entries, "entry", F.desc("home")).mapInArrow(_compare(bits), "a long, b long")
    return direct if through is None else direct.union(through)


def near_copies(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    ``docs`` needs doc_id and text; other columns are ignored.  A null or empty text has
    fingerprint 0 and is linked like any other; a text with fewer words than a shingle is
    one shingle.  component_id is the least doc_id of the component (null if all ids in it
    are null).  Repeated rows come out as often as they came in; an empty table gives an
    empty result.
    """
    rows = checkpointed(fingerprints(docs, words))
    return rows.join(_members(rows, bits), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _members(rows: DataFrame, bits: int) -> DataFrame:
    """(fp, component_id, root) of each fingerprint in ``rows`` (doc_id, fp).

    The nodes that are linked carry their least doc_id in front, known ids first, so the least
    node of a component has the component's id: no component is gathered to find it.
    """
    distinct = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    node = F.struct(F.col("first").isNull().alias("lost"), "first", "fp")
    ends = distinct.select(F.col("fp").alias("end"), node.alias("node"))
    pairs = links(distinct.select("fp"), bits)
    for c in ("a", "b"):
        pairs = pairs.join(ends.select(F.col("end").alias(c), F.col("node").alias(f"node_{c}")), c)
    roots = components(pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))
    found = distinct.join(roots.select(F.col("node.fp").alias("fp"), "root"), "fp", "left")
    alone = F.col("root").isNull()
    return checkpointed(found.select(
        "fp", F.when(alone, F.col("first")).otherwise(F.col("root.first")).alias("component_id"),
        F.when(alone, F.col("fp")).otherwise(F.col("root.fp")).alias("root")))


def keep_one(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """One row of each component of near_copies, all columns: the one with the least doc_id.

    A row without an id stays only if its component has no other; of rows with the same id
    one stays, and repeated rows count once.
    """
    docs, key = with_key(docs)
    rows = checkpointed(fingerprints(
        docs.withColumn("doc_id", F.col(key)), words).withColumnRenamed("doc_id", key).join(
        docs.select(key, F.col("doc_id").cast("long").alias("doc_id")).groupBy(key).agg(
            F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")), key))
    member = _members(rows.select("doc_id", "fp"), bits)
    stay = (rows.join(member, "fp").groupBy("root")
            .agg(F.min_by(F.struct(key, "copies"), F.struct(F.col("doc_id").isNull(), "doc_id", key)).alias("x"))
            .select(f"x.{key}", "x.copies"))
    stay = checkpointed(stay)
    single = docs.join(stay.filter("copies = 1"), key, "left_semi")
    repeated = docs.join(stay.filter("copies > 1"), key, "left_semi").dropDuplicates([key])
    return single.unionByName(repeated).drop(key)
