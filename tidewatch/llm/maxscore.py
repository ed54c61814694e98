"""Exact top-k by inner product with MaxScore, over shards of integer vectors.

A dimension is a term; its postings in a shard are a column.  For a query a term adds at least
``low`` and at most ``low + bound`` to a score.  Queries are handled some at a time, with the
terms in one order, by bound, so that essential terms are the leading columns: those without
which a vector could not reach a query's current k-th score.  Their postings are traversed for
all vectors; the other columns are probed a few at a time, largest bounds first, for vectors
that can still compete.  A column is multiplied once for a vector, or not at all.  Shards' best
are merged by score, then vec_id.

A task holds one shard and streams the queries through it, so vectors are shuffled once for
each ``BAND_QUERIES`` queries.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_of, checkpointed, spread

K = 20
#: Vectors of a shard, which a task holds, and queries that it streams through them.
SHARD_ROWS, BAND_QUERIES = 8192, 1 << 16
#: Queries that a task handles at once: its scores are a shard's rows times these.
TOGETHER = 128
#: Vectors scored in full for a first threshold, and terms probed at a time.
SEEDS, PROBED = 1024, 16
#: Probe pairs one by one once fewer than one in so many still compete.
FEW = 64
#: Components saturate here, far above what integers of doubles keep exact.
LARGEST = float(1 << 53)
#: Scores are summed exactly and saturate here when they are returned.
LONGEST = (1 << 63) - 1

_SCHEMA = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def quantised(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """(vec_id, v): floor(scale * x) per component; rows with unusable vectors are left out."""
    x = F.col("embedding")
    usable = x.isNotNull() & F.col("vec_id").isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.filter(usable).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.least(F.greatest(
            F.floor(c.cast("double") * F.lit(float(scale))).cast("double"), F.lit(-LARGEST)), F.lit(LARGEST))
            .cast("long")).alias("v"))


def top_of_shard(ids: np.ndarray, x: np.ndarray, queries: np.ndarray, q: np.ndarray, k: int,
                 work: list[int] | None = None):
    """(query row, vector row, score) arrays of each query's ``k`` best in a shard.

    ``ids`` ascend, so of equal scores the earlier row wins.  A query's own id is no match.
    ``work`` gets the number of products of components that were made.
    """
    found = [_top_of_some(ids, x, queries[a:a + TOGETHER], q[a:a + TOGETHER], k, [] if work is None else work)
             for a in range(0, len(q), TOGETHER)] if len(x) else []
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, x.dtype)
    rows = [i + n * TOGETHER for n, (i, _, _) in enumerate(found)]
    return np.concatenate(rows), *(np.concatenate([f[c] for f in found]) for c in (1, 2))


def _top_of_some(ids: np.ndarray, x: np.ndarray, queries: np.ndarray, q: np.ndarray, k: int, work: list[int]):
    """top_of_shard for a few queries; the first ``SEEDS`` vectors set their thresholds."""
    ends = np.stack([q * x.max(axis=0), q * x.min(axis=0)])
    low, bound = ends.min(axis=0), ends.max(axis=0) - ends.min(axis=0)
    order = np.argsort(-bound.sum(axis=0), kind="stable")  # one order for these queries
    x, q, low, bound = x[:, order], q[:, order], low[:, order], bound[:, order]
    # The least any vector can score: what a query needs until it has k better ones.
    floor = low.sum(axis=1)
    own = list(zip(np.searchsorted(ids, queries), np.searchsorted(ids, queries, "right"), strict=True))
    seeds = x[:SEEDS] @ q.T
    work.append(seeds.size * x.shape[1])
    for i, (begin, end) in enumerate(own):
        seeds[begin:end, i] = floor[i] - 1
    need = floor
    if len(seeds) >= k:
        need = np.maximum(floor, np.sort(seeds, axis=0)[-k])
    row, who = np.nonzero(seeds >= need)
    found = [(who, row, seeds[row, who])]

    # rest[:, n]: what the terms from the n-th on can add to the floor.
    rest = np.concatenate([np.cumsum(bound[:, ::-1], axis=1)[:, ::-1], np.zeros_like(bound[:, :1])], axis=1)
    left_low = np.concatenate([np.cumsum(low[:, ::-1], axis=1)[:, ::-1], np.zeros_like(low[:, :1])], axis=1)
    at = min(x.shape[1], int((rest >= (need - floor)[:, None]).sum(axis=1).max(initial=0)))
    # Traverse the essential postings, then probe the others while any vector competes.
    later, rows = x[SEEDS:], np.arange(min(SEEDS, len(x)), len(x))
    alive = np.ones((len(later), len(q)), bool)
    for i, (begin, end) in enumerate(own):
        alive[max(0, begin - SEEDS):max(0, end - SEEDS), i] = False
    have = later[:, :at] @ q[:, :at].T
    work.append(have.size * at)
    while len(later):
        alive &= have + left_low[:, at] + rest[:, at] >= need
        if at == x.shape[1]:
            row, who = np.nonzero(alive)
            found.append((who, rows[row], have[row, who]))
            break
        competing = np.count_nonzero(alive)
        if competing * FEW < alive.size:
            row, who = np.nonzero(alive)
            work.append(competing * (x.shape[1] - at))
            for a in range(0, len(row), 1 << 15):
                r, i = row[a:a + (1 << 15)], who[a:a + (1 << 15)]
                score = have[r, i] + (later[r, at:] * q[i, at:]).sum(axis=1)
                good = score >= need[i]
                found.append((i[good], rows[r[good]], score[good]))
            break
        stay = np.flatnonzero(alive.any(axis=1))
        if len(stay) * 2 < len(later):
            later, rows, alive, have = later[stay], rows[stay], alive[stay], have[stay]
        to = min(at + PROBED, x.shape[1])
        have += later[:, at:to] @ q[:, at:to].T
        work.append(have.size * (to - at))
        at = to
    who, row, score = (np.concatenate([f[c] for f in found]) for c in range(3))
    best = np.lexsort((row, -score, who))
    who, row, score = who[best], row[best], score[best]
    top = np.arange(len(who)) - np.searchsorted(who, who) < k
    return who[top], row[top], score[top]


def _cells(batches: Iterator[pa.RecordBatch]):
    """For each cell of a sorted partition its shard (ids, vectors) and its queries, streamed.

    Queries come as (ids, vectors) of one batch at most; all are to be taken before the next cell.
    """
    def parts():
        for batch in batches:
            cell, asks = batch.column("cell").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(cell) != 0) | (asks[1:] != asks[:-1])) + 1
            for a, b in itertools.pairwise([0, *edges.tolist(), len(cell)]):
                if a < b:
                    yield cell[a], bool(asks[a]), batch.slice(a, b - a)

    for _, group in itertools.groupby(parts(), lambda p: p[0]):
        shard: list[pa.RecordBatch] = []
        first = next((p for p in itertools.chain(group) if p[1] or shard.append(p[2])), None)
        if first is None or not shard:
            continue
        table = pa.Table.from_batches(shard)
        yield (table.column("vec_id"), table.column("v"),
               ((part.column("vec_id").to_numpy(), pa.chunked_array([part.column("v")]))
                for _, _, part in itertools.chain([first], group)))


def _stack(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of one length, as int64, padded with zeros."""
    rows = vectors.combine_chunks()
    if isinstance(rows, pa.ChunkedArray):
        rows = rows.chunk(0)
    flat = rows.flatten().to_numpy()
    if len(flat) == len(rows) * width:
        return flat.reshape(-1, width)
    out = np.zeros((len(rows), width), np.int64)
    for i, v in enumerate(rows.to_pylist()):
        out[i, :len(v)] = v
    return out


def _kind(x: np.ndarray, q: np.ndarray, width: int) -> type:
    """Doubles while all sums are integers that doubles hold exactly, else int64, or Python
    integers where that could overflow."""
    most = max((int(np.abs(a).max()) for a in (x, q) if a.size), default=0)
    sums = 4 * most * most * max(1, width)
    return np.float64 if sums < 1 << 53 else np.int64 if sums < 1 << 63 else object


def search(vectors: DataFrame, every: int = 20, k: int = K, scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best matches of each query.

    ``vectors`` needs vec_id and embedding; other columns are ignored.  Queries are the
    rows whose id is divisible by ``every``, candidates all rows with another id.  Vectors
    that are null or hold null or non-finite components take no part, nor do rows without
    an id; shorter vectors count as padded with zeros.  A repeated id is one more candidate;
    rows of one query id share a list, and rows that are alike ask once.  Ties go to the
    smaller id.
    """
    rows = checkpointed(quantised(vectors, scale))
    is_query = F.col("vec_id") % every == 0
    n, n_queries, width = rows.agg(F.count("*"), F.count_if(is_query), F.max(F.size("v"))).first()
    shards = max(1, math.ceil(n / SHARD_ROWS))
    bands = max(1, math.ceil(n_queries / BAND_QUERIES))
    width = width or 0
    spot = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int")).withColumn(
        "band", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(bands)).cast("int"))
    held = spot.select("shard", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band"),
                       F.lit(False).alias("asks"), "vec_id", "v")
    asked = spot.filter(is_query).distinct().select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "band",
        F.lit(True).alias("asks"), "vec_id", "v")
    cells = (held.unionByName(asked).withColumn("cell", F.col("shard").cast("long") * bands + F.col("band"))
             .select("cell", "asks", "vec_id", "v"))
    tasks = min(spread(vectors.sparkSession), shards * bands)
    cells = (cells.repartitionById(tasks, F.pmod("cell", F.lit(tasks)).cast("int"))
             .sortWithinPartitions("cell", "asks", "vec_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, data, queries in _cells(batches):
            x = _stack(data, width)
            ids = ids.to_numpy()
            for asking, vectors in queries:
                q = _stack(vectors, width)
                kind = _kind(x, q, width)
                who, row, score = top_of_shard(ids, x.astype(kind), asking, q.astype(kind), k)
                yield batch_of(_SCHEMA, asking[who], ids[row],
                               np.clip(score, -LONGEST, LONGEST).astype(np.int64))

    found = cells.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
