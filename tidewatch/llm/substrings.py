"""Removal of passages that an earlier document has, by seeding and extending.

Every run of ``WINDOW`` words holds an anchor: of the ``ANCHOR``-word runs in it, the one
with the least hash (winnowing).  Equal windows have equal anchors at equal places, so
only documents that share an anchor can share a window.

1. Each document's anchors are grouped by hash together with a hash of the words that the
   windows around it can reach, so that the match is extended both ways at once.  An
   anchor whose whole surroundings occur in an earlier document is settled: all its
   windows are repeats.
2. Where surroundings differ, the match ends nearby.  One representative of each kind of
   surroundings, in the earliest document, is extended window by window.

Before rows meet, each task settles what it can among its own, so a passage that a third
of all documents share reaches a group once per task.  Settled rows travel with a random
key.  Repeats are thus maximal: a word goes exactly if a window over it occurs earlier.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, constants, mix64, pieces, rolled, runs_of, stored, texts_of, word_hashes

WINDOW = 13
ANCHOR = 5
LEAST_ID = -(1 << 63)
#: Hashed rows that a task settles among themselves before they leave it.
TOGETHER = 1 << 20

_ROW = pa.schema([("k", pa.int64()), ("c", pa.int64()), ("doc", pa.int64()), ("row", pa.int32()),
                  ("at", pa.int32()), ("seen", pa.bool_())])
_ROW_SQL = "k long, c long, doc long, row int, at int, seen boolean"


def anchors(h: np.ndarray, starts: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR):
    """Places of anchors in the texts' word hashes, their hash, and that of their surroundings.

    ``starts`` are the texts' first words and the end.  Of equal hashes the rightmost wins.
    Surroundings end where a text ends.
    """
    reach = window - anchor
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    grams = rolled(h, anchor, 21)
    if not len(grams):
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), owner)
    n = len(h) - window + 1
    if n <= 0:
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), owner)
    best, place = grams[:n].copy(), np.zeros(n, np.int8)
    for j in range(1, reach + 1):
        g = grams[j:j + n]
        less = g <= best
        best[less], place[less] = g[less], j
    whole = np.flatnonzero(owner[:n] == owner[window - 1:])
    at = np.unique(whole + place[whole])
    around = np.zeros(len(at), np.uint64)
    own = owner[at]
    factors = constants(22, window + reach + 1)
    first, end = starts[own], starts[own + 1]
    for j in range(-reach, anchor + reach):
        i = at + j
        inside = (i >= first) & (i < end)
        around += np.where(inside, h[np.clip(i, 0, len(h) - 1)], np.uint64(1)) * factors[j + reach]
    return at, grams[at], mix64(around), owner


def _settle(k: np.ndarray, c: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which rows have another with the same k and c and a lesser doc."""
    order = np.lexsort((doc, c, k))
    k, c, doc = k[order], c[order], doc[order]
    new = np.append(True, (k[1:] != k[:-1]) | (c[1:] != c[:-1]))
    first = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
    seen = np.empty(len(k), bool)
    seen[order] = doc > doc[first]
    return seen


def _emit(cols: list[np.ndarray]) -> pa.RecordBatch:
    """Settled rows leave under a random key: they only pass through."""
    k, c, doc, row, at = cols
    seen = _settle(k, c, doc)
    random = mix64(doc.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + at.astype(np.uint64)).view(np.int64)
    return batch_of(_ROW, np.where(seen, random, k), np.where(seen, 0, c), doc, row, at, seen)


class _Gather:
    """Collects rows and emits them settled, ``TOGETHER`` at a time."""

    def __init__(self):
        self.rows: list[list[np.ndarray]] = []
        self.n = 0

    def add(self, *cols: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.rows.append(list(cols))
        self.n += len(cols[0])
        if self.n >= TOGETHER:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            yield _emit([np.concatenate(x) for x in zip(*self.rows, strict=True)])
        self.rows, self.n = [], 0


def _anchor_rows(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Gather()
        for batch in batches:
            texts = texts_of(batch)
            docs, rows = (batch.column(c).to_numpy() for c in ("doc", "row"))
            for a, b in pieces(texts):
                h, starts = word_hashes(texts[a:b])
                at, key, around, owner = anchors(h, starts, window, anchor)
                own = owner[at] if len(at) else at
                yield from out.add(
                    key.view(np.int64), around.view(np.int64), docs[a:b][own], rows[a:b][own],
                    (at - starts[own]).astype(np.int32))
        yield from out.flush()

    return run


def _meet(extend: bool):
    """Over partitions sorted by k, c and doc: which rows are seen, which are to be extended.

    With ``extend``, rows that are not seen but share k with other surroundings in another
    document come out unseen; all others that are not seen are dropped.  Of a key that
    spans batches a few witnesses are carried on, and the rows that nothing is decided
    about yet, which are rows of one document; so a frequent anchor is never held whole.
    """

    def judge(cols: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        k, c, doc, _, _, passing = cols
        new_k = np.concatenate([[True], k[1:] != k[:-1]])
        new = new_k | np.concatenate([[True], c[1:] != c[:-1]])
        # Rows that only pass through form no groups; their keys are random.
        first = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
        seen = passing | ((doc > doc[first]) & ~passing[first])
        if not extend:
            return seen, seen
        group = np.cumsum(new_k) - 1
        begin = np.flatnonzero(new_k)
        kinds = np.bincount(group, weights=new & ~passing)
        several = (kinds > 1) & (np.minimum.reduceat(doc, begin) < np.maximum.reduceat(doc, begin))
        return seen, seen | several[group]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols = [np.zeros(0, f.type.to_pandas_dtype()) for f in _ROW]
        out = np.zeros(0, bool)
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [np.concatenate([x, batch.column(f.name).to_numpy(zero_copy_only=False)])
                    for x, f in zip(cols, _ROW, strict=True)]
            out = np.concatenate([out, np.zeros(batch.num_rows, bool)])
            seen, keep = judge(cols)
            now = keep & ~out
            yield batch_of(_ROW, *(x[now] for x in (*cols[:5], seen)))
            # The last key may go on: its first row, its last kind's, its least and greatest doc.
            begin = int(np.searchsorted(cols[0], cols[0][-1]))
            c, doc = cols[1][begin:], cols[2][begin:]
            stay = np.zeros(len(out), bool)
            stay[begin + np.array([0, np.searchsorted(c, c[-1]), doc.argmin(), doc.argmax()])] = True
            if extend:
                stay[begin:] |= ~keep[begin:]
            out = (keep if extend else np.ones(len(out), bool))[stay]
            cols = [x[stay] for x in cols]

    return run


def _matched(rows: DataFrame, extend: bool) -> DataFrame:
    return runs_of(rows, "k", "c", "doc").mapInArrow(_meet(extend), _ROW_SQL)


def _window_rows(window: int, anchor: int):
    """The windows whose anchor is one of the places in ``ends`` (see repeats)."""
    reach = window - anchor

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Gather()
        for batch in batches:
            texts = texts_of(batch)
            docs, rows = (batch.column(c).to_numpy() for c in ("doc", "row"))
            ends = batch.column("ends").to_pylist()
            for a, b in pieces(texts):
                h, starts = word_hashes(texts[a:b])
                if len(h) < window:
                    continue
                at = np.concatenate([np.asarray(e, np.int64) + s for e, s in zip(ends[a:b], starts[:-1], strict=True)])
                own = np.repeat(np.arange(b - a), [len(e) for e in ends[a:b]])
                begin = (at[:, None] - np.arange(reach + 1)[None, :]).ravel()
                own = np.repeat(own, reach + 1)
                fits = (begin >= starts[own]) & (begin + window <= starts[own + 1])
                begin, first = np.unique(begin[fits], return_index=True)
                own = own[fits][first]
                k, c = rolled(h, window, 23)[begin], rolled(h, window, 24)[begin]
                yield from out.add(k.view(np.int64), c.view(np.int64), docs[a:b][own], rows[a:b][own],
                                   (begin - starts[own]).astype(np.int32))
        yield from out.flush()

    return run


def _cut(window: int, anchor: int):
    """Counts and the digest of the words that stay."""
    reach = window - anchor
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept = [], [], []
            for text, around, begins in zip(texts_of(batch), batch.column("around").to_pylist(),
                                            batch.column("begins").to_pylist(), strict=True):
                words = text.split()
                n = len(words)
                gone = 0
                if around or begins:
                    edge = np.zeros(n + 1, np.int64)
                    a = np.asarray(around or [], np.int64)
                    # All windows over a settled anchor: its surroundings, if a window fits.
                    np.add.at(edge, np.maximum(a - reach, 0), 1)
                    np.add.at(edge, np.minimum(a + window, n), -1)
                    s = np.asarray(begins or [], np.int64)
                    np.add.at(edge, s, 1)
                    np.add.at(edge, s + window, -1)
                    out = np.cumsum(edge[:n]) > 0
                    gone = int(out.sum())
                    words = [words[i] for i in np.flatnonzero(~out)]
                total.append(n)
                removed.append(gone)
                kept.append(b" ".join(words))
            yield batch_of(schema, batch.column("doc"), total, removed, kept)

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (the words left, as UTF-8).

    ``docs`` needs doc_id and text; other columns are ignored.  A word is removed if a run
    of ``window`` words over it also starts in a document with a lesser doc_id.  A null
    text has no words.  A document without an id is never earlier and keeps all its words.
    Rows with the same id do not remove from one another; each is judged against lesser
    ids.  An empty table gives an empty result.
    """
    # Nothing is earlier than the least id, so what has none may stand beside it.  Keys are
    # never null: Spark would filter nulls for one of the joins below, which could then not
    # share its shuffle with the other.
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(F.coalesce(doc_id, F.lit(LEAST_ID)).alias("doc"), doc_id.isNotNull().alias("known"),
                       F.coalesce("text", F.lit("")).alias("text"))
    # The hash tells texts of one id apart.
    rows = rows.withColumn("row", F.hash("text")).select("doc", "row", "known", "text")
    same = ["doc", "row"]
    met = stored(_matched(rows.filter("known").mapInArrow(_anchor_rows(window, anchor), _ROW_SQL), True)
                 .select("doc", "row", "at", "seen"))
    settled = met.filter("seen").groupBy(same).agg(F.collect_set("at").alias("around"))
    ends = met.filter("not seen").groupBy(same).agg(F.collect_set("at").alias("ends"))
    # Both joins read the texts from one shuffle.
    begun = rows.join(ends, same).mapInArrow(_window_rows(window, anchor), _ROW_SQL)
    begins = _matched(begun, False).groupBy(same).agg(F.collect_set("at").alias("begins"))
    judged = rows.join(settled.join(begins, same, "full"), same, "left")
    judged = judged.withColumn("doc", F.when(F.col("known"), F.col("doc")))
    return judged.select("doc", "text", "around", "begins").mapInArrow(
        _cut(window, anchor), "doc_id long, n_words long, n_removed long, kept binary")
