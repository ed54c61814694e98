"""Katz backoff over words: Good-Turing discounts, exactly normalised backoff weights.

P(w | v) = d(c(v w)) c(v w) / c(v) where v w was seen, else alpha(v) P(w); P(w) is
d(c(w)) c(w) / N where w was seen, and words that never were share one event that gets
what the discounts leave.  alpha(v) is what the seen pairs leave over what P leaves to all
other words, so the probabilities after any v add up to 1.

The counts are tables partitioned by the hash of a word or pair.  Documents are scored in
batches: a batch sends each of its distinct words and pairs once, with its counts, to
their partition and gets the totals back in the same order.  So a word or pair that is a
third of all tokens is one entry per batch, not a row per occurrence.  Batches and parts
are both of bounded size; a batch sends no row to a part that it has no key for, so rows
never outnumber the batches' distinct keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import constants, crc_mod, mix64, pieces, spread, stored, texts_of, word_hashes

#: Bytes of text in a batch, about, unless that gives fewer batches than partitions.
BATCH_BYTES = 4 << 20
#: Bytes of text whose words and pairs a part counts at most, about; there are as many parts
#: as shuffle partitions unless that gives larger ones.
PART_BYTES = 64 << 20
#: Counts up to this are discounted.
DISCOUNTED = 5
WORDS, PAIRS = 0, 1

_END, _BEGIN = constants(31, 2)
_PAIR = constants(32, 2)

_SENT = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("batch", pa.int32()),
                   ("keys", pa.binary()), ("n", pa.binary())])
_SENT_SQL = "kind int, part int, batch int, keys binary, n binary"
_BACK = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("batch", pa.int32()),
                   ("total", pa.binary()), ("owner", pa.binary()), ("stats", pa.list_(pa.int64()))])
_BACK_SQL = "kind int, part int, batch int, total binary, owner binary, stats array<long>"
_HEAD = pa.schema([("part", pa.int32()), ("batch", pa.int32()), ("keys", pa.binary()),
                   ("seen", pa.binary()), ("kept", pa.binary()), ("lower", pa.binary())])
_HEAD_SQL = "part int, batch int, keys binary, seen binary, kept binary, lower binary"
_ALPHA = pa.schema([("part", pa.int32()), ("batch", pa.int32()), ("alpha", pa.binary()), ("under", pa.binary())])
_ALPHA_SQL = "part int, batch int, alpha binary, under binary"


def packed(x: np.ndarray) -> bytes:
    """Numbers of 8 bytes as the leading bytes of all, then the next: those compress well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T[::-1]).tobytes()


def unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)[::-1]
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _column(table: pa.Table, name: str, kind: type) -> list[np.ndarray]:
    return [unpacked(x, kind) for x in table.column(name).to_pylist()]


def slope(of: list[int]) -> float:
    """Slope of the line through the logarithms of the counts of counts; not finite without two of them.

    As in Simple Good-Turing, a count of counts is spread over the gap between its neighbours
    that are not zero, so that zeros in between weigh on the line.
    """
    r = np.array([i for i, n in enumerate(of, 1) if n], float)
    if len(r) < 2:
        return np.inf
    below = np.append(0.0, r[:-1])
    above = np.append(r[1:], 2 * r[-1] - r[-2])
    x, y = np.log(r), np.log(2 * np.array([n for n in of if n]) / (above - below))
    x -= x.mean()
    return float((x * y).sum() / (x * x).sum())


def discounts(of: list[int]) -> np.ndarray:
    """Factors d(r) by count r, the last for all larger ones.

    ``of[r - 1]`` is the number of things seen r times, up to ``DISCOUNTED`` + 1.  Katz's
    Good-Turing discounts of smoothed counts of counts: copies of documents bump the raw
    ones.  On a line of slope b, r* / r is ((r + 1) / r) ** (1 + b), so below -1 all factors
    are in (0, 1) and rise with r.  Any other line has no Good-Turing discount: then absolute
    discounting of the same counts.
    """
    k, b = DISCOUNTED, slope(of)
    r = np.arange(1, k + 1)
    if b < -1:
        tail = (k + 1.0) ** (1 + b)
        return np.array([0.0, *(((r + 1) / r) ** (1 + b) - tail) / (1 - tail), 1.0])
    off = of[0] / (of[0] + 2 * of[1]) if of[0] and of[1] else 0.5
    return np.array([0.0, *((r - off) / r), 1.0])


def factor(table: np.ndarray, c: np.ndarray) -> np.ndarray:
    return table[np.minimum(c, len(table) - 1)]


@dataclass
class Model:
    """What every task knows: the discounts, and the words' totals."""

    word: np.ndarray
    pair: np.ndarray
    tokens: int
    distinct: int
    #: What counts of single words are divided by, and the share of the unknown word.
    under: int
    unknown: float

    @classmethod
    def learned(cls, words: list[int], pairs: list[int]) -> Model:
        """From the numbers of things seen 1, 2, ... times, of all things, and of all counts."""
        *of, distinct, tokens = words
        table = discounts(of)
        small = [r * n for r, n in enumerate(of[:DISCOUNTED], 1)]
        # Without a discount one more count than was seen leaves a share.
        under = tokens if sum(small) else tokens + 1
        kept = sum(d * n for d, n in zip(table[1:], small, strict=False)) + tokens - sum(small)
        return cls(table, discounts(pairs[:-2]), tokens, distinct, under, 1 - kept / under)

    def lower(self, c: np.ndarray) -> np.ndarray:
        """P(w) by the count of w."""
        return np.where(c > 0, factor(self.word, c) * c / self.under, self.unknown)


class Batch:
    """The tokens of a batch of documents as numbers of its distinct words and pairs."""

    def __init__(self, table: pa.Table):
        self.table = table.combine_chunks()
        texts = [zstandard.decompress(t) for t in self.table.column("text").to_pylist()]
        parts, counts = [], []
        for a, b in pieces(texts):
            h, starts = word_hashes([t.lower() for t in texts[a:b]])
            n = np.diff(starts)
            # An end after each document's words.
            at = np.cumsum(n + 1) - 1
            tokens = np.empty(len(h) + (b - a), np.uint64)
            inner = np.ones(len(tokens), bool)
            inner[at] = False
            tokens[inner], tokens[at] = h, _END
            parts.append(tokens)
            counts.append(n + 1)
        self.n_tokens = np.concatenate([*counts, np.zeros(0, np.int64)]).astype(np.int64)
        first = np.cumsum(self.n_tokens) - self.n_tokens
        n_texts = len(texts)
        del texts
        tokens = np.concatenate([*parts, np.zeros(0, np.uint64)])
        del parts
        heads = np.empty_like(tokens)
        heads[1:] = tokens[:-1]
        heads[first] = _BEGIN
        pair = mix64(heads * _PAIR[0] + tokens * _PAIR[1])
        del heads
        self.words, word = np.unique(np.append(tokens, _BEGIN), return_inverse=True)
        del tokens
        self.word, begin = word[:-1].astype(np.int32), word[-1]
        del word
        self.head = np.empty_like(self.word)
        self.head[1:] = self.word[:-1]
        self.head[first] = begin
        self.pairs, index, inverse = np.unique(pair, return_index=True, return_inverse=True)
        self.pair = inverse.astype(np.int32)
        del pair, inverse
        self.pair_head, self.pair_word = self.head[index], self.word[index]
        self.owner = np.repeat(np.arange(n_texts, dtype=np.int32), self.n_tokens)
        train = self.table.column("train").to_numpy()
        self.train = train[self.owner] if n_texts else np.zeros(0, bool)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of the distinct words and pairs."""
        return (np.bincount(self.word[self.train], minlength=len(self.words)),
                np.bincount(self.pair[self.train], minlength=len(self.pairs)))


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, well below what the shuffle's own codec reaches."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", pa.array([squeeze(t) for t in texts_of(batch)], pa.binary()))


def by_part(keys: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each part and the places of its keys.  ``keys`` ascend and a part is a range of them."""
    part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    edge = np.flatnonzero(np.diff(part)) + 1
    for begin, end in zip([0, *edge], [*edge, len(keys)], strict=True):
        if begin < end:
            yield int(part[begin]), np.arange(begin, end)


def _lists(rows: list, schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _send(parts: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        batch, number = Batch(table), table.column("batch")[0].as_py()
        rows = []
        for kind, keys, n in zip((WORDS, PAIRS), (batch.words, batch.pairs), batch.counts(), strict=True):
            rows += [(kind, p, number, packed(keys[at]), packed(n[at])) for p, at in by_part(keys, parts)]
        return _lists(rows, _SENT)

    return run


def _laid(column: pa.ChunkedArray, turn: list[int], ends: np.ndarray, kind: type) -> np.ndarray:
    """The numbers of the column's rows in the order ``turn``, one after the other."""
    out = np.empty(ends[-1], kind)
    for i, end in zip(turn, ends.tolist(), strict=True):
        x = unpacked(column[i].as_buffer(), np.uint64 if kind is np.uint64 else np.int64)
        out[end - len(x):end] = x
    return out


def _total(table: pa.Table) -> pa.Table:
    """Totals of a part's keys for each batch; a row of batch -1 has the counts of counts.

    Of the batches that have a key the first owns it.  Arrays are let go as soon as they
    have served: a part's keys are what takes most memory of all.
    """
    kind, part = table.column("kind")[0].as_py(), table.column("part")[0].as_py()
    batches = table.column("batch").to_numpy()
    turn = np.argsort(batches).tolist()
    ends = np.cumsum([table.column("keys")[i].as_buffer().size // 8 for i in turn])
    keys = _laid(table.column("keys"), turn, ends, np.uint64)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    del keys
    n = _laid(table.column("n"), turn, ends, np.int32)
    total = np.add.reduceat(n[order], np.flatnonzero(new), dtype=np.int64)
    del n
    totals = np.empty(len(order), np.int64)
    totals[order] = np.repeat(total, np.diff(np.append(np.flatnonzero(new), len(order))))
    owner = np.empty(len(order), bool)
    owner[order] = new
    del order, new
    rows = [(kind, part, int(batches[i]), packed(totals[begin:end]), np.packbits(owner[begin:end]).tobytes(), None)
            for i, begin, end in zip(turn, [0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
    del totals, owner
    of = np.bincount(np.minimum(total, DISCOUNTED + 2), minlength=DISCOUNTED + 3)
    rows.append((kind, part, -1, None, None, [*of[1:DISCOUNTED + 2].tolist(), int((total > 0).sum()), int(total.sum())]))
    return _lists(rows, _BACK)


def _gathered(batch: Batch, back: pa.Table, parts: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Totals of the batch's words and pairs, and which pairs it owns, as _total sent them."""
    totals = [np.zeros(len(batch.words), np.int64), np.zeros(len(batch.pairs), np.int64)]
    own = np.zeros(len(batch.pairs), bool)
    places = [dict(by_part(k, parts)) for k in (batch.words, batch.pairs)]
    for kind, part, total, owner in zip(*(back.column(c) for c in ("kind", "part", "total", "owner")), strict=True):
        if kind.is_valid:
            at = places[kind.as_py()][part.as_py()]
            totals[kind.as_py()][at] = unpacked(total.as_py(), np.int64)
            if kind.as_py() == PAIRS:
                own[at] = np.unpackbits(np.frombuffer(owner.as_py(), np.uint8), count=len(at))
    return totals, own


def _heads(model: Model, parts: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """What a batch's own pairs add to the sums over each head's pairs."""
    def run(docs: pa.Table, back: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _HEAD.empty_table()
        batch = Batch(docs)
        (word, pair), own = _gathered(batch, back, parts)
        own &= pair > 0
        head, c = batch.pair_head[own], pair[own]
        sums = [np.bincount(head, weights=w, minlength=len(batch.words)) for w in (
            c, factor(model.pair, c) * c, model.lower(word[batch.pair_word[own]]))]
        used = np.unique(batch.head)
        keys, number = batch.words[used], docs.column("batch")[0].as_py()
        return _lists([(p, number, packed(keys[at]), *(packed(s[used[at]]) for s in sums))
                       for p, at in by_part(keys, parts)], _HEAD)

    return run


def backoff(seen: np.ndarray, kept: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """alpha(v) and what counts after v are divided by.

    If no pair after v is discounted, one more count than was seen leaves a share.
    """
    whole = seen - kept < 1e-9 * np.maximum(seen, 1)
    under = np.where(whole, seen + 1, np.maximum(seen, 1))
    alpha = np.where(seen > 0, (1 - kept / under) / np.maximum(1 - lower, 1e-300), 1.0)
    return alpha, under


def _alphas(table: pa.Table) -> pa.Table:
    keys = _column(table, "keys", np.uint64)
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    alpha, under = backoff(*(np.bincount(inverse, weights=np.concatenate(_column(table, c, np.float64)),
                                         minlength=len(distinct)) for c in ("seen", "kept", "lower")))
    ends = np.cumsum([len(k) for k in keys])
    places = [inverse[e - len(k):e] for k, e in zip(keys, ends, strict=True)]
    return _lists([(part, b, packed(alpha[at]), packed(under[at])) for part, b, at in zip(
        table.column("part").to_pylist(), table.column("batch").to_pylist(), places, strict=True)], _ALPHA)


_SCORE = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                    ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
_SCORE_SQL = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
              "base_score double, score double")


def _scores(model: Model, parts: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _SCORE.empty_table()
        batch = Batch(docs)
        (word, pair), _ = _gathered(batch, answers, parts)
        alpha, under = np.ones(len(batch.words)), np.ones(len(batch.words))
        used = np.unique(batch.head)
        places = dict(by_part(batch.words[used], parts))
        for part, a, u in zip(*(answers.column(c) for c in ("part", "alpha", "under")), strict=True):
            if a.is_valid:
                at = used[places[part.as_py()]]
                alpha[at], under[at] = unpacked(a.as_py(), np.float64), unpacked(u.as_py(), np.float64)
        # Pair, else word, else the unknown word.
        p = np.where(pair > 0, factor(model.pair, pair) * pair / under[batch.pair_head],
                     alpha[batch.pair_head] * model.lower(word[batch.pair_word]))
        n = len(batch.n_tokens)
        c = word[batch.word]
        base = np.log10((c + 0.5) / (model.tokens + 0.5 * (model.distinct + 1)))
        sums = [np.bincount(batch.owner, weights=w, minlength=n) for w in (c > 0, base, np.log10(np.maximum(p, 1e-300))[batch.pair])]
        train = batch.table.column("train").to_numpy()
        return pa.table([batch.table.column("doc_id"), pa.array(~train), pa.array(batch.n_tokens),
                         pa.array(sums[0].astype(np.int64)), pa.array(np.full(n, model.tokens)),
                         pa.array(sums[1]), pa.array(sums[2])], schema=_SCORE)

    return run


def score_documents(docs: DataFrame, folds: int = 5, held: int = 1, batch_bytes: int = BATCH_BYTES,
                    part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``docs`` needs doc_id and text; other columns are ignored.  Tokens are the words in
    lower case (A-Z) and one end; a null text has the end only.  Learns from all rows whose
    crc32 of the id modulo ``folds`` is not ``held``; a null id hashes like the empty text.
    base_score adds up add-one-half log10 probabilities of single tokens, score those of
    the backoff model.  If nothing is learned from, every token is the unknown word, which
    has probability 1.  Repeated rows are learned from and scored as often as they occur; an empty
    table gives an empty result.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(spread(docs.sparkSession), -(-size // part_bytes))
    batches = max(spread(docs.sparkSession), -(-size // batch_bytes))
    mark = crc_mod(F.col("doc_id"), folds) != held
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", mark.alias("train"),
                       F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int").alias("batch"))
    rows = rows.mapInArrow(_squeeze, "doc_id long, text binary, train boolean, batch int")
    sent = rows.groupBy("batch").applyInArrow(_send(parts), _SENT_SQL)
    back = stored(sent.groupBy("kind", "part").applyInArrow(_total, _BACK_SQL))
    n = DISCOUNTED + 3
    stats = {kind: row for kind, *row in back.filter("batch = -1").groupBy("kind").agg(
        *(F.sum(F.col("stats")[i]) for i in range(n))).collect()}
    model = Model.learned(stats.get(WORDS, [0] * n), stats.get(PAIRS, [0] * n))
    back = back.filter("batch >= 0").drop("stats")
    heads = rows.groupBy("batch").cogroup(back.groupBy("batch")).applyInArrow(_heads(model, parts), _HEAD_SQL)
    alphas = heads.groupBy("part").applyInArrow(_alphas, _ALPHA_SQL)
    answers = back.unionByName(alphas, allowMissingColumns=True)
    return rows.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(_scores(model, parts), _SCORE_SQL)

