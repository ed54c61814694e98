"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding maps look-alike letters and digits that stand for letters to plain ones, so
disguised words meet the lexicon.  The lexicon (beginnings of words and their weights),
the exception phrases and the two numbers that turn a weight into a score are learned
from labelled documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_of, checkpointed, crc_mod, kept_rows, rolled, stored, word_hashes

#: Labelled documents that the lexicon is learned from, about.
SAMPLE_DOCS = 40_000
#: Lengths of word beginnings that may become lexicon entries; shorter words enter whole.
STEMS = (4, 5, 6, 7, 8, 12)
#: Least log odds of an entry, and entries at most.
LEAST_WEIGHT, MOST_ENTRIES = 2.0, 20_000
#: Log odds from which a key is counted again without exceptions; toxic documents it needs.
MAYBE_WEIGHT, LEAST_DOCS = 0.3, 3
#: An exception is a two-word phrase seen in this many clean documents, and in no more
#: than a tenth as many toxic ones.
EXCEPTION_DOCS = 3
#: Phrases, the most frequent ones, that are taken off a key before its odds are judged.
PHRASES_OFF = 8

#: Letters that look like Latin ones, and digits and signs used for letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "ո": "n", "α": "a", "β": "b",
    "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s",
}
_FOLD = str.maketrans(LOOK_ALIKES)
_GAP = re.compile(r"[\W_]+")


def fold(text: str) -> str:
    """Lower-cased, look-alikes replaced, one blank around and between words."""
    return f" {_GAP.sub(' ', text.lower().translate(_FOLD)).strip()} "


@dataclass
class Lexicon:
    """Entries " stem" and weights, exception phrases " a b ", and the score's two numbers."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    slope: float = 1.0
    offset: float = -4.0

    def matcher(self) -> ahocorasick.Automaton:
        a = ahocorasick.Automaton()
        for k, w in self.weights.items():
            a.add_word(k, (len(k), w))
        for k in self.exceptions:
            a.add_word(k, (len(k), 0.0))
        a.make_automaton()
        return a

    def score(self, strength: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.slope * strength + self.offset))))


def hits(folded: str, matcher: ahocorasick.Automaton) -> list[tuple[int, float]]:
    """Begin and weight of each word that an entry begins, without those in exceptions.

    Both come in the order of the text and are merged, so time is linear in its length.
    """
    best: dict[int, float] = {}
    free: list[tuple[int, int]] = []
    if not len(matcher):
        return []
    for end, (length, weight) in matcher.iter(folded):
        begin = end - length + 1
        if weight:
            best[begin] = max(weight, best.get(begin, 0.0))
        else:
            free.append((begin, end))
    return [(b, best[b]) for b in _outside(sorted(best), free)]


def _outside(places: list[int], free: list[tuple[int, int]]) -> Iterator[int]:
    """Those of the ascending ``places`` that lie in none of the ranges."""
    ranges, at, reach = sorted(free), 0, -1
    for place in places:
        while at < len(ranges) and ranges[at][0] <= place:
            reach = max(reach, ranges[at][1])
            at += 1
        if place >= reach:
            yield place


def strength(folded: str, matcher: ahocorasick.Automaton) -> float:
    """The weights found, over a slowly growing function of the number of words."""
    found = hits(folded, matcher)
    return sum(w for _, w in found) / (1 + math.log1p(folded.count(" ") / 100)) if found else 0.0


def _stems_of(word: str) -> list[str]:
    """The entries that could find a word: its beginnings, or all of a short word."""
    if len(word) < STEMS[0]:
        return [f" {word} "]
    return [" " + word[:n] for n in STEMS if len(word) >= n]


def _stems(folded: str) -> set[str]:
    return {k for w in set(folded.split()) for k in _stems_of(w)}


def _counted(rows: DataFrame, keys) -> DataFrame:
    """(key, clean, toxic): documents of both kinds that have the key."""
    schema = pa.schema([("key", pa.string()), ("toxic", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tally: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic")), strict=True):
                tally[toxic].update(keys(fold(text)))
            for toxic, t in enumerate(tally):
                yield batch_of(schema, list(t), [toxic] * len(t), list(t.values()))

    return rows.mapInArrow(run, "key string, toxic int, n long").groupBy("key").agg(
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean"),
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"))


def _told(counted: DataFrame, least: str) -> dict[str, tuple[int, int]]:
    return {k: (c, t) for k, c, t in counted.filter(least).collect()}


def _clean_phrases(rows: DataFrame, keys: set[str]) -> DataFrame:
    """(stem, phrase, clean, toxic): harmless phrases of the words that ``keys`` could find.

    A phrase is a word and a neighbour.  Phrases are counted where the texts are, whatever the
    odds of the word.
    """
    def phrases(folded: str) -> set[str]:
        ws = folded.split()
        wanted = {w for w in set(ws) if not keys.isdisjoint(_stems_of(w))}
        return {f" {a} {b} " for a, b in zip(ws, ws[1:]) if a in wanted or b in wanted}

    counted = _counted(rows, phrases).filter(f"clean >= {EXCEPTION_DOCS} and toxic * 10 <= clean")
    word = F.explode(F.array_distinct(F.split(F.trim("key"), " "))).alias("word")
    stems = F.when(F.length("word") < STEMS[0], F.array(F.concat(F.lit(" "), "word", F.lit(" ")))).otherwise(
        F.transform(F.filter(F.array(*map(F.lit, STEMS)), lambda n: n <= F.length("word")),
                    lambda n: F.concat(F.lit(" "), F.substr("word", F.lit(1), n))))
    return counted.select(word, F.col("key").alias("phrase"), "clean", "toxic").select(
        F.explode(stems).alias("stem"), "phrase", "clean", "toxic").distinct()


def _least_shingle(docs: DataFrame) -> DataFrame:
    """``docs`` with the least hash of the text's four-word shingles: near copies agree."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("toxic", pa.int32()), ("like", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            like = []
            for t in batch.column("text").to_pylist():
                h, _ = word_hashes([t.lower().encode()])
                s = rolled(h, min(4, max(1, len(h))), 5)
                like.append(int(s.min().astype(np.int64)) if len(s) else 0)
            yield batch_of(schema, batch.column("doc_id"), batch.column("text"), batch.column("toxic"), like)

    return docs.mapInArrow(run, "doc_id long, text string, toxic int, like long")


def _sampled(rows: DataFrame, n: int, sample_docs: int) -> DataFrame:
    """About ``sample_docs`` of the ``n`` rows, by their doc_id."""
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) / float(1 << 20)
    return rows.filter(place < min(1.0, sample_docs / n))


def learn(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Lexicon:
    """A lexicon from ``labelled`` (doc_id, text, toxic 0 or 1), from a bounded sample."""
    n = labelled.count()
    return _learned(_sampled(labelled, n, sample_docs)) if n else Lexicon()


def _learned(some: DataFrame) -> Lexicon:
    """A lexicon from all of ``some`` (doc_id, text, toxic).

    Of near copies one is used, so that a much copied text does not make its words weigh.
    An entry needs log odds and evidence that chance would not give to any candidate.
    """
    one = (_least_shingle(some).groupBy("like", "toxic").agg(F.min_by("text", "doc_id").alias("text"))
           .select("text", "toxic").cache())
    try:
        totals = dict(one.groupBy("toxic").count().collect())
        clean, toxic = totals.get(0, 0), totals.get(1, 0)
        if not clean or not toxic:
            return Lexicon()
        p = toxic / (clean + toxic)
        floor = math.log(max(10, 1000 * (clean + toxic)))

        def strong(found: dict[str, tuple[int, int]], least: float) -> dict[str, float]:
            out = {}
            for k, (c, t) in found.items():
                if t < LEAST_DOCS:
                    continue
                share = t / (c + t)
                weight = math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
                surprise = t * math.log(share / p) + (c * math.log((1 - share) / (1 - p)) if c else 0)
                if share > p and weight >= least and surprise > floor:
                    out[k] = weight
            return out

        found = _told(_counted(one, _stems), f"toxic >= {LEAST_DOCS}")
        # Keys that could be entries if their clean documents were due to harmless phrases: for
        # those the phrases are counted, and the odds are judged without them.
        hopeful = {k: v for k, v in found.items() if strong({k: (0, v[1])}, LEAST_WEIGHT)}
        harmless: dict[str, list[tuple[str, int, int]]] = {}
        for stem, phrase, c, t in _rescuing(one, hopeful, clean, toxic).collect():
            harmless.setdefault(stem, []).append((phrase, c, t))
        off = lambda k, i: max(0, hopeful[k][i] - sum(p[1 + i] for p in harmless[k]))
        rescued = set(strong({k: (off(k, 0), off(k, 1)) for k in harmless}, LEAST_WEIGHT))
        exceptions = tuple(sorted({p for k in rescued for p, _, _ in harmless[k]}))
        maybe = strong(found, MAYBE_WEIGHT).keys() | rescued
        made: list = []

        def unspared(folded: str) -> set[str]:
            if not made:
                made.append(Lexicon({}, exceptions).matcher())
            ws = folded.split()
            begins = np.cumsum([0, *(len(w) + 1 for w in ws[:-1])]).tolist()
            free = [(end - length + 1, end) for end, (length, _) in made[0].iter(folded)] if exceptions else []
            left = set(_outside(begins, free))
            return {k for w, b in zip(ws, begins) if b in left for k in _stems_of(w)} & maybe

        weights = strong(_told(_counted(one, unspared), f"toxic >= {LEAST_DOCS}"), LEAST_WEIGHT)
        made.clear()
        kept: dict[str, float] = {}
        for k in sorted(weights, key=lambda k: (len(k), -weights[k], k))[:MOST_ENTRIES]:
            if not any(weights[k] < 1.2 * kept[k[:m]] for m in range(2, len(k)) if k[:m] in kept):
                kept[k] = weights[k]
        lexicon = Lexicon(kept, exceptions)
        schema = pa.schema([("x", pa.float64()), ("y", pa.int32())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = lexicon.matcher()
            for batch in batches:
                yield batch_of(schema, [strength(fold(t), m) for t in batch.column("text").to_pylist()],
                               batch.column("toxic"))

        pairs = np.array(one.mapInArrow(run, "x double, y int").collect(), float)  # sample_docs rows
        lexicon.slope, lexicon.offset = _logistic(pairs[:, 0], pairs[:, 1])
        return lexicon
    finally:
        one.unpersist()


def _rescuing(one: DataFrame, keys: dict[str, tuple[int, int]], clean: int, toxic: int) -> DataFrame:
    """(stem, phrase, clean, toxic): phrases without which a key has the log odds of an entry.

    Of a key the ``PHRASES_OFF`` phrases with most clean documents are taken off.  ``enough`` is
    the number of clean documents at which its odds would still do, so a key is looked at only
    if that many times its largest phrase makes up for the rest.  All is judged in Spark; what
    reaches the driver are the phrases of the few keys that pass.
    """
    ratio = (clean + 1) / (toxic + 1) / math.exp(LEAST_WEIGHT)
    counts = one.sparkSession.createDataFrame(
        [(k, c, t, max(0.0, (t + 0.5) * ratio - 0.5)) for k, (c, t) in keys.items()] or [("", 0, 0, 0.0)],
        "stem string, all_clean long, all_toxic long, enough double")
    phrases = checkpointed(_clean_phrases(one, set(keys)))
    able = (phrases.groupBy("stem").agg(F.max("clean").alias("largest")).join(counts, "stem")
            .filter(F.col("largest") * PHRASES_OFF >= F.col("all_clean") - F.col("enough")).drop("largest"))
    order = Window.partitionBy("stem").orderBy(F.col("clean").desc(), "phrase")
    most = (phrases.join(able, "stem").withColumn("nth", F.row_number().over(order))
            .filter(F.col("nth") <= PHRASES_OFF))
    whole = Window.partitionBy("stem")
    left = lambda have, off: F.greatest(F.col(have) - F.sum(off).over(whole), F.lit(0))
    return (most.withColumns({"c": left("all_clean", "clean"), "t": left("all_toxic", "toxic")})
            .filter(F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1)) >= LEAST_WEIGHT)
            .select("stem", "phrase", "clean", "toxic"))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> tuple[float, float]:
    """Slope and offset of a logistic regression, by Newton steps."""
    a = np.stack([x, np.ones_like(x)], axis=1)
    b = np.array([1.0, math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        step = np.linalg.solve((a.T * (p * (1 - p))) @ a + ridge * np.eye(2), a.T @ (y - p) - ridge * b)
        b += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return float(max(0.0, b[0])), float(b[1])


def score_texts(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``docs`` (doc_id, text) with the column score."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = shared.value
        matcher = lexicon.matcher()
        for batch in batches:
            score = [lexicon.score(strength(fold(t or ""), matcher)) for t in batch.column("text").to_pylist()]
            yield batch_of(schema, batch.column("doc_id"), score)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double")


def learn_from(docs: DataFrame, labels: DataFrame, folds: int = 5) -> Lexicon:
    """A lexicon from the labelled rows of ``docs`` that are not held out."""
    known = (labels.filter("toxic in (0, 1) and doc_id is not null")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic")))
    known = known.filter(crc_mod(F.col("doc_id"), folds) != 0)
    texts = docs.filter("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # The ids meet their labels first; those of the sample are few, so its texts are not shuffled.
    labelled = stored(texts.select("doc_id").join(known, "doc_id"))
    n = labelled.count()
    if not n:
        return Lexicon()
    return _learned(texts.join(F.broadcast(_sampled(labelled, n, SAMPLE_DOCS).distinct()), "doc_id"))


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    ``docs`` needs doc_id and text, ``labels`` doc_id and toxic; other columns are ignored.
    Labels are learned from rows whose crc32 of the id is not 0 modulo ``folds``; of a
    repeated label the higher counts, null labels and ids are left out.  Null and empty
    texts get the score of a text without any entry.  Without labels of both kinds the
    lexicon is empty and every score is low.
    """
    lexicon = learn_from(docs, labels, folds)
    return score_texts(docs, lexicon).select(
        "doc_id", (crc_mod(F.col("doc_id"), folds) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """The rows of ``docs``, all columns, that score_toxicity does not predict toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(learn_from(docs, labels, folds))
    made: list = []

    def keep(batch: pa.RecordBatch) -> list[bool]:
        lexicon = shared.value
        if not made:
            made.append(lexicon.matcher())
        return [lexicon.score(strength(fold(t or ""), made[0])) < 0.5 for t in batch.column("text").to_pylist()]

    return kept_rows(docs, keep)
