"""Language identification with bit-sliced Bloom filters of letter n-grams.

All languages share one table of bitmasks.  Inserting an n-gram of a language sets the
language's bit in the rows that the n-gram hashes to; looking an n-gram up is the AND of
those rows, which gives all languages that contain it at once.  A text's n-grams are
counted per language (popcounts), the expected number of false positives is taken off,
and the language with most n-grams left wins.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_of, constants, crc_mod, mix64, pieces

#: Labelled documents of a language that the filters are learned from, about.
SAMPLE_DOCS = 4000
#: N-grams of a language that enter its filter at most, the most frequent first.
MOST_GRAMS = 50_000
#: A language contains an n-gram if it is this frequent there, as a share of its
#: frequency in the language where it is most frequent, and was seen MIN_COUNT times.
KEEP, MIN_COUNT = 0.4, 3
ORDERS = (2, 3)
#: Longer texts are taken in ranges of this many characters.
RANGE_CHARS = 1 << 19
HASHES = 3
UNKNOWN = "und"

_LETTER: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER["is"] = np.fromiter(map(str.isalpha, map(chr, range(sys.maxunicode + 1))), bool)
    return _LETTER["is"]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _symbols(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which characters are letters, and all of them with one symbol for the others."""
    letter = _letters()[code]
    return letter, np.where(letter, code, 0).astype(np.uint64)


def _ngrams(letter: np.ndarray, symbol: np.ndarray, n: int, starts: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams at the first ``starts`` places, and which of them count."""
    if n == 2:
        valid = letter[:starts] | letter[1:starts + 1]
    else:
        valid = np.ones(starts, bool)
        for j in range(1, n - 1):
            valid &= letter[j:j + starts]
    h = np.full(starts, n, np.uint64)
    for j, factor in enumerate(constants(11, 4)[:n]):
        h += symbol[j:j + starts] * factor
    return h, valid


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the texts' n-grams, the text of each, and whether a text has a letter.

    N-grams are taken from lower-cased text; what is no letter is one boundary symbol, in
    which an n-gram may begin or end but not continue.
    """
    lowered = [t.lower() for t in texts]
    code = _codes("\n".join([*lowered, ""]))
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lowered])
    letter, symbol = _symbols(code)
    lettered = np.bincount(owner[letter], minlength=len(texts)) > 0
    hashes, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for n in ORDERS:
        m = len(code) - n + 1
        if m > 0:
            h, valid = _ngrams(letter, symbol, n, m)
            valid &= owner[:m] == owner[n - 1:]
            hashes.append(mix64(h[valid]))
            owners.append(owner[:m][valid])
    return np.concatenate(hashes), np.concatenate(owners), lettered


def long_grams(text: str, size: int = RANGE_CHARS) -> Iterator[tuple[np.ndarray, bool]]:
    """The n-grams of one text, as :func:`grams` has them, and whether letters were seen, by ranges.

    A range has the n-grams that begin in it, so neighbours overlap by one character less than
    the longest n-gram; a task holds a range's arrays, whatever the length of the text.
    """
    full = text.lower() + "\n"
    for at in range(0, len(full), size):
        letter, symbol = _symbols(_codes(full[at:at + size + max(ORDERS) - 1]))
        found = []
        for n in ORDERS:
            m = min(size, len(full) - at - n + 1)
            if m > 0:
                h, valid = _ngrams(letter, symbol, n, m)
                found.append(mix64(h[valid]))
        yield (np.concatenate(found) if found else np.zeros(0, np.uint64),
               bool(letter[:size].any()))


@dataclass
class Filter:
    """Bitmasks of languages, 64 a word: row r of word w is ``masks[w][r]``."""

    languages: list[str]
    masks: np.ndarray

    @classmethod
    def build(cls, members: dict[str, np.ndarray], languages: list[str]) -> Filter:
        most = sum(map(len, members.values()))
        rows = 1 << max(12, int(np.ceil(np.log2(max(1, 12 * most)))))
        masks = np.zeros((max(1, -(-len(languages) // 64)), rows), np.uint64)
        for i, lang in enumerate(languages):
            for at in cls._rows(members.get(lang, np.zeros(0, np.uint64)), rows):
                masks[i // 64][at] |= np.uint64(1 << i % 64)
        return cls(languages, masks)

    @staticmethod
    def _rows(h: np.ndarray, rows: int) -> list[np.ndarray]:
        step = mix64(h.copy()) | np.uint64(1)
        return [((h + step * np.uint64(k)) & np.uint64(rows - 1)).astype(np.int64) for k in range(HASHES)]

    def false_rates(self) -> np.ndarray:
        rows = self.masks.shape[1]
        return np.array([
            (np.count_nonzero(self.masks[i // 64] & np.uint64(1 << i % 64)) / rows) ** HASHES
            for i in range(len(self.languages))])

    def counts(self, h: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """Per text and language, n-grams found in the language's filter."""
        out = np.zeros((n, len(self.languages)))
        at = self._rows(h, self.masks.shape[1])
        for w, masks in enumerate(self.masks):
            found = masks[at[0]]
            for a in at[1:]:
                found &= masks[a]
            for i in range(64 * w, min(len(self.languages), 64 * w + 64)):
                bit = (found >> np.uint64(i % 64)) & np.uint64(1)
                out[:, i] = np.bincount(owner, weights=bit, minlength=n)
        return out


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Filter:
    """The filter of the languages in ``docs`` (doc_id, text, lang), from a bounded sample."""
    labelled = docs.select("doc_id", "text", "lang").filter("text is not null and lang is not null")
    sizes = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return Filter.build({}, [])
    spark = docs.sparkSession
    shares = spark.createDataFrame([(k, sample_docs / n) for k, n in sizes.items()],
                                   "lang string, share double")
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) / float(1 << 20)
    sample = labelled.join(shares, "lang").filter(place < F.col("share")).select("text", "lang")
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = (batch.column(c).to_pylist() for c in ("text", "lang"))
            names = sorted(set(langs))
            which = np.array([names.index(x) for x in langs])
            for a, b in pieces(texts):
                if len(texts[a]) > RANGE_CHARS:
                    for h, _ in long_grams(texts[a]):
                        g, n = np.unique(h, return_counts=True)
                        yield batch_of(schema, [langs[a]] * len(g), g.view(np.int64), n)
                    a += 1
                if a == b:
                    continue
                h, owner, _ = grams(texts[a:b])
                lang = which[a:b][owner] if len(owner) else owner
                for i in range(len(names)):
                    g, n = np.unique(h[lang == i], return_counts=True)
                    yield batch_of(schema, [names[i]] * len(g), g.view(np.int64), n)

    counted = (sample.mapInArrow(run, "lang string, gram long, n long")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    total = Window.partitionBy("lang")
    frequent = (counted.withColumn("rate", F.col("n") / F.sum("n").over(total))
                .withColumn("best", F.max("rate").over(Window.partitionBy("gram")))
                .filter((F.col("n") >= MIN_COUNT) & (F.col("rate") >= KEEP * F.col("best")))
                .withColumn("nth", F.row_number().over(total.orderBy(F.desc("n"), "gram")))
                .filter(F.col("nth") <= MOST_GRAMS).select("lang", "gram"))
    kept: dict[str, list[int]] = {}
    for lang, gram in frequent.collect():  # MOST_GRAMS a language
        kept.setdefault(lang, []).append(gram)
    members = {k: np.array(v, np.int64).view(np.uint64) for k, v in kept.items()}
    return Filter.build(members, sorted(sizes))


def predict(docs: DataFrame, model: Filter) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast((model, model.false_rates()))
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, false = shared.value
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            best, score = np.full(len(texts), len(names) - 1), np.zeros(len(texts))
            for a, b in pieces(texts):
                if not model.languages:
                    continue
                if b - a == 1 and len(texts[a]) > RANGE_CHARS:
                    seen, counts, lettered = np.zeros((1, 1)), np.zeros((1, len(false))), np.zeros(1, bool)
                    for h, some in long_grams(texts[a]):
                        seen += len(h)
                        counts += model.counts(h, np.zeros(len(h), np.int64), 1)
                        lettered |= some
                else:
                    h, owner, lettered = grams(texts[a:b])
                    seen, counts = np.bincount(owner, minlength=b - a)[:, None], model.counts(h, owner, b - a)
                left = np.maximum(0, (counts - seen * false) / (1 - false))
                all_left = left.sum(axis=1)
                best[a:b] = np.where(lettered, left.argmax(axis=1), len(names) - 1)
                score[a:b] = np.where(lettered & (all_left > 0), left.max(axis=1)
                                      / np.maximum(all_left, 1e-300), 0.0)
            yield batch_of(schema, batch.column("doc_id"), pa.array(names[best], pa.string()), score)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double")


def identify_languages(docs: DataFrame, folds: int = 5) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Learns from rows with text and lang whose crc32 of the id is not 0 modulo ``folds``.
    A null text, or one without a letter, is ``und`` with score 0; a text with letters of
    which no n-gram is known gets the first language, with score 0.  If nothing is
    labelled, everything is ``und``.  Ties go to the language first in order.  A null id
    hashes like the empty text.  Other columns are ignored; an empty table gives an empty
    result.
    """
    model = learn(docs.filter(crc_mod(F.col("doc_id"), folds) != 0))
    return predict(docs, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), folds) == 0).alias("held_out"), "lang_pred", "score")
