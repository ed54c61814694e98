"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

The CGK walk reads a window of words from its first on.  At step t it puts out the current
word and moves on if a random bit, a function of step and word, is 1.  Windows at a small
edit distance get walks that soon run together again, so their outputs differ in few
places.  An LSH key is the output at ``SAMPLES`` random steps; ``repetitions`` independent
walks give as many chances.  A walk does not know how long its window is, so one per
start serves items of all sizes.  Items are entered at several of their words, which
stands for the item-sized window that begins as many words earlier.

A key is compared sample by sample: a window leaves as soon as a sampled word is none that
any item has there.  What is left is looked up whole.  A key that many items share, such as
that of a common prompt, stands for one set of items: a text meets each set once, however
often it holds the key, and only items of which the text has enough words are followed to
their places and verified by the exact edit distance over words.

Items too short for a walk are entered whole, under one key of all their words, and match
only word for word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, constants, kept_rows, mix64, pieces, rolled, word_hashes

#: Steps of a walk; one sample is taken from each quarter.
STEPS, SAMPLES = 16, 4
#: Walks.  A stretch of an item without edits is found by any of them; eight find 95 in 100
#: items with the most edits allowed (tests/llm/test_search.py measures it).
REPETITIONS = 8
#: Words between the starts at which an item is entered.
STRIDE = 2
#: Items with fewer words have one key of all their words and are found without edits only.
LEAST_WORDS = 8
#: One edit is allowed for so many words of an item.
WORDS_PER_EDIT = 6
#: Bytes of item texts that are sent to the tasks at once; more items take more passes.
BLOCK_BYTES = 8 << 20
#: Places of an item in a text that are listed at once.
PLACES = 1 << 20


def normalised(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass")


def edits_allowed(words: int) -> int:
    return words // WORDS_PER_EDIT


def sampled_steps(repetition: int) -> list[int]:
    """One step of each quarter of the walk."""
    quarter = STEPS // SAMPLES
    draw = constants(100 + repetition, SAMPLES) >> np.uint64(8)
    return [quarter * j + int(x % np.uint64(quarter)) for j, x in enumerate(draw)]


def _coins(h: np.ndarray, repetition: int) -> np.ndarray:
    """Bit t decides whether the walk moves on at step t."""
    return mix64(h ^ constants(200 + repetition, 1)[0])


@dataclass
class Short:
    """Items of one size below ``LEAST_WORDS``, in the order of their keys."""

    ids: list[int]
    words: np.ndarray
    keys: np.ndarray

    @classmethod
    def build(cls, items: list[tuple[int, np.ndarray]]) -> Short:
        words = np.stack([h for _, h in items])
        keys = cls.key(words.ravel(), words.shape[1])[::words.shape[1]]
        order = np.argsort(keys, kind="stable")
        return cls([items[k][0] for k in order.tolist()], words[order], keys[order])

    @staticmethod
    def key(h: np.ndarray, size: int) -> np.ndarray:
        return rolled(h, size, 8)


@dataclass
class Index:
    """LSH tables of a block of items, and the items that are too short for them.

    Keys of all walks are numbered through, walk after walk, ascending.  ``sets`` gives the
    set of items of each key, as equal sets have one number; ``entry_key`` and
    ``entry_start`` list the keys of each item.
    """

    ids: list[int]
    words: np.ndarray
    numbered: np.ndarray
    first: np.ndarray
    vocabulary: np.ndarray
    maybe: np.ndarray
    levels: list[list[np.ndarray]]
    keys: list[np.ndarray]
    sets: np.ndarray
    set_first: np.ndarray
    set_items: np.ndarray
    entry_first: np.ndarray
    entry_key: np.ndarray
    entry_start: np.ndarray
    short: list[Short]

    @classmethod
    def build(cls, items: list[tuple[int, str]], repetitions: int) -> Index:
        every = [(i, h) for i, t in items if t for h in [word_hashes([normalised(t)])[0]]]
        kept = [(i, h) for i, h in every if len(h) >= LEAST_WORDS]
        short = [Short.build(same) for n in range(1, LEAST_WORDS) if (same := [x for x in every if len(x[1]) == n])]
        size = np.array([len(h) for _, h in kept], np.int64)
        first = np.concatenate([[0], np.cumsum(size)])
        words = np.concatenate([*(h for _, h in kept), np.zeros(STEPS, np.uint64)])
        vocabulary = np.unique(words[:first[-1]])
        maybe = np.zeros(1 << 20, bool)
        maybe[(vocabulary & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        number = np.append(np.searchsorted(vocabulary, words[:first[-1]]) + 1, np.zeros(STEPS, np.int64))
        # Walks of all entries at once; one that leaves its item before the last sample is no key.
        entered = (size + STRIDE - 1) // STRIDE
        item = np.repeat(np.arange(len(kept)), entered)
        start = STRIDE * _ranges(np.zeros(len(kept), np.int64), entered)
        levels, keys, entries, n_keys = [], [], [], 0
        for r in range(repetitions):
            coins, steps = _coins(words, r), sampled_steps(r)
            at, path = first[item] + start, []
            for t in range(steps[-1] + 1):
                if t in steps:
                    path.append(at)
                at = at + ((coins[at] >> np.uint64(t)) & np.uint64(1)).astype(np.int64)
            whole = path[-1] < first[item + 1]
            sampled = [number[p[whole]] for p in path]
            tables = [np.zeros(len(vocabulary) + 1, bool) for _ in path]
            for table, n in zip(tables, sampled, strict=True):
                table[n] = True
            distinct, which = np.unique(cls.key(np.stack(sampled, axis=1).astype(np.uint64)), return_inverse=True)
            levels.append(tables)
            keys.append(distinct)
            entries.append(np.column_stack([item[whole], which + n_keys, start[whole]]))
            n_keys += len(distinct)
        entry = np.concatenate([*entries, np.zeros((0, 3), np.int64)])
        entry = entry[np.argsort(entry[:, 0], kind="stable")]
        sets, set_first, set_items = _sets(entry[:, 1], entry[:, 0], n_keys)
        return cls([i for i, _ in kept], words[:first[-1]], number[:first[-1]].astype(np.int32), first, vocabulary,
                   maybe, levels, keys, sets, set_first, set_items.astype(np.int32),
                   np.searchsorted(entry[:, 0], np.arange(len(kept) + 1)),
                   entry[:, 1].astype(np.int32), entry[:, 2].astype(np.int32), short)

    def item(self, k: int) -> np.ndarray:
        return self.words[self.first[k]:self.first[k + 1]]

    @staticmethod
    def key(path: np.ndarray) -> np.ndarray:
        return mix64((path * constants(7, SAMPLES)).sum(axis=1, dtype=np.uint64))

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Each word's number in the vocabulary of the items, 0 if it has none."""
        out = np.zeros(len(h), np.int32)
        if len(self.vocabulary):
            some = np.flatnonzero(self.maybe[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.vocabulary, h[some]), len(self.vocabulary) - 1)
            hit = self.vocabulary[at] == h[some]
            out[some[hit]] = at[hit] + 1
        return out

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words' numbers; place and key of the windows of ``h`` that share a key with an item."""
        number = np.concatenate([self.numbers(h), np.zeros(STEPS, np.int32)])
        padded = np.concatenate([h, np.zeros(STEPS, np.uint64)])
        places, found, before = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], 0
        for r, (tables, keys) in enumerate(zip(self.levels, self.keys, strict=True)):
            if not len(keys):
                continue
            coins = _coins(padded, r)
            start = np.arange(len(h), dtype=np.int32)
            at, t, path = start.copy(), 0, []
            for step, table in zip(sampled_steps(r), tables, strict=True):
                for t in range(t, step):
                    at += ((coins[at] >> np.uint64(t)) & np.uint64(1)).astype(np.int32)
                t = step
                n = number[at]
                stay = np.flatnonzero(table[n])
                start, at = start[stay], at[stay]
                path = [*(p[stay] for p in path), n[stay]]
            key = self.key(np.stack(path, axis=1).astype(np.uint64))
            which = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            same = np.flatnonzero(keys[which] == key)
            places.append(start[same])
            found.append(which[same] + before)
            before += len(keys)
        return number[:len(h)], np.concatenate(places), np.concatenate(found)

    def candidates(self, h: np.ndarray, hits: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """(place of the item's first word, item) where the text ``h`` shares a key with an item.

        Items of which the text has too few words to hold them are left out.  Rows are
        distinct and sorted by item, then place; a place may lie before the text.
        """
        number, place, key = self.hits(h) if hits is None else hits
        sets = np.unique(self.sets[key])
        items = np.unique(self.set_items[_ranges(self.set_first[sets], self.set_first[sets + 1] - self.set_first[sets])])
        if not len(items):
            return np.zeros((0, 2), np.int64)
        there = np.zeros(len(self.vocabulary) + 1, bool)
        there[number] = True
        there[0] = False
        size = self.first[items + 1] - self.first[items]
        have = np.add.reduceat(there[self.numbered[_ranges(self.first[items], size)]], np.cumsum(size) - size,
                               dtype=np.int64)
        order = np.argsort(key, kind="stable")
        place, key = place[order].astype(np.int64), key[order]
        out = []
        for k in items[have >= size - edits_allowed(size)].tolist():
            own = slice(self.entry_first[k], self.entry_first[k + 1])
            low = np.searchsorted(key, self.entry_key[own])
            many = np.searchsorted(key, self.entry_key[own], "right") - low
            parts = np.flatnonzero(np.diff(np.cumsum(many) // PLACES, prepend=0))
            found = np.zeros(0, np.int64)
            for e in np.split(np.arange(len(many)), parts):
                begin = place[_ranges(low[e], many[e])] - np.repeat(self.entry_start[own][e], many[e])
                found = np.union1d(found, begin)
            out.append(np.column_stack([found, np.full(len(found), k)]))
        return np.concatenate([*out, np.zeros((0, 2), np.int64)])


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of each range, range after range."""
    return np.arange(int(size.sum())) + np.repeat(first - (np.cumsum(size) - size), size)


def _runs(x: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of each run of equal numbers."""
    edge = np.concatenate([[0], np.flatnonzero(np.diff(x)) + 1, [len(x)]]).tolist() if len(x) else []
    return zip(edge[:-1], edge[1:], strict=True)


def _sets(key: np.ndarray, item: np.ndarray, n_keys: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of each key's set of items; where each set begins in the list of their items.

    Sets are told apart by a sum of 64-bit hashes of their items.
    """
    if not n_keys:
        return np.zeros(0, np.int32), np.zeros(1, np.int64), item
    pairs = np.unique(key << 32 | item)
    edge = np.searchsorted(pairs >> 32, np.arange(n_keys + 1))
    item = pairs & 0xFFFFFFFF
    marks = np.add.reduceat(mix64(item.astype(np.uint64) ^ constants(9, 1)[0]), edge[:-1])
    _, one, sets = np.unique(marks, return_index=True, return_inverse=True)
    size = edge[one + 1] - edge[one]
    return sets.astype(np.int32), np.concatenate([[0], np.cumsum(size)]), item[_ranges(edge[one], size)]


def best_match(item: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """Least edit distance of ``item`` to a run of ``text``: distance, begin, end; or None.

    Of equal distances the run that ends first counts.
    """
    m = len(item)
    row = np.arange(m + 1)
    begin = np.zeros(m + 1, np.int64)
    steps = np.arange(m + 1)
    best: tuple[int, int, int] | None = None
    for j, w in enumerate(text.tolist(), 1):
        over = row[:-1] + (item != w)
        gone = row[1:] + 1
        new = np.concatenate([[0], np.minimum(over, gone)])
        new_begin = np.concatenate([[j], np.where(over <= gone, begin[:-1], begin[1:])])
        # Words of the item left out: new[i] = min over k <= i of new[k] + i - k.
        level = new - steps
        lowest = np.minimum.accumulate(level)
        source = np.maximum.accumulate(np.where(np.append(True, level[1:] < lowest[:-1]), steps, 0))
        row = new[source] + steps - source
        begin = new_begin[source]
        if row[m] <= most and (best is None or row[m] < best[0]):
            best = (int(row[m]), int(begin[m]), j)
            if not best[0]:
                break
    return best


def find_leaks(docs: DataFrame, items: DataFrame, repetitions: int = REPETITIONS,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each document and benchmark item it holds: doc_id, item_id, edits, begin, end.

    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns are ignored.
    Words are compared lower-cased.  begin and end count the document's words; edits is the
    least edit distance over words of the item to any place near a window that shares an
    LSH key, at most one for ``WORDS_PER_EDIT`` words of the item.  An item below
    ``LEAST_WORDS`` words matches without edits only, at its first place.  Null or empty
    texts match nothing.  Repeated rows count one by one.
    Items are read in blocks of bounded size; each block is a pass over the documents.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int32()),
                        ("begin", pa.int32()), ("end", pa.int32())])
    found = None
    for shared in _indexes(items, repetitions, block_bytes):
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                leaks = [(ids[d], *x) for d, x in _leaks(shared.value, batch)]
                yield batch_of(schema, *(list(zip(*leaks, strict=True)) if leaks else [[]] * 5))

        leaks = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            run, "doc_id long, item_id long, edits int, begin int, end int")
        found = leaks if found is None else found.unionByName(leaks)
    return found


def drop_leaks(docs: DataFrame, items: DataFrame, repetitions: int = REPETITIONS,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, in which find_leaks finds no item."""
    for shared in _indexes(items, repetitions, block_bytes):
        def keep(batch: pa.RecordBatch, shared=shared) -> list[bool]:
            leaking = {d for d, _ in _leaks(shared.value, batch)}
            return [i not in leaking for i in range(batch.num_rows)]

        docs = kept_rows(docs, keep)
    return docs


def _indexes(items: DataFrame, repetitions: int, block_bytes: int) -> Iterator[Broadcast]:
    """The tables of each block of items, sent to the tasks."""
    send = items.sparkSession.sparkContext.broadcast
    block: list[tuple[int, str]] = []
    size = 0
    rows = items.select(F.col("item_id").cast("long"), "text").filter("text is not null")
    for item, text in rows.toLocalIterator():
        block.append((item, text))
        size += len(text)
        if size >= block_bytes:
            yield send(Index.build(block, repetitions))
            block, size = [], 0
    yield send(Index.build(block, repetitions))


def _leaks(index: Index, batch: pa.RecordBatch) -> Iterator[tuple]:
    """(row, (item_id, edits, begin, end)) of the best match of each row and item."""
    texts = [normalised(t or "") for t in batch.column("text").to_pylist()]
    for a, b in pieces(texts):
        h, starts = word_hashes(texts[a:b])
        for search in (_verified, _word_for_word):
            for d, found in search(index, h, starts):
                yield a + d, found


def _word_for_word(index: Index, h: np.ndarray, starts: np.ndarray) -> Iterator[tuple]:
    """(text, (item_id, 0, begin, end)) of the first copy of each short item in each text."""
    for short in index.short:
        size = short.words.shape[1]
        key = Short.key(h, size)
        at = np.minimum(np.searchsorted(short.keys, key), len(short.keys) - 1)
        place = np.flatnonzero(short.keys[at] == key)
        own = np.searchsorted(starts, place, "right") - 1
        inside = place + size <= starts[own + 1]
        place, own = place[inside], own[inside]
        if not len(place):
            continue
        _, first = np.unique(np.column_stack([own, at[place]]), axis=0, return_index=True)
        for d, p in zip(own[first].tolist(), place[first].tolist(), strict=True):
            begin = p - int(starts[d])
            for k in range(int(at[p]), int(np.searchsorted(short.keys, key[p], "right"))):
                if (short.words[k] == h[p:p + size]).all():
                    yield d, (short.ids[k], 0, begin, begin + size)


def _verified(index: Index, h: np.ndarray, starts: np.ndarray) -> Iterator[tuple]:
    """(text, (item_id, edits, begin, end)) of the best match of each text and item."""
    number, place, key = index.hits(h)
    own = np.searchsorted(starts, place, "right") - 1
    order = np.argsort(own, kind="stable")
    place, key, own = place[order], key[order], own[order]
    for lo, hi in _runs(own):
        first, last = starts[own[lo]], starts[own[lo] + 1]
        text = h[first:last]
        near = index.candidates(text, (number[first:last], place[lo:hi] - first, key[lo:hi]))
        for a, b in _runs(near[:, 1]):
            k = int(near[a, 1])
            found = _best_of(index.item(k), text, near[a:b, 0])
            if found:
                yield int(own[lo]), (index.ids[k], *found)


def _best_of(item: np.ndarray, text: np.ndarray, places: np.ndarray) -> tuple[int, int, int] | None:
    """The first best match of ``item`` near ascending ``places``."""
    most = edits_allowed(len(item))
    best = None
    # Windows that overlap are one stretch of text.
    for near in np.split(places, np.flatnonzero(np.diff(places) > len(item)) + 1):
        begin = max(0, int(near[0]) - most)
        stretch = text[begin:max(0, int(near[-1]) + len(item) + most)]
        if np.isin(item, stretch).sum() < len(item) - most:
            continue
        found = best_match(item, stretch, most)
        if found and (best is None or found[0] < best[0]):
            best = (found[0], found[1] + begin, found[2] + begin)
            if not best[0]:
                break
    return best
