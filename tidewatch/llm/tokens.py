"""Token counts of a public tokenizer, also of documents too long to encode at once.

A long text is encoded as overlapping chunks with offsets.  In the overlap the two encodings
are aligned: a boundary is stable if a piece of the tokenizer's own pre-tokenizer begins there
in both (merges never cross pieces) and both have the same tokens from it to the last piece
that is whole.  The chunks are spliced there; if there is none, the overlap is widened, and a
chunk without any boundary is doubled, so that time stays in proportion.

Where counts add up over white-space separated pieces, which is tried out on the tokenizer at
hand, other texts are encoded as their distinct pieces: a task meets most of them many times.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of

#: Texts above this many characters are spliced from chunks of as many.
CHUNK_CHARS = 32_768
#: Characters that neighbouring chunks share at first.
OVERLAP_CHARS = 256
#: Pieces whose counts a task keeps.
MEMO = 400_000

#: Texts on which a tokenizer shows whether white space always separates.
_PROBES = ("a b", " a  b ", "one two\tthree\nfour", "it's 12 345, ok?", "Ünï çode  x", "a\u00a0b c", "<s> </s> x")


class Counter:
    """Token counts of the tokenizer in a file, special strings handled as its default."""

    def __init__(self, path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.chunk, self.overlap = chunk, overlap
        self.memo: dict[str, int] = {}
        self.by_pieces = all(
            self._count(t) == sum(self._count(w.decode()) for w in t.encode().split()) for t in _PROBES)

    def _count(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def count_batch(self, texts: list[str]) -> list[int]:
        """Counts of several texts; only pieces not met before are encoded."""
        if len(self.memo) > MEMO:
            self.memo.clear()
        if not self.by_pieces:
            return [self._count(t) if len(t) <= self.chunk else self.count_long(t) for t in texts]
        split = {i: t.encode("utf-8", "surrogatepass").split() for i, t in enumerate(texts) if len(t) <= self.chunk}
        new = [w.decode("utf-8", "surrogatepass") for w in set().union(*split.values()).difference(self.memo)]
        for i in range(0, len(new), 4096):
            some = new[i:i + 4096]
            for w, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                self.memo[w.encode("utf-8", "surrogatepass")] = len(e.ids)
        memo = self.memo
        return [sum(map(memo.__getitem__, split[i])) if i in split else self.count_long(t)
                for i, t in enumerate(texts)]

    def _encode(self, text: str, begin: int, end: int) -> list[tuple[int, int, int, bool]]:
        """(token, begin, end, whether a piece of the pre-tokenizer begins) of a chunk."""
        e = self.tokenizer.encode(text[begin:end], add_special_tokens=False)
        words = e.word_ids
        return [(t, a + begin, b + begin, w is not None and (not i or words[i - 1] != w))
                for i, (t, (a, b), w) in enumerate(zip(e.ids, e.offsets, words, strict=True))]

    def count_long(self, text: str) -> int:
        """The count of one text, spliced from overlapping chunks."""
        total, begin = 0, 0
        end = min(len(text), self.chunk)
        tokens = self._encode(text, begin, end)
        while end < len(text):
            overlap = self.overlap
            while True:
                start = max(begin, end - overlap)
                if start == begin:  # no stable boundary at all: the chunk is doubled
                    to, at = min(len(text), begin + 2 * (end - begin)), begin
                    tokens = self._encode(text, begin, to)
                    break
                to = min(len(text), start + self.chunk + overlap)
                following = self._encode(text, start, to)
                at = stable_boundary(tokens, following, start, end)
                if at is not None:
                    total += sum(a < at for _, a, _, _ in tokens)
                    tokens = [t for t in following if t[1] >= at]
                    break
                overlap *= 4
            begin, end = at, to
        return total + len(tokens)


def stable_boundary(left: list, right: list, start: int, end: int) -> int | None:
    """Where two encodings that share the text from start to end can be spliced, or None.

    The boundary is the beginning of a piece in both, not the first of ``right``, which the cut
    may have made.  From it on both have the same tokens up to the beginning of the last piece
    of ``left``, whose end the other cut may have made, and there is at least one whole piece.
    """
    mine = [t for t in left if t[1] >= start]
    begins = [t[1] for t in mine if t[3]]
    if len(begins) < 2:
        return None
    last = begins[-1]
    theirs = [t[1] for t in right if t[3] and start < t[1] < last]
    for at in sorted(set(begins).intersection(theirs)):
        a = [t for t in mine if at <= t[1] < last]
        b = [t for t in right if at <= t[1] < last]
        if a and a == b:
            return at
    return None


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, chunk: int = CHUNK_CHARS,
                 overlap: int = OVERLAP_CHARS) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (more than ``limit``).

    ``docs`` needs doc_id and text; other columns are ignored.  ``path`` names a tokenizer
    file that every executor has.  A null text counts as empty: no bytes, no tokens.  Rows
    come out as often as they came in, in the partitions they came in.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or Counter(path, chunk, overlap)
            texts = [t or "" for t in batch.column("text").to_pylist()]
            counts: list[int] = []
            for i in range(0, len(texts), 512):
                counts += counter.count_batch(texts[i:i + 512])
            yield batch_of(schema, batch.column("doc_id"), batch.column("n_bytes"), counts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
