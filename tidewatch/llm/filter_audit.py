"""Audit of interacting filters over a sparse document-term matrix.

The words of the texts are encoded by one global dictionary, and the matrix is stored as CSR
shards: for the documents of a shard ``indptr``, ``indices`` (ids of words) and ``counts``.  A
document's row sum is its number of words, its nonzero entries are its distinct words, which
decide filters A and B; the other flags travel with the rows.  What remains is a histogram of
flag combinations per part, from which every order of the filters is read.

Filters, by the condition on which a text fails: A under ``LEAST_WORDS`` words; B less than
``DISTINCT_SHARE`` % of its words distinct; C more than ``UPPER_SHARE`` % capital letters A-Z;
D holds one of ``MARKS``; E a row of smaller doc_id has the same text.

A task holds ``SHARD_BYTES`` of text or one text.  Each shard sends its distinct words once, by
hash buckets, to the tasks that number them, so that frequent words weigh no more than others;
a task keeps the words of one bucket, of which there are as many as shuffle partitions.  Copies
meet as counts, after they are summed where they are.
"""

from __future__ import annotations

import itertools
from array import array
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_of, spread, stored, texts_of

FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT_SHARE, UPPER_SHARE = 100, 80, 10
MARKS = b"#$%&*|"
#: Texts of a shard; a longer text is a shard of its own.
SHARD_BYTES = 3 << 20
#: Long texts are cut into words in pieces of this size.
PIECE_BYTES = 1 << 20

_SPACE = b" \t\n\x0b\x0c\r"
_NOT_UPPER = bytes(sorted(set(range(256)) - set(range(65, 91))))
_FOLLOWING = bytes(range(0x80, 0xC0))
_NOT_MARKS = bytes(sorted(set(range(256)) - set(MARKS)))

_ROWS = "doc_ids array<long>, parts array<string>, digests array<binary>, flags array<int>, indptr array<int>"
_ROWS_ARROW = [
    ("doc_ids", pa.list_(pa.int64())), ("parts", pa.list_(pa.string())),
    ("digests", pa.list_(pa.binary())), ("flags", pa.list_(pa.int32())), ("indptr", pa.list_(pa.int32()))]
_LOCAL = f"shard long, bucket int, words binary, {_ROWS}, indices binary, counts binary"
_LOCAL_ARROW = pa.schema([("shard", pa.int64()), ("bucket", pa.int32()), ("words", pa.binary()), *_ROWS_ARROW,
                          ("indices", pa.binary()), ("counts", pa.binary())])
_CODED = "shard long, bucket int, words binary, ids binary"
_CODED_ARROW = pa.schema([("shard", pa.int64()), ("bucket", pa.int32()), ("words", pa.binary()), ("ids", pa.binary())])
_SHARD = f"shard long, {_ROWS}, indices array<long>, counts array<int>"
_SHARD_ARROW = pa.schema([("shard", pa.int64()), *_ROWS_ARROW, ("indices", pa.list_(pa.int64())),
                          ("counts", pa.list_(pa.int32()))])
_FLAGGED = "doc_id long, part string, digest binary, n_words long, n_distinct long, fails int"
_FLAGGED_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("part", pa.string()), ("digest", pa.binary()),
    ("n_words", pa.int64()), ("n_distinct", pa.int64()), ("fails", pa.int32())])


class _Codes(dict):
    """Numbers words from 0 as they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def word_counts(text: bytes, piece: int = PIECE_BYTES) -> Counter:
    """How often each word stands in the text, which is cut in pieces in front of white space."""
    if len(text) <= piece:
        return Counter(text.split())
    counts: Counter = Counter()
    at = 0
    while at < len(text):
        to = min(len(text), at + piece)
        while to < len(text) and text[to] not in _SPACE:
            to += 1
        counts.update(text[at:to].split())
        at = to
    return counts


def text_flags(text: bytes) -> int:
    """Filters C (4) and D (8) as bits."""
    upper = len(text.translate(None, _NOT_UPPER))
    points = len(text.translate(None, _FOLLOWING))
    return 4 * (100 * upper > UPPER_SHARE * points) + 8 * bool(text.translate(None, _NOT_MARKS))


def _packed(values: np.ndarray) -> bytes:
    """The values, none negative, in the fewest bytes that hold them all, byte by byte, compressed."""
    values = values.astype(np.min_scalar_type(int(values.max(initial=0))))
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return bytes([values.itemsize]) + zstandard.compress(np.ascontiguousarray(planes).tobytes(), 3)


def _unpacked(data: bytes) -> np.ndarray:
    size = data[0]
    planes = np.frombuffer(zstandard.decompress(data[1:]), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, len(planes) // size).T).view(f"u{size}").ravel()


def _local_shards(buckets: int):
    """Shards whose indices are places in their own words, which are listed by bucket.

    A shard gives one row for its matrix (bucket -1) and one for the words of each bucket,
    separated by the white space that no word has.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, numbers = TaskContext.get().partitionId() << 32, itertools.count()
        rows, codes, indptr, size = [], _Codes(), [0], 0
        indices, counts = array("i"), array("i")

        def shard() -> pa.RecordBatch:
            number, words = base + next(numbers), list(codes)
            bucket = np.fromiter(map(crc32, words), np.uint32, len(words)) % buckets
            order = np.argsort(bucket, kind="stable")
            place = np.empty(len(words), np.int32)
            place[order] = np.arange(len(words), dtype=np.int32)
            used, first = np.unique(bucket[order], return_index=True)
            lists = [b"\n".join([words[i] for i in part]) for part in np.split(order, first[1:])] if words else []
            n = len(lists)
            own = [[x, *[None] * n] for x in (*map(list, zip(*rows, strict=True)), indptr)]
            return batch_of(
                _LOCAL_ARROW, [number] * (n + 1), [-1, *used.tolist()], [None, *lists], *own,
                [_packed(place[np.frombuffer(indices, np.int32)]), *[None] * n],
                [_packed(np.frombuffer(counts, np.int32)), *[None] * n])

        for batch in batches:
            for doc_id, part, text in zip(batch.column("doc_id").to_pylist(), batch.column("part").to_pylist(),
                                          texts_of(batch), strict=True):
                if rows and size + len(text) > SHARD_BYTES:
                    yield shard()
                    rows, codes, indptr, size = [], _Codes(), [0], 0
                    indices, counts = array("i"), array("i")
                found = word_counts(text)
                indices.extend(map(codes.__getitem__, found))
                counts.extend(found.values())
                indptr.append(len(indices))
                rows.append((doc_id, part, sha256(text).digest(), text_flags(text)))
                size += len(text) + 64
        if rows:
            yield shard()

    return run


def _coded():
    """The places of the words of each shard in the bucket's dictionary, and the dictionary.

    A word's place counts the words of its bucket, in order of shards; its global id is the place
    times the number of buckets, plus the bucket.  A row without a shard lists a bucket's words.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(
            *(batch.column(c).to_pylist() for c in ("bucket", "shard", "words")), strict=True))
        for bucket, run in itertools.groupby(rows, lambda r: r[0]):
            codes = _Codes()
            for _, shard, words in run:
                found = words.split(b"\n")
                places = np.fromiter(map(codes.__getitem__, found), np.int64, len(found))
                yield batch_of(_CODED_ARROW, [shard], [bucket], [None], [_packed(places)])
            yield batch_of(_CODED_ARROW, [None], [bucket], [b"\n".join(codes)], [_packed(np.arange(len(codes)))])

    return run


def _global_shards(buckets: int):
    """The matrix row of each shard with global ids, from it and its lists of places in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        for shard, (matrix, *lists) in itertools.groupby(rows, lambda r: r["shard"]):
            ids = np.concatenate([np.zeros(0, np.int64), *(
                _unpacked(x["ids"]).astype(np.int64) * buckets + x["bucket"] for x in lists)])
            yield batch_of(
                _SHARD_ARROW, [shard], *([matrix[name]] for name, _ in _ROWS_ARROW),
                _one_list(ids[_unpacked(matrix["indices"])]),
                _one_list(_unpacked(matrix["counts"]).astype(np.int32)))

    return run


def _one_list(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))


def _coded_shards(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """The shards' matrices and lists of places, those of a shard together; the dictionary by
    buckets; the number of buckets."""
    n = spread(docs.sparkSession)
    local = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("lang", F.lit("")).alias("part"), "text").mapInArrow(_local_shards(n), _LOCAL))
    words = (local.filter("bucket >= 0").select("shard", "bucket", "words")
             .repartition(n, F.xxhash64("bucket")).sortWithinPartitions("bucket", "shard"))
    coded = stored(words.mapInArrow(_coded(), _CODED))
    parts = (local.filter("bucket = -1").drop("words").unionByName(
        coded.filter("shard is not null").select("shard", "bucket", "ids"), allowMissingColumns=True))
    return (parts.repartition(n, F.xxhash64("shard")).sortWithinPartitions("shard", "bucket"),
            coded.filter("shard is null").select("bucket", "words", "ids"), n)


def document_term_matrix(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The CSR shards (one row each, indices are global ids) and the dictionary (word, id).

    ``docs`` needs doc_id, lang and text; other columns are ignored.  Besides indptr, indices
    and counts a shard has doc_ids, parts, digests (of texts) and flags (filters C and D) of its
    rows.  A null text is an empty row.  An empty table has no shards.
    """
    parts, dictionary, buckets = _coded_shards(docs)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, words, places in zip(*(batch.column(c).to_pylist() for c in ("bucket", "words", "ids")),
                                             strict=True):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w.decode() for w in words.split(b"\n")], pa.string()),
                     pa.array(_unpacked(places).astype(np.int64) * buckets + bucket)], ["word", "id"])

    return (parts.mapInArrow(_global_shards(buckets), _SHARD),
            dictionary.mapInArrow(listed, "word string, id long"))


def _flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Row sums and nonzero entries of the matrix, and the flags they decide.

    A row and an id are sorted as one number, which holds 2**44 words and 2**19 rows a shard.
    """
    for batch in batches:
        for i in range(batch.num_rows):
            ids, parts, digests, flags, indptr, indices, counts = (
                batch.column(c)[i].values for c in (*(name for name, _ in _ROWS_ARROW), "indices", "counts"))
            at = indptr.to_numpy().astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(counts.to_numpy(), dtype=np.int64)])
            words = sums[at[1:]] - sums[at[:-1]]
            row = np.repeat(np.arange(len(words)), np.diff(at))
            entries = np.sort(row << 44 | indices.to_numpy())
            distinct = np.bincount(entries[np.diff(entries, prepend=-1) != 0] >> 44, minlength=len(words))
            fails = (flags.to_numpy() + (words < LEAST_WORDS)
                     + 2 * (100 * distinct < DISTINCT_SHARE * words))
            yield batch_of(_FLAGGED_ARROW, ids, parts, digests, words, distinct, fails.astype(np.int32))


def filter_flags(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest, n_words, n_distinct and fails (bits of A, B, C, D) of each row."""
    parts, _, buckets = _coded_shards(docs)
    return parts.mapInArrow(lambda batches: _flagged(_global_shards(buckets)(batches)), _FLAGGED)


def flag_histogram(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows, good and toxic ones per part and combination of failed filters (bits of A to E)."""
    n = spread(docs.sparkSession)
    known = labels.dropna(subset=["doc_id"]).groupBy(
        F.col("doc_id").cast("long").alias("known_id"), F.lit(0).cast("long").alias("known_salt")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    rows = filter_flags(docs).groupBy("doc_id", "part", "digest", "fails").agg(
        F.count("*").alias("n"))
    salt = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(n)) + 1).otherwise(
        F.lit(0)).cast("long")  # rows without an id are spread; none has labels
    marked = (rows.withColumn("salt", salt).withColumn("id", F.coalesce("doc_id", F.lit(0)))
              .join(known, (F.col("id") == F.col("known_id")) & (F.col("salt") == F.col("known_salt")), "left")
              .select("doc_id", "part", "digest", "fails", "n",
                      F.coalesce("good", F.lit(0)).alias("good"),
                      F.coalesce("toxic", F.lit(0)).alias("toxic")))
    has_id = F.col("doc_id").isNotNull()
    cells = marked.groupBy("digest", "part", "fails", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(has_id, F.col("n")).otherwise(0)).alias("n_ids"),
        F.min(F.when(has_id, F.struct("doc_id", "n"))).alias("first"))
    smallest = F.min("first.doc_id").over(Window.partitionBy("digest"))
    later = F.col("n_ids") - F.when(
        F.col("first.doc_id") == F.col("smallest"), F.col("first.n")).otherwise(0)
    split = cells.withColumn("smallest", smallest).withColumn("later", later).select(
        "part", "good", "toxic", F.inline(F.array(
            F.struct((F.col("fails") + 16).alias("fails"), F.col("later").alias("n")),
            F.struct(F.col("fails").alias("fails"), (F.col("n") - F.col("later")).alias("n")))))
    return split.groupBy("part", "fails").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("n_good"),
        F.sum(F.col("n") * F.col("toxic")).alias("n_toxic"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step; long counts within the part.

    ``docs`` needs doc_id, lang and text, ``labels`` doc_id, quality and toxic; other columns are
    ignored.  Columns: part (lang, null: empty), filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley.

    A null text is empty.  Rows of equal doc_id count each; a row fails E only if a smaller id
    has its text, so repeated rows of the smallest id pass, and a null id neither fails E nor
    makes others fail.  A document has a label if any of its label rows says 1; a null id has
    none.  Without documents there are no parts and no rows.
    """
    spark = docs.sparkSession
    hist = flag_histogram(docs, labels)
    states = [(1 << f, before) for f in range(5) for before in range(32) if not before >> f & 1]
    tried = hist.select("*", F.explode(F.array(*(
        F.struct(F.lit(f).alias("own"), F.lit(b).alias("before")) for f, b in states))).alias("at"))
    own, before, fails = F.col("at.own"), F.col("at.before"), F.col("fails")
    failed, earlier = fails.bitwiseAND(own) != 0, fails.bitwiseAND(before) != 0
    if_ = lambda test, c: F.sum(F.when(test, F.col(c)).otherwise(0)).cast("long")
    counts = tried.groupBy("part", own.alias("own"), before.alias("before")).agg(
        if_(~failed & ~earlier, "n").alias("kept"), if_(failed & ~earlier, "n").alias("removed"),
        if_(failed & earlier, "n").alias("redundant"), if_(fails == own, "n").alias("unique_fails"),
        if_(failed & ~earlier, "n_good").alias("good_lost"),
        if_(failed & ~earlier, "n_toxic").alias("toxic_lost"))
    steps = [("".join(FILTERS[f] for f in order), step, 1 << f, sum(1 << g for g in order[:step - 1]))
             for order in itertools.permutations(range(5)) for step, f in enumerate(order, 1)]
    orders = spark.createDataFrame(steps, "filter_order string, step int, own int, before int")
    shapley = F.sum("removed").over(Window.partitionBy("part", "own"))
    return counts.join(F.broadcast(orders), ["own", "before"]).select(  # 600 rows
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
        "good_lost", "toxic_lost", shapley.alias("shapley"))


SQL = r"""
WITH words AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
marked AS (
    SELECT w.part, w.doc_id,
           (len(words) < 100)::INT AS a,
           (100 * len(list_distinct(words)) < 80 * len(words))::INT AS b,
           (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::INT AS c,
           regexp_matches(text, '[#$%&*|]')::INT AS d,
           coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS e,
           coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic
    FROM words w LEFT JOIN (
        SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
        FROM labels GROUP BY doc_id) l USING (doc_id)),
cells AS (
    SELECT part, [a, b, c, d, e] AS fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
    FROM marked GROUP BY part, a, b, c, d, e),
five AS (SELECT unnest([1, 2, 3, 4, 5]) AS f),
orders AS (
    SELECT [p.f, q.f, r.f, s.f, t.f] AS o FROM five p, five q, five r, five s, five t
    WHERE len(list_distinct([p.f, q.f, r.f, s.f, t.f])) = 5),
steps AS (
    SELECT o, array_to_string(list_transform(o, lambda x: 'ABCDE'[x]), '') AS filter_order,
           five.f AS step, o[five.f] AS own, o[1:five.f - 1] AS before
    FROM orders, five),
tried AS (
    SELECT part, filter_order, step, own, n, good, toxic, fails[own] = 1 AS failed,
           len(list_filter(before, lambda x: fails[x] = 1)) > 0 AS earlier,
           list_sum(fails) = 1 AS alone
    FROM cells, steps),
counts AS (
    SELECT part, filter_order, step, own,
           sum(CASE WHEN NOT failed AND NOT earlier THEN n ELSE 0 END)::BIGINT AS kept,
           sum(CASE WHEN failed AND NOT earlier THEN n ELSE 0 END)::BIGINT AS removed,
           sum(CASE WHEN failed AND earlier THEN n ELSE 0 END)::BIGINT AS redundant,
           sum(CASE WHEN failed AND alone THEN n ELSE 0 END)::BIGINT AS unique_fails,
           sum(CASE WHEN failed AND NOT earlier THEN good ELSE 0 END)::BIGINT AS good_lost,
           sum(CASE WHEN failed AND NOT earlier THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM tried GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost,
       toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counts
"""
