"""Helpers shared by the operators: stable storage, words, hashes, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, in Java's and Python's regex syntax.
WORD = "[^\\x20\\x09-\\x0D]+"
#: Texts are hashed in pieces of about this many bytes, which bounds a task's memory.
PIECE_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a session on one machine that names none gets a temporary one.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir is not set")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: the plan is cut."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def spread(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, also used to split hot groups."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def runs_of(df: DataFrame, key: str, *order: str | Column) -> DataFrame:
    """``df`` with all rows of a key in one partition, sorted by key and ``order``.

    Partitions follow a hash of the key, not the key: a partitioning that an earlier join
    left behind could otherwise stand in for this one, and adaptive execution may undo it.
    """
    return (df.repartition(spread(df.sparkSession), F.xxhash64(key))
            .sortWithinPartitions(key, *order))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8 bytes; null is empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def pieces(texts: list[bytes], limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes; a longer text is a range of its own."""
    first = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield first, i
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, len(texts)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def constants(seed: int, n: int) -> np.ndarray:
    """``n`` odd 64-bit constants, a function of the seed alone."""
    i = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)
    return mix64(i * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


_BYTE = constants(1, 256)
_PLACE = {"n": constants(2, 4096)}


def _place(n: int) -> np.ndarray:
    if len(_PLACE["n"]) < n:
        _PLACE["n"] = constants(2, 2 * n)
    return _PLACE["n"]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words' 64-bit hashes, text after text, and where each text's words begin.

    The second array has one entry more than there are texts.  A hash is a sum over the
    word's bytes of two random factors, one of the byte and one of its place, then mixed.
    """
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
    hashes, starts = [], []
    at = 0
    while at < len(data):
        to = min(len(data), at + PIECE_BYTES)
        if to < len(data):  # a piece ends behind white space
            back = np.flatnonzero(_SPACE[data[at:to]])
            while not len(back):
                to = min(len(data), to + PIECE_BYTES)
                back = np.flatnonzero(_SPACE[data[at:to]])
            to = at + int(back[-1]) + 1
        part = data[at:to]
        inside = ~_SPACE[part]
        edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        first, last = edge[0::2], edge[1::2]
        if len(first):
            length = last - first
            begin = np.cumsum(length) - length
            place = np.arange(int(length.sum()), dtype=np.int64) - np.repeat(begin, length)
            terms = _BYTE[part[inside]]
            terms *= _place(int(length.max()))[place]
            hashes.append(mix64(np.add.reduceat(terms, begin) + length.astype(np.uint64)))
            starts.append(first + at)
        at = to
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    s = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return h, np.concatenate([[0], np.searchsorted(s, ends)]).astype(np.int64)


def rolled(h: np.ndarray, width: int, seed: int) -> np.ndarray:
    """A hash of each run of ``width`` neighbours of ``h``."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j, c in enumerate(constants(seed, width)):
        out += h[j:j + n] * c
    return mix64(out)


def with_key(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column, of the name returned, that equal rows and only they share.

    Columns that hold maps, which have no hash, enter as JSON.
    """
    name = "row_key"
    while name in docs.columns:
        name += "_"
    quoted = [F.col("`" + f.name.replace("`", "``") + "`") for f in docs.schema]
    values = [F.to_json(F.struct(c)) if "map<" in f.dataType.simpleString() else c
              for c, f in zip(quoted, docs.schema, strict=True)]
    return docs.withColumn(name, F.xxhash64(*values)), name


def kept_rows(docs: DataFrame, keep: Callable[[pa.RecordBatch], list[bool]]) -> DataFrame:
    """The rows of ``docs``, all columns, for which ``keep`` says so; batch by batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(keep(batch), pa.bool_()))

    # mapInArrow resolves names as expressions, so names that are none stand back meanwhile
    plain = [c if c.isidentifier() else f"{i} {c}".replace(".", " ").replace("`", " ")
             for i, c in enumerate(docs.columns)]
    named = docs.toDF(*plain)
    return named.mapInArrow(run, named.schema).toDF(*docs.columns)


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type)
         for c, f in zip(columns, schema, strict=True)], schema=schema)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a Parquet table in the shared checkpoint folder and read back.

    Smaller than a checkpoint where columns compress well.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
