"""Merkle manifest of a dataset by time-forward processing.

A leaf is the digest of a row; the leaves of a language, in order of doc_id, form a tree of
fan-out 8, and the languages' roots another one.  Nodes are labelled by (level, index), and a
digest is a message to the label of its parent.  The upward sweep takes messages in the order
of labels: rows travel to their block of ``FAN ** DEPTH`` neighbours through Spark's sorted
shuffle, the external queue, and inside a block a heap delivers child digests to parents.  One
round reduces a tree by that factor, and its tables are stored.  The reversed sweep sends each
block one message, the siblings on the way from its top node to the root (the proof's suffix),
and each leaf gets the siblings inside its block and that suffix.

No task holds more than one block and no language is one task: blocks of one language are
spread over all partitions, positions come from a range partitioning and a sum over partitions.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, batch_of, spread, stored

FAN = 8
#: Levels that one round of the sweeps crosses: a block is FAN ** DEPTH neighbours.
DEPTH = 3
#: The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_LOW_BITS = (1 << 33) - 1

_NODES = "grp string, pos long, m long, digest string"
_NOTES = "grp string, pos long, lefts array<string>, rights array<string>, tops array<string>"
_PROOFS = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
           "folded_root string")


def digest_of(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """A value with its length in front, ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column) -> Column:
    return F.sha2(F.concat(*(field(text if c == "text" else F.col(c)) for c in FIELDS)), 256)


def ranked(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows`` with ``pos``, their place in the group from 0, and ``m``, the group's size.

    Rows equal in ``order`` take places in any order.  They are range partitioned, so that
    neither a large group nor a repeated row stands in one task, and stored before they are
    counted, so that places don't change when a task runs again.
    """
    n = spread(rows.sparkSession)
    dealt = stored(rows.withColumn("_salt", F.spark_partition_id())
                   .repartitionByRange(n, group, *order, "_salt")
                   .sortWithinPartitions(group, *order).drop("_salt")
                   .withColumn("_nth", F.monotonically_increasing_id()))
    part, nth = F.shiftright("_nth", 33), F.col("_nth").bitwiseAND(F.lit(_LOW_BITS))
    counts = dealt.groupBy(F.col(group).alias("_group"), part.alias("_part")).agg(
        F.count("*").alias("_n"), F.min(nth).alias("_first"))  # partitions x groups at most
    whole = Window.partitionBy("_group")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_group", "_part", F.sum("_n").over(whole).alias("m"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_offset"))
    return (dealt.withColumn("_at", part)
            .join(offsets, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_at") == F.col("_part")))
            .withColumn("pos", (nth + F.col("_offset")).cast("long"))
            .drop("_nth", "_at", "_group", "_part", "_offset"))


def swept(digests: list[str], m: int, depth: int) -> list[list[str]]:
    """The levels of a block, leaves first; ``m`` is the number of nodes of its whole tree.

    Messages (level, place, digest) wait in a heap for the label of their parent.  A block of a
    tree that goes on above it has ``depth`` levels, even where one node is left; a tree that
    ends in this block ends when one node is left.
    """
    levels = [digests]
    queue = [(1, i, d) for i, d in enumerate(digests)]
    heapq.heapify(queue)
    high = m > FAN ** depth
    while queue and (len(levels) <= depth if high else len(levels[-1]) > 1):
        level, nodes = queue[0][0], []
        while queue and queue[0][0] == level:
            run = queue[0][1] // FAN
            children = []
            while queue and queue[0][0] == level and queue[0][1] // FAN == run:
                children.append(heapq.heappop(queue)[2])
            parent = digest_of("".join(children))
            heapq.heappush(queue, (level + 1, run, parent))
            nodes.append(parent)
        levels.append(nodes)
    return levels


def paths(levels: list[list[str]], suffix: tuple[list[str], list[str]]
          ) -> list[tuple[list[str], list[str]]]:
    """For each leaf of a block its siblings left and right, level by level, then the suffix.

    Sweeps the labels downwards: a node hands its children its own siblings and what it got.
    """
    got = [suffix]
    for nodes in reversed(levels[:-1]):
        below = []
        for i in range(len(nodes)):
            first, (lefts, rights) = i - i % FAN, got[i // FAN]
            below.append((["".join(nodes[first:i]), *lefts],
                          ["".join(nodes[i + 1:first + FAN]), *rights]))
        got = below
    return got


def _blocks(df: DataFrame) -> DataFrame:
    """All rows of a block in one partition, in order of place; the block's message is first."""
    return (df.repartition(spread(df.sparkSession), F.xxhash64("grp", "block"))
            .sortWithinPartitions("grp", "block", "pos"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    """Blocks of a sorted partition, one at a time, also across batches."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for key, run in itertools.groupby(rows, lambda r: (r["grp"], r["block"])):
        yield key, list(run)


def _written(rows: Iterator[tuple], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    while some := list(itertools.islice(rows, size)):
        yield batch_of(schema, *map(list, zip(*some, strict=True)))


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "array<string>": pa.list_(pa.string())}
    return pa.schema([pa.field(name, kinds[kind]) for name, kind in
                      (c.strip().split(" ") for c in ddl.split(","))])


def sweep_up(nodes: DataFrame, depth: int = DEPTH) -> list[DataFrame]:
    """The nodes after each round; the last table has the root of each group.

    ``nodes`` needs grp, pos, m and digest.  The number of rounds is the logarithm of the
    largest group's size to the base of a block.
    """
    block = FAN ** depth
    schema = _arrow(_NODES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tops():
            for (grp, at), rows in _runs(batches):
                levels = swept([r["digest"] for r in rows], rows[0]["m"], depth)
                yield grp, at, -(-rows[0]["m"] // block), levels[-1][0]
        yield from _written(tops(), schema)

    tables, left = [nodes], nodes.agg(F.max("m")).first()[0] or 0
    while left > 1:
        placed = tables[-1].select("grp", "pos", "m", "digest",
                                   F.expr(f"pos div {block}").alias("block"))
        tables.append(stored(_blocks(placed).mapInArrow(run, _NODES)))
        left = -(-left // block)
    return tables


def sweep_down(tables: list[DataFrame], notes: DataFrame, emit: Callable[[dict, list, list, list], tuple],
               ddl: str, payload: list[str], depth: int = DEPTH) -> DataFrame:
    """What ``emit`` makes of each node of the first table, its path and what came from above.

    ``notes`` has one message for each node of the last table: its siblings up to the root and
    ``tops``, values that all nodes below it are given.
    """
    rounds = len(tables) - 1
    for r in range(max(rounds - 1, 0), -1, -1):
        last = r == 0
        extra = payload if last else []
        schema = _arrow(ddl if last else _NOTES)
        make = emit if last else _note
        width = FAN ** depth if rounds else 1  # without a round, nodes are roots

        def run(batches: Iterator[pa.RecordBatch], make=make, schema=schema) -> Iterator[pa.RecordBatch]:
            def out():
                for _, (note, *rows) in _runs(batches):
                    levels = swept([x["digest"] for x in rows], rows[0]["m"], depth)
                    for row, (lefts, rights) in zip(
                            rows, paths(levels, (note["lefts"], note["rights"])), strict=True):
                        yield make(row, lefts, rights, note["tops"])
            yield from _written(out(), schema)

        nodes = tables[r].select("grp", "pos", "m", "digest", *extra,
                                 F.expr(f"pos div {width}").alias("block"))
        sent = notes.select("grp", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"),
                            "lefts", "rights", "tops")
        both = _blocks(nodes.unionByName(sent, allowMissingColumns=True))
        notes = both.mapInArrow(run, ddl if last else _NOTES)
        if not last:
            notes = stored(notes)
    return notes


def _note(row: dict, lefts: list[str], rights: list[str], tops: list[str]) -> tuple:
    return row["grp"], row["pos"], lefts, rights, tops


def _lang_note(row: dict, lefts: list[str], rights: list[str], tops: list[str]) -> tuple:
    """The message to a language's root: the way on to the root of all."""
    return row["lang"], 0, lefts, rights, [row["digest"], *tops]


def _proof(row: dict, lefts: list[str], rights: list[str], tops: list[str]) -> tuple:
    siblings = "".join(a + b for a, b in zip(lefts, rights, strict=True))
    folded = row["tampered"] or row["digest"]
    for a, b in zip(lefts, rights, strict=True):
        folded = digest_of(a + folded + b)
    return row["doc_id"], row["digest"], *tops, digest_of(siblings), folded


def manifest(docs: DataFrame, tampered: Column | None = None, depth: int = DEPTH) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``docs`` needs doc_id, source, lang, n_chars and text; other columns are ignored.  Where
    ``tampered`` (a condition; nowhere by default) holds, folded_root starts from the leaf of
    the row with the text's A-Z lower-cased, else from the leaf itself; a null condition does
    not hold.  ``verified`` says whether it ends at the root.

    Nulls are fields of their own (``-``), null languages a tree, null ids come first.  Rows of
    equal doc_id stand in order of their leaves; equal rows have equal leaves and a place each.
    An empty text is not null.  A language of one row has its leaf as subroot; one language
    alone has its subroot as root; a single row has the digest of nothing as proof.  An empty
    table gives an empty result.
    """
    hit = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    leaves = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").alias("grp"),
        leaf_digest(F.col("text")).alias("digest"),
        F.when(hit & F.col("text").isNotNull(), leaf_digest(ascii_lower(F.col("text")))).alias("tampered"))
    trees = sweep_up(stored(ranked(leaves, "grp", "doc_id", "digest")), depth)
    langs = trees[-1].select(F.lit("").alias("grp"), F.col("grp").alias("lang"), "digest")
    top = sweep_up(stored(ranked(langs, "grp", "lang")), depth)
    nothing = F.array().cast("array<string>")
    start = top[-1].select("grp", "pos", nothing.alias("lefts"), nothing.alias("rights"),
                           F.array("digest").alias("tops"))
    notes = stored(sweep_down(top, start, _lang_note, _NOTES, ["lang"], depth))
    proofs = sweep_down(trees, notes, _proof, _PROOFS, ["doc_id", "tampered"], depth)
    return proofs.withColumn("verified", F.col("folded_root") == F.col("root"))


#: The same for DuckDB, with the tampering of the query.
SQL = """
WITH RECURSIVE ids AS (
    SELECT DISTINCT doc_id, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT) AS bytes
    FROM documents WHERE doc_id IS NOT NULL),
crc AS (
    SELECT doc_id, xor(list_reduce(bytes, lambda a, b: list_reduce(
        [1::BIGINT, 2, 3, 4, 5, 6, 7, 8],
        lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
        xor(a, b)), 4294967295::BIGINT), 4294967295) AS crc
    FROM ids),
fields AS (
    SELECT d.doc_id, lang, coalesce(crc % 3 = 0, false) AS hit,
           coalesce(strlen(d.doc_id::VARCHAR) || ':' || d.doc_id, '-')
           || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-')
           || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
           coalesce(strlen(text) || ':' || text, '-') AS body,
           coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                     'abcdefghijklmnopqrstuvwxyz'), '-') AS folded
    FROM documents d LEFT JOIN crc USING (doc_id)),
leaves AS (
    SELECT doc_id, lang, sha256(head || body) AS leaf,
           CASE WHEN hit THEN sha256(head || folded) ELSE sha256(head || body) END AS start
    FROM fields),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
           count(*) OVER (PARTITION BY lang) AS m
    FROM leaves),
up AS (
    SELECT 0 AS lvl, lang, pos, m, leaf AS digest FROM placed
    UNION ALL
    SELECT lvl + 1, lang, pos // 8, (m + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos))
    FROM up WHERE m > 1 GROUP BY lvl, lang, pos // 8, m),
subroots AS (
    SELECT lang, lvl, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos,
           count(*) OVER () AS m
    FROM up WHERE m = 1),
top AS (
    SELECT 0 AS lvl, pos, m, digest FROM subroots
    UNION ALL
    SELECT lvl + 1, pos // 8, (m + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos))
    FROM top WHERE m > 1 GROUP BY lvl, pos // 8, m),
steps AS (
    SELECT p.lang, p.pos, u.lvl,
           coalesce(string_agg(u.digest, '' ORDER BY u.pos) FILTER (u.pos < p.pos // (8 ** u.lvl)::BIGINT), '') AS l,
           coalesce(string_agg(u.digest, '' ORDER BY u.pos) FILTER (u.pos > p.pos // (8 ** u.lvl)::BIGINT), '') AS r
    FROM placed p JOIN up u ON p.lang IS NOT DISTINCT FROM u.lang AND u.m > 1
     AND u.pos // 8 = p.pos // (8 ** (u.lvl + 1))::BIGINT
    GROUP BY p.lang, p.pos, u.lvl),
top_steps AS (
    SELECT s.lang, 1000 + t.lvl AS lvl,
           coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos < s.pos // (8 ** t.lvl)::BIGINT), '') AS l,
           coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos > s.pos // (8 ** t.lvl)::BIGINT), '') AS r
    FROM subroots s JOIN top t ON t.m > 1 AND t.pos // 8 = s.pos // (8 ** (t.lvl + 1))::BIGINT
    GROUP BY s.lang, t.lvl),
walks AS (
    SELECT p.lang, p.pos, list(w.l || '|' || w.r ORDER BY w.lvl) AS walk,
           string_agg(w.l || w.r, '' ORDER BY w.lvl) AS siblings
    FROM placed p JOIN (
        SELECT lang, pos, lvl, l, r FROM steps
        UNION ALL
        SELECT t.lang, p.pos, t.lvl, t.l, t.r FROM top_steps t JOIN placed p ON p.lang IS NOT DISTINCT FROM t.lang
    ) w ON p.lang IS NOT DISTINCT FROM w.lang AND p.pos = w.pos
    GROUP BY p.lang, p.pos),
proofs AS (
    SELECT p.doc_id, p.leaf, s.digest AS subroot, (SELECT digest FROM top WHERE m = 1) AS root,
           sha256(coalesce(w.siblings, '')) AS proof_sha256,
           list_reduce(coalesce(w.walk, CAST([] AS VARCHAR[])), lambda h, x:
               sha256(split_part(x, '|', 1) || h || split_part(x, '|', 2)), p.start) AS folded_root
    FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang
    LEFT JOIN walks w ON p.lang IS NOT DISTINCT FROM w.lang AND p.pos = w.pos)
SELECT *, folded_root = root AS verified FROM proofs
"""
