"""The filter audit against a plain pass over documents for every order."""

import random
import re
from itertools import permutations

import pytest

from tidewatch.llm import filter_audit

WORD = re.compile("[^\x20\x09-\x0d]+")


def flags(rows):
    """For each row (doc_id, text, lang) the set of filters it fails."""
    smallest = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            smallest[text or ""] = min(doc_id, smallest.get(text or "", doc_id))
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": doc_id is not None and doc_id > smallest[text]}
        out.append({f for f, x in fails.items() if x})
    return out


def plain(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = {}
    for r, f in zip(rows, flags(rows)):
        parts.setdefault(r[2] or "", []).append((r[0], f))
    out = []
    for part, docs in parts.items():
        own, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                failing = [d for d in docs if f in d[1]]
                shapley[f] += len(gone)
                own.append((f, (part, "".join(order), step, len(left), len(gone), len(failing) - len(gone),
                                sum(d[1] == {f} for d in docs), sum(d[0] in good for d in gone),
                                sum(d[0] in toxic for d in gone))))
        out += [(*r, shapley[f]) for f, r in own]
    return sorted(out)


def result(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 1, "x", 0) for r in rows],
                                 "doc_id long, text string, lang string, fails int, words string, quality int")
    known = spark.createDataFrame([(*x, 7) for x in labels], "doc_id long, quality int, toxic int, part int")
    return sorted(tuple(r) for r in filter_audit.audit(docs, known).collect())


def prose(rng, n, words=80):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def mixed(n):
    rng = random.Random(n)
    texts = [prose(rng, rng.choice([10, 99, 100, 101, 150]), rng.choice([60, 400])) for _ in range(n // 2)]
    texts += [None, "", " \t\n", "UPPER CASE " * 60, "a b c " * 100, "50 % of # " * 30, "É" * 9 + "A", "é" * 9 + "AA"]
    rows = [(rng.choice([i, i, i, 3, None]), rng.choice(texts), rng.choice(["en", "de", "", None])) for i in range(n)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, n, 2)]
    return rows, labels + [(None, 1, 1), (3, 1, 0), (3, 0, 1)]


@pytest.mark.parametrize("n", [1, 7, 200])
def test_same_as_plain_pass(spark, n):
    rows, labels = mixed(n)
    assert result(spark, rows, labels) == plain(rows, labels)


def test_shards_and_pieces_end_where_they_should(spark):
    rows, _ = mixed(60)
    text = "\n".join(r[1] or "" for r in rows)
    words = {}
    for w in WORD.findall(text):
        words[w.encode()] = words.get(w.encode(), 0) + 1
    for size in (1, 7, 64, 1 << 20):
        assert filter_audit.word_counts(text.encode(), size) == words
    docs = spark.createDataFrame([(i, "x" * 1_500_000, "en") for i in range(8)],
                                 "doc_id long, text string, lang string").coalesce(1)
    shards, _ = filter_audit.document_term_matrix(docs)
    assert sorted(len(s["doc_ids"]) for s in shards.collect()) == [2, 2, 2, 2]


def test_matrix_holds_every_word(spark):
    rows, _ = mixed(50)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    shards, dictionary = filter_audit.document_term_matrix(docs)
    words = {r["id"]: r["word"] for r in dictionary.collect()}
    assert len(words) == dictionary.count()
    assert set(words.values()) == {w for r in rows for w in WORD.findall(r[1] or "")}
    found = []
    for s in shards.collect():
        for i, doc_id in enumerate(s["doc_ids"]):
            at = slice(s["indptr"][i], s["indptr"][i + 1])
            found.append((doc_id, sorted(zip((words[x] for x in s["indices"][at]), s["counts"][at]))))
    wanted = []
    for doc_id, text, _ in rows:
        ws = WORD.findall(text or "")
        wanted.append((doc_id, sorted((w, ws.count(w)) for w in set(ws))))
    assert sorted(found, key=str) == sorted(wanted, key=str)


def test_packed_numbers():
    import numpy as np
    for values in ([], [0], [0] * 1000, [255, 3], [256, 1, 70_000], list(range(100_000)), [1 << 40, 0]):
        a = np.array(values, np.int64)
        assert filter_audit._unpacked(filter_audit._packed(a)).tolist() == values


def test_copies_fail_except_the_smallest(spark):
    text = " ".join(f"w{i}" for i in range(120))
    rows = [(i, text, "en") for i in (4, 4, 2, 2, 9)] + [(None, text, "en"), (1, text + "x", "en")]
    got = {r[1]: r for r in result(spark, rows, []) if r[2] == 1}
    assert got["EABCD"][3:7] == (4, 3, 0, 3)


def test_long_text(spark):
    text = "Word " * 400_000 + "x" * 3_000_000 + " end"
    assert filter_audit.word_counts(text.encode()) == {b"Word": 400_000, b"x" * 3_000_000: 1, b"end": 1}
    rows = [(1, text, "en"), (2, text, "en")]
    assert result(spark, rows, [(2, 1, 1)]) == plain(rows, [(2, 1, 1)])


def test_empty_tables(spark):
    assert result(spark, [], []) == []
    rows, _ = mixed(20)
    assert result(spark, rows, []) == plain(rows, [])
