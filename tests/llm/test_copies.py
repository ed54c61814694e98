"""SimHash near copies, components and passage removal against plain versions."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from tidewatch.llm import simhash, substrings
from tidewatch.llm.components import components


def union(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)]
    links += [(2000, 2000 + i) for i in range(1, 300)]
    want = union(links, {x for p in links for x in p if p[0] != p[1]})
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == want


def plain_fingerprint(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [w[i:i + 4] for i in range(len(w) - 3)] or ([w] if w else [])
    h = [xxhash.xxh64_intdigest(b" ".join(s), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near_texts(rng):
    texts = []
    for _ in range(12):
        base = ["".join(rng.choice("abcde") for _ in range(4)) for _ in range(rng.randint(3, 200))]
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = "zz"
            texts.append(" ".join(copy))
    return texts


def test_near_copies(docs):
    rng = random.Random(6)
    texts = near_texts(rng) + [None, "", " \n", "A b", "a B", "É b", "one two three four", "x " * 30000]
    rows = [(3 * i + 1, t) for i, t in enumerate(texts)] + [(1, texts[0]), (1, texts[0]), (None, texts[1])]
    fp = [plain_fingerprint(t) for _, t in rows]
    pairs = [(a, b) for a in set(fp) for b in set(fp) if a < b and (a ^ b).bit_count() <= 4]
    root = union(pairs, set(fp))
    least = {}
    for f, (d, _) in zip(fp, rows, strict=True):
        if d is not None:
            least[root[f]] = min(d, least.get(root[f], d))
    want = Counter((d, f"{f:016x}", least[root[f]]) for f, (d, _) in zip(fp, rows, strict=True))
    assert Counter(map(tuple, simhash.near_copies(docs(rows)).collect())) == want
    assert simhash.near_copies(docs([])).collect() == []


@pytest.mark.parametrize("crowd", [8, 1 << 14])
@pytest.mark.parametrize("segments", [2, 3, 4, 5])
def test_links_connect_what_is_near(spark, monkeypatch, crowd, segments):
    monkeypatch.setattr(simhash, "segments_for", lambda n, bits: segments)
    rng = random.Random(crowd + segments)
    values = set()
    for _ in range(20):
        x = rng.getrandbits(64)
        for _ in range(25):
            values.add(x)
            for _ in range(rng.randint(1, 6)):
                x ^= 1 << rng.randrange(64)
    signed = np.array(sorted(values), np.uint64).view(np.int64).tolist()
    got = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), 4, crowd).collect()
    links = {tuple(int(np.array([v]).view(np.uint64)[0]) for v in r) for r in got}
    assert all((a ^ b).bit_count() <= 4 for a, b in links)
    pairs = [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 4]
    assert union(links, values) == union(pairs, values)


@pytest.mark.parametrize("bits", [1, 3, 4])
def test_crowds_under_any_number_of_bits(spark, monkeypatch, bits):
    monkeypatch.setattr(simhash, "segments_for", lambda n, bits: 2)
    rng = random.Random(bits)
    values = set()
    for _ in range(20):
        x = rng.getrandbits(64)
        for _ in range(15):
            values.add(x)
            for _ in range(rng.randint(1, bits + 2)):
                x ^= 1 << rng.randrange(64)
    signed = np.array(sorted(values), np.uint64).view(np.int64).tolist()
    got = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), bits, 4).collect()
    links = {tuple(int(np.array([v]).view(np.uint64)[0]) for v in r) for r in got}
    assert links and all((a ^ b).bit_count() <= bits for a, b in links)
    pairs = [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= bits]
    assert union(links, values) == union(pairs, values)


def plain_removal(rows, window=13):
    words = [(d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - window + 1):
            if d is not None:
                k = tuple(w[i:i + window])
                first[k] = min(d, first.get(k, d))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i:i + window])] < d:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), kept))
    return Counter(out)


def passages(rng, vocabulary, n):
    word = lambda: rng.choice(vocabulary)
    shared = [[word() for _ in range(rng.randint(10, 40))] for _ in range(8)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(shared)
            a, b = sorted((rng.randint(0, len(p)), rng.randint(0, len(p))))
            w += [word() for _ in range(rng.randint(0, 9))] + (p if rng.random() < 0.5 else p[a:b])
        rows.append((rng.randrange(4 * n), " ".join(w)))
    return rows


@pytest.mark.parametrize("letters", ["ab", "abcdefgh"])
def test_removal(docs, monkeypatch, letters):
    rng = random.Random(len(letters))
    vocabulary = [x + y for x in letters for y in letters]
    rows = passages(rng, vocabulary, 150)
    rows += [(500 + i, rows[3][1]) for i in range(60)] + [(7, "a b " * 400), (9, "a b " * 300), (9, "a b " * 300),
             (10, None), (11, ""), (12, "x\ty\n" * 7), (None, rows[3][1]), (13, "y x " * 6 + "y")]
    monkeypatch.setattr(substrings, "TOGETHER", 500)
    got = substrings.remove_repeats(docs(rows).repartition(5)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in got) == plain_removal(rows)
    assert substrings.remove_repeats(docs([])).collect() == []


def test_removal_of_keys_that_span_batches(spark, docs, monkeypatch):
    rng = random.Random(12)
    own = lambda n: ["w%d" % rng.randrange(10**6) for _ in range(n)]
    short, long = own(9), own(30)
    rows = []
    for i in range(120):
        rows.append((rng.randrange(90), " ".join(own(rng.randint(0, 20)) + short + own(rng.randint(0, 20)))))
        rows.append((rng.randrange(90), " ".join((own(3) + short) * 4 + (long if i % 3 else own(4) + long[:15]))))
    rows += [(200, " ".join(short * 30)), (201, " ".join(short * 30)), (200, " ".join(own(2) + short * 20))]
    monkeypatch.setattr(substrings, "TOGETHER", 50)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    try:
        for n in (1, 7, 64):
            spark.conf.set(size, n)
            got = substrings.remove_repeats(docs(rows).repartition(3)).collect()
            assert Counter((r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in got) == plain_removal(rows)
    finally:
        spark.conf.set(size, before)
