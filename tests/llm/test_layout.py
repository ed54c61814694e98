"""Sharding, mixing and token counts against plain versions."""

import hashlib
import heapq
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewatch.llm import common, mixing, sharding, tokens

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def some():
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randint(1, 300)), "en", rng.choice(["a", "b", "é", "hot", "hot", "hot", None]))
            for i in range(300)]
    rows += [(1000 + i, rows[0][1], "en", "hot") for i in range(150)]  # a large group of copies
    rows += [(2000, None, None, None), (2001, None, None, "a"), (2002, "", None, "a"), (2003, " \t\n", None, "zero"),
             (2004, prose(rng, 20000), "en", "b"), (None, "no id", "en", "a"), (None, None, None, None),
             (5, rows[5][1], "en", rows[5][3]), (5, rows[5][1], "en", rows[5][3])]
    return rows


def test_sharding(docs, some):
    got = sharding.shard_documents(docs(some), 7).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (d, 16 + len((t or "").encode()), None if t is None else zlib.crc32(t.encode())) for d, t, *_ in some)
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}
    home, slots, load = defaultdict(set), defaultdict(list), Counter()
    text = {r[0]: r[1] for r in some}
    for r in got:
        slots[r.shard].append(r.slot)
        load[r.shard] += r.size
        if r.doc_id is not None:
            home[text[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in home.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = Counter()
    for _, t, *_ in some:
        groups[t] += 16 + len((t or "").encode())
    heap = [0] * 7
    for size in sorted(groups.values(), reverse=True):
        heapq.heapreplace(heap, heap[0] + size)
    assert max(load.values()) <= 1.01 * max(heap)


def test_sharding_a_crowd_of_alike_rows(docs, some, monkeypatch):
    crowd = [(None, "the same page", "en", "a")] * 1001 + [(7, None, "en", "a")] * 16 + [(None, None, None, None)] * 9
    monkeypatch.setattr(sharding, "ALIKE", 8)
    got = [sharding.shard_documents(docs(some + crowd).repartition(n), 3).collect() for n in (2, 5)]
    assert Counter(got[0]) == Counter(got[1])  # slots do not depend on where rows lie
    rows = Counter((d, 16 + len((t or "").encode())) for d, t, *_ in some + crowd)
    assert Counter((r.doc_id, r.size) for r in got[0]) == rows
    slots = defaultdict(list)
    for r in got[0]:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    page = [r for r in got[0] if r.doc_id is None and r.size == 16 + len("the same page")]
    assert len(page) == 1001 and len({r.shard for r in page}) == 1
    at = sorted(r.slot for r in page)  # numbered in several buckets, other rows in between
    assert at[-1] - at[0] >= 1001


def test_deal_fills_like_a_heap():
    classes = [(1000, 3, 3000), (10, 5000, 50000), (7, 1, 7)]
    load = np.zeros(5)
    for cls, begins, owners in sharding.deal(classes, 5):
        n = {c: k for c, k, _ in classes}[cls]
        for b, e, s in zip(begins, [*begins[1:], n], owners, strict=True):
            load[s] += cls * (e - b)
    heap = [0] * 5
    for size in [1000] * 3 + [10] * 5000 + [7]:
        heapq.heapreplace(heap, heap[0] + size)
    assert sorted(load) == sorted(heap)


def test_sharding_nothing(docs):
    assert sharding.shard_documents(docs([])).collect() == []


def plain_mix(rows):
    words = [len((t or "").encode().split()) for _, t, *_ in rows]
    size = Counter()
    for r, n in zip(rows, words, strict=True):
        size[r[3]] += n
    order = sorted((s for s in size if s is not None), key=str.encode) + [None] * (None in size)
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, capped = sum(words), set()
    while True:
        rest = [s for s in order if s not in capped]
        left = total - sum(3 * size[s] for s in capped)
        target = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = {s for s in rest if target[s] > 3 * size[s]}
        if not over:
            break
        capped |= over
    target |= {s: 3.0 * size[s] for s in capped}
    return words, size, target


def test_mixing(docs, some):
    words, size, target = plain_mix(some)
    got = mixing.mix_documents(docs(some)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in some)
    source = {r[0]: r[3] for r in some if r[0] is not None}
    taken, largest = Counter(), Counter()
    for r in got:
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        if r.doc_id is not None:
            s = source[r.doc_id]
            assert r.source_size == size[s] and r.target == pytest.approx(target[s])
            taken[s] += r.taken
            largest[s] = max(largest[s], r.size)
    for s in set(source.values()) - {"a", None}:  # those two have rows without an id
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6
    again = mixing.mix_documents(docs(list(reversed(some))).repartition(3)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert mixing.mix_documents(docs([])).collect() == []


def test_draw_follows_inclusion(docs):
    rows = [(i, "one two three", "en", "a" if i % 4 else "b") for i in range(4000)]
    got = mixing.mix_documents(docs(rows)).collect()  # a: 1000 of 3000 words' worth, b: 3 copies at most
    share = [r.copies for r in got if r.doc_id % 4]
    assert 0 < sum(share) < len(share) and set(share) == {0, 1}
    early = sum(share[:1500])
    assert abs(early - sum(share) / 2) < 100  # no trend over ids


ODD = ["", " ", "it's <|endoftext|>x <|startoftext|>", "é ́ ä̈", "\x85a\xa0b　c\x1cd", "İstanbul ΣΑΣ ς",
       "123 4a5 !!!?? 's 'st 're", "한 글 한", "x" * 500, "<|endoftext|", "a\x00b ﻿", "ﬁ ½ Ⅳ"]


def test_token_counts(docs, spark):
    tok = Tokenizer.from_file(TOKENIZER)
    rng = random.Random(1)
    texts = ODD + [" ".join(rng.choice(ODD) for _ in range(40)) for _ in range(20)]
    want = [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]
    got = tokens.count_tokens(docs(list(enumerate([*texts, None]))), TOKENIZER, limit=30).collect()
    got = sorted(got)
    assert [r.n_tokens for r in got] == [*want, 0]
    assert [r.n_bytes for r in got] == [*(len(t.encode()) for t in texts), 0]
    assert all(r.over_limit == (r.n_tokens > 30) for r in got)
    assert tokens.count_tokens(docs([]), TOKENIZER).collect() == []


def test_spliced_chunks_count_like_the_whole():
    tok = Tokenizer.from_file(TOKENIZER)
    rng = random.Random(2)
    for chunk, overlap in ((200, 16), (1000, 64), (64, 4)):
        counter = tokens.Counter(TOKENIZER, chunk, overlap)
        for text in (prose(rng, 3000), "y" * 3000 + " " + prose(rng, 300) + "z" * 900, " ".join(ODD * 30), "\n" * 5000,
                     prose(rng, 50) + "!" * 700 + " ́" * 400):
            assert counter.count_long(text) == len(tok.encode(text, add_special_tokens=False).ids)


def test_word_hashes_agree_with_split(monkeypatch):
    rng = random.Random(3)
    texts = [bytes(rng.choice(b"ab \t\n\x0b\x0c\r\x85\xa0\x1c") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    texts.append(b"q" * 5000)
    monkeypatch.setattr(common, "PIECE_BYTES", 64)
    h, starts = common.word_hashes(texts)
    words = [t.split() for t in texts]
    assert np.diff(starts).tolist() == list(map(len, words))
    flat = [w for t in words for w in t]
    assert len(set(zip(flat, h.tolist(), strict=True))) == len(set(flat)) == len(set(h.tolist()))


def test_sql_random_is_the_digest(spark):
    row = spark.range(3).select("id", mixing._random(F.col("id"), "mix").alias("u")).collect()
    for r in row:
        digest = hashlib.md5(b"mix%d" % r.id).hexdigest()
        assert r.u == (int(digest[:12], 16) + 0.5) / 2**48


def unspaced():
    rng = random.Random(6)
    some = "".join(chr(rng.randrange(0x4E00, 0x4F00)) for _ in range(3000))
    chinese = "".join(rng.choice(["的一是", "不了人", "我在有", "他这", "，", "。", "1", "2021"]) for _ in range(3000))
    return [some, chinese, "ab" * 4000, "a1b2-" * 2000, "aGVsbG8+d29ybGQ/" * 600, "x" * 9000, "-" * 5000,
            "<|endoftext|>" * 400, "word <|endoftext|>x," * 300, "it's we're 12,345.678 don't " * 200]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("chunk, overlap", [(64, 8), (500, 32), (1000, 300)])
def test_splicing_without_white_space(name, chunk, overlap):
    path = public_tokenizers.path(name)
    tok = Tokenizer.from_file(path)
    counter = tokens.Counter(path, chunk, overlap)
    for text in unspaced():
        want = len(tok.encode(text, add_special_tokens=False).ids)
        assert counter.count_long(text) == want
        assert counter.count_batch([text, text[:50]]) == [want, len(tok.encode(text[:50], add_special_tokens=False).ids)]


def test_tokenizers_that_white_space_does_not_split():
    assert tokens.Counter(public_tokenizers.path("word_bpe_49k.json")).by_pieces
    assert not tokens.Counter(public_tokenizers.path("byte_bpe_50k.json")).by_pieces


def test_time_of_unspaced_texts():
    rng = random.Random(7)
    text = "".join(rng.choice(["的一是", "不了人", "我在有", "，"]) for _ in range(150_000))
    counter = tokens.Counter(public_tokenizers.path("word_bpe_49k.json"))
    start = time.perf_counter()
    whole = counter._count(text)
    once = time.perf_counter() - start
    start = time.perf_counter()
    assert counter.count_long(text) == whole
    assert time.perf_counter() - start < 6 * once + 2

