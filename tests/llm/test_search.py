"""Decontamination, top-k search and backoff scoring against plain versions."""

import math
import os
import random
import statistics
import zlib
from collections import Counter

import numpy as np
import pytest

from tidewatch.llm import decontamination as deco
from tidewatch.llm import katz, maxscore


def distance(item, text):
    """Least edit distance of item to a run of text."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for w in text:
        new = [0]
        for i, x in enumerate(item, 1):
            new.append(min(row[i - 1] + (x != w), row[i] + 1, new[i - 1] + 1))
        row = new
        best = min(best, row[-1])
    return best


def edited(rng, words, edits, fresh):
    words = list(words)
    for _ in range(edits):
        i = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[i] = fresh()
        elif kind == 1:
            words.insert(i, fresh())
        elif len(words) > 1:
            del words[i]
    return words


def test_best_match():
    rng = random.Random(1)
    for _ in range(150):
        item = [rng.randrange(4) for _ in range(rng.randint(1, 9))]
        text = [rng.randrange(4) for _ in range(rng.randint(0, 20))]
        want = distance(item, text)
        got = deco.best_match(np.array(item, np.uint64), np.array(text, np.uint64), len(item) - 1)
        if want >= len(item):
            assert got is None
        else:
            d, a, b = got
            assert d == want and distance(item, text[a:b]) == want


def leak_case(rng, n_items=60):
    common = ["the", "of", "and", "in", "to"]
    fresh = lambda: rng.choice(common) if rng.random() < 0.4 else "w%d" % rng.randrange(3000)
    items = [(i, [fresh() for _ in range(rng.randint(8, 60))]) for i in range(n_items)]
    items += [(900, ["too", "short"]), (901, ["the"] * 20)]
    rows = []
    for i in range(240):
        body = [fresh() for _ in range(rng.randint(0, 200))]
        if i % 2:
            k, words = items[rng.randrange(n_items)]
            at = rng.randint(0, len(body))
            body[at:at] = edited(rng, words, rng.randint(0, deco.edits_allowed(len(words))), fresh)
        rows.append((i, " ".join(body).title() if i % 3 else " \n".join(body)))
    return items, rows


def test_leaks(docs, spark):
    items, rows = leak_case(random.Random(2))
    rows += [(1000, None), (1001, ""), (None, " ".join(items[0][1])), (3, rows[3][1]), (1002, "THE " * 5000),
             (1003, "x " * 30000 + " ".join(items[5][1]))]
    table = spark.createDataFrame([(i, " ".join(w), "x") for i, w in items] + [(50000, None, None), (50001, "", "x")],
                                  "item_id long, text string, doc_id string")
    want = {}
    for d, t in rows:
        words = (t or "").lower().split()
        have = Counter(words)
        for i, w in items:
            most = deco.edits_allowed(len(w))
            if len(w) >= deco.LEAST_WORDS and sum((Counter(w) & have).values()) >= len(w) - most:
                if len(words) < 20000 and distance(w, words) <= most:
                    want[d, i] = distance(w, words)
    want[1003, 5] = 0
    want[1002, 901] = 0
    got = deco.find_leaks(docs(rows), table).collect()
    found = {(r.doc_id, r.item_id): r.edits for r in got}
    assert found.keys() <= want.keys() and all(found[k] >= want[k] for k in found)
    assert len(found) >= 0.95 * len(want)
    assert all((k in found) for k, e in want.items() if e == 0)
    by_id = dict(items)
    text = {r[0]: (r[1] or "").lower().split() for r in rows}
    assert all(distance(by_id[r.item_id], text[r.doc_id][r.begin:r.end]) == r.edits for r in got if r.doc_id != 1002)
    assert Counter(r.doc_id for r in got)[3] in (0, 2)
    blocks = deco.find_leaks(docs(rows), table, block_bytes=1500).collect()
    assert Counter(map(tuple, blocks)) == Counter(map(tuple, got))
    assert deco.find_leaks(docs([]), table).collect() == []
    assert deco.find_leaks(docs(rows), table.limit(0)).collect() == []


def test_short_items_word_for_word(docs, spark):
    items = [(1, "What is the capital of Peru?"), (2, "name two  primes"), (3, "name two primes"), (4, "yes"),
             (5, "one two three four five six seven"), (6, "a b a"), (None, "a b a")]
    rows = [(10, "x WHAT is the\ncapital of Peru? y"), (11, "what is the capital of Chile?"), (12, "we name two"),
            (13, "primes then Name two primes, or name two primes"), (14, "yes " * 5000), (15, "a b a b a"),
            (16, "one two three four five six eight"), (17, "one two three four five six seven"), (18, None), (19, ""),
            (20, "name two"), (21, "primes yesterday"), (10, "x WHAT is the\ncapital of Peru? y")]
    want = Counter({(10, 1, 0, 1, 7): 2, (13, 2, 0, 6, 9): 1, (13, 3, 0, 6, 9): 1, (14, 4, 0, 0, 1): 1,
                    (15, 6, 0, 0, 3): 1, (15, None, 0, 0, 3): 1, (17, 5, 0, 0, 7): 1})
    table = spark.createDataFrame(items, "item_id long, text string")
    for size in (10, deco.BLOCK_BYTES):
        assert Counter(map(tuple, deco.find_leaks(docs(rows).coalesce(1), table, block_bytes=size).collect())) == want
    assert {r.doc_id for r in deco.drop_leaks(docs(rows), table).collect()} == {11, 12, 16, 18, 19, 20, 21}


def test_items_that_share_a_prompt(monkeypatch):
    """A text that repeats the prompt of many items meets them once, not at each place."""
    rng = random.Random(4)
    fresh = lambda: "w%d" % rng.randrange(5000)
    prompt = ["p%d" % i for i in range(19)]
    items = [(i, prompt + [fresh() for _ in range(30)]) for i in range(300)]
    items += [(300, prompt + items[5][1][19:-1] + ["other"]), (301, prompt * 3)]
    index = deco.Index.build([(i, " ".join(w)) for i, w in items], deco.REPETITIONS)
    rows = [[x for _ in range(20) for x in prompt + [fresh() for _ in range(20)]] for _ in range(4)]
    rows[1][200:200] = items[5][1]
    rows[2][3:3] = edited(rng, items[9][1], 4, fresh)
    rows[3][40:40] = prompt * 3
    h, starts = deco.word_hashes([" ".join(w).encode() for w in rows])
    got = sorted((d, f[0], f[1]) for d, f in deco._verified(index, h, starts))
    want = sorted((d, i, e) for d, words in enumerate(rows) for i, w in items
                  if len(set(w) - set(words)) <= deco.edits_allowed(len(w))
                  for e in [distance(w, words)] if e <= deco.edits_allowed(len(w)))
    assert got == want and len(want) == 4
    followed = [set(index.candidates(h[a:b])[:, 1].tolist()) for a, b in zip(starts[:-1], starts[1:], strict=True)]
    assert followed == [{301}, {5, 300, 301}, {9, 301}, {301}]
    whole = [index.candidates(h[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
    monkeypatch.setattr(deco, "PLACES", 7)
    for (a, b), near in zip(zip(starts[:-1], starts[1:], strict=True), whole, strict=True):
        assert (index.candidates(h[a:b]) == near).all()


def test_recall_at_the_most_edits():
    rng = random.Random(7)
    hit = n = 0
    for _ in range(12):
        items, _ = leak_case(rng)
        index = deco.Index.build([(i, " ".join(w)) for i, w in items], deco.REPETITIONS)
        for i, w in items[:60]:
            most = deco.edits_allowed(len(w))
            text = " ".join(edited(rng, w, most, lambda: "w%d" % rng.randrange(3000)))
            h, starts = deco.word_hashes([("a b c " + text + " d e f").encode()])
            hit += any(index.ids[k] == i for k in index.candidates(h)[:, 1])
            n += 1
    assert hit >= 0.95 * n


def plain_top(rows, every, k):
    ok = [(i, [math.floor(64 * c) for c in v]) for i, v in rows
          if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for q, qv in ok:
        if q % every == 0:
            best = sorted(((-sum(a * b for a, b in zip(qv, v, strict=False)), i) for i, v in ok if i != q))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return Counter(out)


@pytest.mark.parametrize("spread", [1.0, 0.05, 1e5, 3e6])
def test_top_k(spark, monkeypatch, spread):
    rng = random.Random(8)
    monkeypatch.setattr(maxscore, "SHARD_ROWS", 60)
    monkeypatch.setattr(maxscore, "BAND_QUERIES", 7)
    monkeypatch.setattr(maxscore, "SEEDS", 25)
    monkeypatch.setattr(maxscore, "PROBED", 2)
    rows = [(i, [rng.gauss(0, spread) for _ in range(9)]) for i in range(300)]
    rows += [(400 + i, rows[0][1]) for i in range(60)]
    rows += [(500, None), (501, [1.0, None] + [0.0] * 7), (502, [math.nan] * 9), (503, [math.inf] * 9), (504, []),
             (506, [0.5, 0.25]), (None, rows[0][1]), (507, rows[1][1]), (507, rows[1][1])]
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id long, embedding array<double>, rank int, score long, shard int")
    got = Counter(map(tuple, maxscore.search(frame, 10, 20).collect()))
    assert got == plain_top(rows, 10, 20)
    few = rows[:5]
    assert Counter(map(tuple, maxscore.search(frame.filter("vec_id < 5"), 2, 20).collect())) == plain_top(few, 2, 20)
    assert maxscore.search(frame.limit(0)).collect() == []


def products(x, q, k=20, shard=maxscore.SHARD_ROWS):
    """Products of components made for all pairs, as a share of those of brute force."""
    made = []
    for at in range(0, len(x), shard):
        part = x[at:at + shard]
        ids = np.arange(at, at + len(part))
        maxscore.top_of_shard(ids, part, np.arange(len(q)) - len(q), q, k, made)
    return sum(made) / (len(x) * len(q) * x.shape[1])


def test_bounds_save_products_where_they_can():
    """Few large components decide: most vectors are left after the essential terms."""
    rng = np.random.default_rng(5)
    scale = 64 * 0.7 ** np.arange(64)
    x = np.floor(rng.standard_normal((20_000, 64)) * scale).astype(np.float64)
    assert products(x, x[::100]) < 0.6
    centres = rng.standard_normal((40, 64)) * scale
    clustered = np.floor(centres[rng.integers(0, 40, 20_000)] + rng.standard_normal((20_000, 64)) * 0.1 * scale)
    assert products(clustered, clustered[::100]) < 0.6


def test_no_product_is_made_twice():
    rng = np.random.default_rng(6)
    x = np.floor(rng.standard_normal((6000, 32)) * 64)
    assert products(x, x[::50]) <= 1.0


def plain_katz(rows):
    def tokens(t):
        return (t or "").encode().lower().split() + [0]
    held = {d: zlib.crc32(str("" if d is None else d).encode()) % 5 == 1 for d, _ in rows}
    one, two = Counter(), Counter()
    for d, t in rows:
        if not held[d]:
            w = tokens(t)
            one.update(w)
            two.update(zip([1, *w], w, strict=False))
    n = sum(one.values())

    def factor(counts):
        of = Counter(counts.values())
        return katz.discounts([of[r] for r in range(1, 7)])
    d1, d2 = factor(one), factor(two)
    f = lambda d, c: d[min(c, len(d) - 1)]
    under = n if min(one.values()) <= 5 else n + 1
    unknown = 1 - sum(f(d1, c) * c for c in one.values()) / under
    p1 = lambda w: f(d1, one[w]) * one[w] / under if one[w] else unknown
    after = {}
    for (v, w), c in two.items():
        after.setdefault(v, {})[w] = c

    def p2(v, w):
        seen = after.get(v)
        if not seen:
            return p1(w)
        total, kept = sum(seen.values()), sum(f(d2, c) * c for c in seen.values())
        under = total + 1 if total - kept < 1e-9 * total else total
        if w in seen:
            return f(d2, seen[w]) * seen[w] / under
        return (1 - kept / under) / (1 - sum(map(p1, seen))) * p1(w)
    for v in list(after)[:40] + ["never"]:
        assert sum(p2(v, w) for w in one) + p2(v, "never") == pytest.approx(1)
    out = {}
    for d, t in rows:
        w = tokens(t)
        base = sum(math.log10((one[x] + 0.5) / (n + 0.5 * (len(one) + 1))) for x in w)
        out[d, len(w)] = (held[d], sum(one[x] > 0 for x in w), n, base, sum(math.log10(p2(v, x)) for v, x in zip([1, *w], w, strict=False)))
    return out


@pytest.mark.parametrize("size", [12, 150])
def test_backoff(docs, size):
    rng = random.Random(size)
    vocabulary = ["w%d" % int(rng.paretovariate(0.7)) for _ in range(300)] + ["É", "A", "b"]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30)))) for i in range(size)]
    rows += [(1000, None), (1001, " "), (1002, "the of " * 4000), (None, "no id"), (5, rows[5][1]), (5, rows[5][1])]
    want = plain_katz(rows)
    for part in (500, katz.PART_BYTES):
        got = katz.score_documents(docs(rows), batch_bytes=2000, part_bytes=part).collect()
        assert len(got) == len(rows)
        for r in got:
            held, known, n, base, score = want[r.doc_id, r.n_tokens]
            assert (r.held_out, r.n_known, r.train_tokens) == (held, known, n)
            assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)
    assert katz.score_documents(docs([])).collect() == []


def good_turing(of):
    """Katz's discounts up to 5 from a line through log n_r, written out step by step."""
    seen = [r for r in range(1, 7) if of[r]]
    x, y = [], []
    for i, r in enumerate(seen):
        below = seen[i - 1] if i else 0
        above = seen[i + 1] if i + 1 < len(seen) else 2 * r - below
        x.append(math.log(r))
        y.append(math.log(of[r] / (0.5 * (above - below))))
    line = statistics.linear_regression(x, y)
    smooth = {r: math.exp(line.intercept + line.slope * math.log(r)) for r in range(1, 7)}
    lost = 6 * smooth[6] / smooth[1]
    star = {r: (r + 1) * smooth[r + 1] / smooth[r] for r in range(1, 6)}
    return [0.0, *((star[r] / r - lost) / (1 - lost) for r in range(1, 6)), 1.0]


def test_copies_leave_good_turing():
    # Doubled documents: no odd count but of new words, and more things seen twice than once.
    for of in ([900, 1000, 0, 300, 0, 90], [0, 500, 0, 120, 0, 50], [100, 10, 10, 60, 5, 5]):
        d = katz.discounts(of)
        assert d.tolist() == pytest.approx(good_turing(dict(enumerate(of, 1))))
        assert 0 < d[1] and (np.diff(d[1:]) > 0).all()
    # No line falls faster than 1 / r: nothing to discount by Good-Turing.
    for of in ([0] * 6, [7, 0, 0, 0, 0, 0], [10, 10, 10, 10, 10, 10]):
        d = katz.discounts(of)
        assert (0 < d[1:6]).all() and (d[1:6] < 1).all()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_backoff_is_good_turing_on_given_tables(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    words, pairs, train, held = Counter(), Counter(), 0, []
    for i, text in table.collect():
        w = (text or "").encode().lower().split() + [0]
        two = list(zip([1, *w], w, strict=False))
        if zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1:
            held.append((i, two))
        else:
            words.update(w)
            pairs.update(two)
            train += len(w)
    of = [Counter(c.values()) for c in (words, pairs)]
    assert [[n[r] for r in range(1, 7)] for n in of] == [
        [47735, 12166, 4990, 2407, 2203, 1012], [184712, 23127, 5984, 1951, 2262, 607]]
    d1, d2 = map(good_turing, of)
    one = {w: d1[min(c, 6)] * c / train for w, c in words.items()}
    unknown = 1 - sum(one.values())
    kept, left, lower = Counter(), Counter(), Counter()
    for (v, w), c in pairs.items():
        kept[v] += c
        left[v] += (1 - d2[min(c, 6)]) * c
        lower[v] += one[w]
    plain = {}
    for i, two in held:
        p = []
        for v, w in two:
            if (v, w) in pairs:
                c = pairs[v, w]
                # All of a head's pairs above 5: one more count leaves a share.
                p.append(d2[min(c, 6)] * c / (kept[v] + (left[v] < 1e-9 * kept[v])))
            elif kept[v]:
                share = left[v] / kept[v] if left[v] >= 1e-9 * kept[v] else 1 / (kept[v] + 1)
                p.append(share / (1 - lower[v]) * one.get(w, unknown))
            else:
                p.append(one.get(w, unknown))
        plain[i, len(two)] = sum(map(math.log10, p))
    got = katz.score_documents(table).filter("held_out").collect()
    assert len(got) == len(held)
    assert all(r.score == pytest.approx(plain[r.doc_id, r.n_tokens]) for r in got)
