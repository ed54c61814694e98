"""Language and toxicity: hand-made cases, and accuracy on rows that were held out."""

import math
import os
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import language, toxicity

SF = "/root/testdata/sf0.1"
given = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_filter_returns_all_languages_of_a_gram():
    rng = np.random.default_rng(1)
    names = [f"l{i:02d}" for i in range(70)]  # more than one word of bits
    members = {n: rng.integers(1, 1 << 63, 50).astype(np.uint64) for n in names}
    members["l69"][:10] = members["l03"][:10]
    f = language.Filter.build(members, names)
    h = members["l03"]
    counts = f.counts(h, np.arange(50), 50)
    assert counts[:, 3].all() and counts[:10, 69].all()
    assert counts.sum() <= 50 + 10 + 50 * f.false_rates().sum() + 20
    assert (f.false_rates() < 0.05).all()


def test_grams_stop_at_boundaries():
    h, owner, lettered = language.grams(["Ab c1", "ab c!", "", "12", "ſé"])
    assert sorted(h[owner == 0]) == sorted(h[owner == 1])
    assert lettered.tolist() == [True, True, False, False, True]
    assert not set(owner.tolist()) & {2, 3}


def test_language_edge_cases(docs):
    rows = [(i, "the thing and that other thing " * 3, "en") for i in range(40)]
    rows += [(100 + i, "ñandú el niño y la niña " * 3, "es") for i in range(40)]
    rows += [(500, None, "en"), (501, "", None), (502, "12 !?", "es"), (503, "ΩΨ", None), (None, "the thing", None),
             (504, "that thing " * 20000, None), (505, "the", "en"), (505, "the", "en")]
    got = {r.doc_id: r for r in language.identify_languages(docs(rows)).collect()}
    assert {d: got[d].lang_pred for d in (0, 100, 500, 501, 502, None, 504)} == {
        0: "en", 100: "es", 500: "und", 501: "und", 502: "und", None: "en", 504: "en"}
    assert got[503].score == 0 and got[500].score == 0 and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items() if d is not None)
    assert language.identify_languages(docs([])).collect() == []
    assert {r.lang_pred for r in language.identify_languages(docs([(1, "a b"), (2, None)])).collect()} == {"und"}


@given
def test_language_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language.identify_languages(docs).join(docs, "doc_id").filter("held_out and lang is not null")
    right, n = got.selectExpr("sum(int(lang = lang_pred))", "count(*)").first()
    assert right > 0.97 * n


def test_folding():
    assert toxicity.fold("Stуpid, 1d10T!  trа$h_x\n") == " stypid idiot trash x "


def labelled(spark):
    rng = random.Random(3)
    plain = ["".join(rng.choice("bcdfglmnr") + rng.choice("aou") for _ in range(3)) for _ in range(400)]
    rows, marks = [], []
    for i in range(900):
        w = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        if i % 5 == 0:
            w.insert(rng.randrange(len(w)), rng.choice(["idiot", "1diot", "scum", "scums"]))
        elif i % 7 == 0:
            w.insert(rng.randrange(1, len(w)), "pond scum")
        rows.append((i, " ".join(w)))
        marks.append((i, 0, int(i % 5 == 0)))
    marks += [(None, 0, 1), (3, 1, None), (99999, 0, 1), (0, 0, 1)]
    return rows, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_toxicity_edge_cases(docs, spark):
    rows, labels = labelled(spark)
    rows += [(2000, None), (2001, ""), (2002, "you IDIОT"), (2003, "in the pond scum grows"), (2004, "a scum"),
             (2005, "quiet " * 30000), (None, "idiot"), (2006, "idiot"), (2006, "idiot")]
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs(rows), labels).collect()}
    assert [got[d].predicted for d in (2000, 2001, 2002, 2003, 2004, 2005, None, 2006)] == [0, 0, 1, 0, 1, 0, 1, 1]
    wrong = sum(got[i].predicted != (i % 5 == 0) for i in range(900))
    assert wrong <= 9
    assert all(0 <= r.score <= 1 for r in got.values())
    assert toxicity.score_toxicity(docs([]), labels).collect() == []
    empty = labels.limit(0)
    assert {r.predicted for r in toxicity.score_toxicity(docs(rows[:5]), empty).collect()} == {0}


@given
def test_toxicity_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").filter("held_out")
    hit, toxic, false, clean = got.selectExpr(
        "sum(toxic * predicted)", "sum(toxic)", "sum((1 - toxic) * predicted)", "sum(1 - toxic)").first()
    assert hit > 0.9 * toxic and false < 0.01 * clean


def alone(spark, docs, n, toxic, clean_words, toxic_words):
    """``n`` documents of plain words, the first ``toxic`` of every part with a toxic word."""
    rng = random.Random(n)
    plain = ["".join(rng.choice("bcdfglmnr") + rng.choice("aou") for _ in range(3)) for _ in range(600)]
    rows, marks = [], []
    for i in range(n):
        w = [rng.choice(plain) for _ in range(rng.randint(8, 40))]
        w.insert(rng.randrange(1, len(w)), rng.choice(toxic_words if toxic(i) else clean_words))
        rows.append((i, " ".join(w)))
        marks.append((i, 0, int(toxic(i))))
    return rows, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def caught(docs, rows, labels, toxic):
    got = {r.doc_id: r.predicted for r in toxicity.score_toxicity(docs(rows), labels).collect()}
    return sum(got[i] for i, _ in rows if toxic(i)), sum(got[i] for i, _ in rows if not toxic(i))


def test_short_words_are_entries(docs, spark):
    toxic = lambda i: i % 5 == 0
    rows, labels = alone(spark, docs, 3000, toxic, ["mild"], ["ugh"])
    assert caught(docs, rows, labels, toxic) == (600, 0)


def test_a_word_whose_clean_documents_are_one_phrase(docs, spark):
    toxic = lambda i: i % 15 == 0
    rows, labels = alone(spark, docs, 1500, toxic, ["pond scum"], ["scum"])
    assert caught(docs, rows, labels, toxic) == (100, 0)


def test_matching_is_linear_and_exact():
    lexicon = toxicity.Lexicon({" scum": 3.0, " scumb": 4.0, " ugh ": 2.5}, (" pond scum ", " scum pond "))
    matcher = lexicon.matcher()
    start = time.perf_counter()
    assert toxicity.hits(toxicity.fold("pond scum " * 200_000), matcher) == []
    assert len(toxicity.hits(toxicity.fold("scum " * 200_000), matcher)) == 200_000
    assert time.perf_counter() - start < 20


def plain_strength(text, lexicon):
    """Every entry and exception tried at every word."""
    folded = toxicity.fold(text)
    free = [(i, i + len(p) - 1) for p in lexicon.exceptions
            for i in range(len(folded)) if folded.startswith(p, i)]
    total = 0.0
    for i, c in enumerate(folded):
        found = [w for k, w in lexicon.weights.items() if c == " " and folded.startswith(k, i)]
        if found and not any(a <= i < b for a, b in free):
            total += max(found)
    return total / (1 + math.log1p(folded.count(" ") / 100)) if total else 0.0


def test_scores_are_those_of_a_plain_search(docs, spark):
    rows, labels = labelled(spark)
    rng = random.Random(8)
    rows += [(5000 + i, " ".join(rng.choice(["pond", "scum", "scums", "idiot", "1diot", "x", "pond scum"])
                                 for _ in range(rng.randint(0, 30)))) for i in range(60)]
    lexicon = toxicity.learn_from(docs(rows), labels)
    assert lexicon.weights and lexicon.exceptions
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs(rows), labels).collect()}
    for i, text in rows:
        assert abs(got[i] - lexicon.score(plain_strength(text, lexicon))) < 1e-9


def test_toxicity_stage_on_odd_tables(docs, spark):
    rows, labels = labelled(spark)
    rows += [(None, None), (7000, None), (7001, ""), (7002, "you idiot"), (7002, "you idiot")]
    made = docs(rows).withColumn("toxic", F.lit(1)).withColumn("m", F.create_map(F.lit("a"), F.lit(1)))
    kept = toxicity.drop_toxic(made, labels)
    assert kept.columns == made.columns
    left = [r.doc_id for r in kept.collect()]
    assert {None, 7000, 7001} <= set(left) and 7002 not in left
    assert toxicity.drop_toxic(made.limit(0), labels).collect() == []
    assert toxicity.drop_toxic(made, labels.limit(0)).count() == len(rows)


@pytest.mark.parametrize("text", ["ab", "Ab c1", "", "x", "ΑΣ word ñandú " * 9, "字" * 40, " a  b ", "one two, three! " * 30])
def test_long_texts_have_the_same_grams(text):
    want, _, lettered = language.grams([text])
    for size in (1, 2, 3, 7, 64, 10**6):
        parts = list(language.long_grams(text, size))
        assert sorted(np.concatenate([h for h, _ in parts])) == sorted(want)
        assert any(x for _, x in parts) == lettered[0]


def test_memory_of_a_long_text():
    import tracemalloc
    text = "the thing and that other thing " * (20_000_000 // 31)
    language._letters()
    tracemalloc.start()
    assert sum(len(h) for h, _ in language.long_grams(text)) > 20_000_000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200_000_000


def test_languages_of_long_texts(docs, monkeypatch):
    rows = [(i, "the thing and that other thing " * 3, "en") for i in range(40)]
    rows += [(100 + i, "ñandú el niño y la niña " * 3, "es") for i in range(40)]
    rows += [(200 + i, "the thing that " * 50_000, "en") for i in range(3)]
    rows += [(500, "that thing " * 90_000, None), (501, "niño niña " * 90_000, None), (502, "1 " * 600_000, None)]
    got = {r.doc_id: r.lang_pred for r in language.identify_languages(docs(rows)).collect()}
    assert (got[500], got[501], got[502]) == ("en", "es", "und")


def test_language_scores_are_those_of_sets(docs):
    """The same scores from plain sets of n-grams, when no filter answers falsely."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["the", "thing", "that", "ñandú", "niño"][:3] if i % 2 else ["ñandú", "niño", "el"])
                         for _ in range(12)), "en" if i % 2 else "es") for i in range(200)]
    model = language.learn(docs(rows))
    sets = {lang: set() for lang in model.languages}
    h, owner, _ = language.grams([t for _, t, _ in rows])
    counts = {lang: {} for lang in model.languages}
    for gram, i in zip(h.tolist(), owner.tolist()):
        c = counts[rows[i][2]]
        c[gram] = c.get(gram, 0) + 1
    rate = lambda lang, g: counts[lang].get(g, 0) / sum(counts[lang].values())
    for lang, c in counts.items():
        for g, n in c.items():
            if n >= language.MIN_COUNT and rate(lang, g) >= language.KEEP * max(rate(x, g) for x in counts):
                sets[lang].add(g)
    false = dict(zip(model.languages, model.false_rates()))
    got = {r.doc_id: r for r in language.predict(docs(rows), model).collect()}
    for (i, text, _), seen in zip(rows, np.bincount(owner)):
        hs, _, _ = language.grams([text])
        left = {x: max(0, (sum(g in sets[x] for g in hs.tolist()) - seen * false[x]) / (1 - false[x])) for x in sets}
        best = max(sorted(left), key=lambda x: left[x])
        assert got[i].lang_pred == best
        assert abs(got[i].score - left[best] / sum(left.values())) < 0.02


def test_texts_of_the_sample_meet_their_labels_without_a_shuffle(docs, spark, monkeypatch):
    seen, least_shingle = [], toxicity._least_shingle
    monkeypatch.setattr(toxicity, "_least_shingle", lambda some: seen.append(some) or least_shingle(some))
    rows = [(i, f"{'ugly scumbag' if i % 4 == 0 else 'kind words'} number {i}") for i in range(200)]
    rows += [(8, "scumbag again"), (None, "no id"), (7, None)]
    labels = spark.createDataFrame(
        [(i, int(i % 4 == 0)) for i in range(200)] + [(9, 1), (None, 1), (999, 1)], "doc_id long, toxic int")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lexicon = toxicity.learn_from(docs(rows), labels)
        plan = seen[0]._jdf.queryExecution().executedPlan().toString()
        kept = sorted((r.doc_id, r.text, r.toxic) for r in seen[0].collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert kept == sorted((i, t, int(i % 4 == 0 or i == 9)) for i, t in rows
                          if None not in (i, t) and zlib.crc32(str(i).encode()) % 5)
    assert " scumbag" in lexicon.weights or any(" scumbag".startswith(k) for k in lexicon.weights)
