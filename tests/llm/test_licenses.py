"""The license scan against a plain search of each text."""

import math
import os
import random
import re

import pytest

from tidewatch.llm import licenses as L

SF = "/root/testdata/sf0.01"
given = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def places(ws, phrase):
    p = phrase.split()
    return [i for i in range(len(ws)) if ws[i:i + len(p)] == p]


def plain(texts):
    """Result rows without the id, by trying every template at every shift."""
    docs = [words(t) for t in texts]
    n = len(docs)
    df = {}
    for ws in docs:
        for w in set(ws):
            df[w] = df.get(w, 0) + 1
    idf = lambda w: math.log(1 + (n + 1) / (df.get(w, 0) + 1))
    out = []
    for ws in docs:
        base = sorted((i, label) for p, label in L.BASE_PHRASES.items() for i in places(ws, p))
        labels, best = {x for _, x in base}, 0.5 if base else 0.0
        for t in L.TEMPLATES:
            own = words(t.text)
            index = sorted(set(own) - L.COMMON_WORDS, key=lambda w: (-idf(w), w))[:L.RARE]
            hits = [(i - j, w) for j, x in enumerate(own) for i, w in enumerate(ws) if w == x and w in index]
            told = [(i - places(own, p)[0], n) for n, p in enumerate(t.phrases) for i in places(ws, p)]
            for offset in (0, L.SLACK):
                tile = lambda d: (d + offset) // (2 * L.SLACK)
                for at in {tile(d) for d, _ in hits + told}:
                    share = sum(idf(w) for w in {w for d, w in hits if tile(d) == at}) / sum(map(idf, index))
                    complete = len({n for d, n in told if tile(d) == at}) == len(t.phrases)
                    if complete and share >= L.ALIGNED:
                        labels.add(t.label)
                        best = max(best, share)
                    else:
                        best = max(best, share / 2)
        begins = [i for i, _ in base]
        out.append((len(ws), len(base), min(begins, default=None), max(begins, default=None),
                    ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), round(best, 9)))
    return out


def result(made):
    got = L.scan_licenses(made)
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return sorted([(r[0], *r[1:7], round(r[7], 9)) for r in got.collect()], key=str)


def compare(docs, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    assert result(docs(rows)) == sorted([(i, *p) for i, p in enumerate(plain(texts))], key=str)


def notices():
    mit = L.TEMPLATES[1].text
    return [
        mit, mit.replace(" ", "\n * "), mit.upper(), mit.replace("hereby", "hereby and forthwith"),
        mit.replace("person", "person or any legal entity whatsoever it may be"), mit[:120],
        mit.replace("publish, distribute", "publish"), " ".join(reversed(mit.split())),
        "Released under the MIT License.", "MIT-License mit/license MIT  license", "mit licenses", "submit license",
        "Licensed under the Apache License, Version 2.0.", "Apache license", "the Apache License, Version 3.0",
        "This work is licensed under the GNU General Public License, version 3.", "general public license",
        "General Public MIT License Apache License", "Licensed under CC BY-NC 4.0.", "cc by 4 0", "CC 4.0 BY NC",
        *(t.text for t in L.TEMPLATES), "licenſe MIT Licenſe", "MIT Liсense", "Kit license", "apache license mit license " * 30,
        "", None, "  ", "\x00mit\x00license", "émit license", "a b c 2 0 version of the software", "4 0 " * 200]


def test_same_as_plain_search(docs):
    compare(docs, notices())


def test_notices_inside_other_texts(docs):
    rng = random.Random(5)
    filler = [f"w{i}" for i in range(200)] + ["license", "version", "software", "2", "0", "cc", "the", "of"]
    texts = []
    for notice in [n for n in notices() if n] * 2:
        a, b = ([rng.choice(filler) for _ in range(rng.randrange(60))] for _ in range(2))
        texts.append(" ".join([*a, notice, *b]))
    texts += [" ".join(rng.choice(filler) for _ in range(80)) for _ in range(60)]
    compare(docs, texts)


def test_labels(docs):
    got = {r[0]: r for r in result(docs([(i, t) for i, t in enumerate(
        [t.text for t in L.TEMPLATES] + ["nothing of the kind is said here"] * 50)]))}
    for i, t in enumerate(L.TEMPLATES):
        assert t.label in got[i][6].split(","), t
    assert {got[i][6] for i in range(len(L.TEMPLATES), len(got))} == {""}


def test_long_repeated_and_null_rows(docs):
    long = "license version " * 200_000 + "Released under the MIT License " + "word " * 200_000
    rows = [(1, long), (2, "mit license"), (2, "mit license"), (2, "other"), (None, "mit license"), (None, None)]
    got = result(docs(rows))
    assert [r for r in got if r[0] == 1] == [(1, 600_005 - 0, 1, 400_003, 400_003, "mit", "mit", 1.0)]
    assert [r[1:7] for r in got if r[0] == 2] == [(1, 0, None, None, "", "")] + [(2, 1, 0, 0, "mit", "mit")] * 2
    assert sorted(r[6] for r in got if r[0] is None) == ["", "mit"]


def test_empty_table(docs):
    assert result(docs([])) == []


@given
def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = sorted((tuple(r) for r in docs.collect()), key=str)
    compared = plain([t for _, t in rows])
    assert result(docs) == sorted([(i, *p) for (i, _), p in zip(rows, compared)], key=str)
    assert any("cc-by-nc-4.0" in p[5] for p in compared)


def test_no_python_in_the_plan(docs):
    plan = L.scan_licenses(docs([(1, "mit license")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan
