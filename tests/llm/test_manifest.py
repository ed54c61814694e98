"""The Merkle manifest against a plain tree of lists."""

import random
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import manifest

def third():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(row, fold=False):
    doc_id, text, lang, source, n_chars = row
    if fold and text is not None:
        text = text.encode().lower().decode()
    fields = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return h("".join(fields))


def climb(nodes):
    """The root, and each leaf's siblings (left, right) on its way."""
    ways = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for way, i in zip(ways, range(len(at))):
            j = at[i]
            first = j // 8 * 8
            way.append(("".join(nodes[first:j]), "".join(nodes[j + 1:first + 8])))
            at[i] = j // 8
        nodes = [h("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], ways


def plain(rows):
    """Sorted rows of the result, from (doc_id, text, lang, source, n_chars)."""
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    found = {}
    for lang in langs:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        found[lang] = climb([leaf(r) for r in trees[lang]])
    root, tops = climb([found[lang][0] for lang in langs]) if langs else (None, [])
    out = []
    for lang, above in zip(langs, tops):
        subroot, ways = found[lang]
        for r, way in zip(trees[lang], ways):
            hit = r[0] is not None and crc32(str(r[0]).encode()) % 3 == 0
            folded = leaf(r, hit)
            for a, b in way + above:
                folded = h(a + folded + b)
            proof = h("".join(a + b for a, b in way + above))
            out.append((r[0], leaf(r), subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def result(docs, rows, depth):
    made = docs([(r[0], r[1], r[2], r[3]) for r in rows])
    got = manifest.manifest(made, tampered=third(), depth=depth)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def row(doc_id, text, lang="en", source="s"):
    return doc_id, text, lang, source, None if text is None else len(text)


def mixed(n):
    rng = random.Random(n)
    return [row(i, rng.choice(["Aa bé", "low", "", None, "X" * 50, f"t{i}"]),
                rng.choice(["en", "en", "en", "en", "dé", "de", "", None, f"l{i % 3}"]),
                rng.choice(["s1", None, ""])) for i in range(n)]


@pytest.mark.parametrize("n, depth", [(1, 1), (2, 3), (9, 1), (150, 1), (700, 2), (700, 3)])
def test_same_as_plain_tree(docs, n, depth):
    rows = mixed(n)
    assert result(docs, rows, depth) == plain(rows)


def test_one_language_whose_last_runs_are_single_nodes(docs):
    rows = [row(i, f"Text {i}") for i in range(8 * 8 + 1)]
    got = result(docs, rows, 1)
    assert got == plain(rows)
    assert len({r[2] for r in got}) == 1 and all(r[2] == r[3] for r in got)


def test_nulls_ties_and_repeated_rows(docs):
    rows = [row(None, None, None, None)] * 3 + [row(None, "A")] * 12 + [row(5, "Same", "en")] * 30 + [
        row(5, "Other", "en"), row(5, None, "en"), row(6, "", "en")]
    assert result(docs, rows, 1) == plain(rows)


def test_tampering_is_found_where_letters_change(docs):
    rows = [row(i, "UPPER" if i % 2 else "lower") for i in range(60)]
    for r in result(docs, rows, 1):
        assert r[6] == (not (crc32(str(r[0]).encode()) % 3 == 0 and r[0] % 2))


def test_nothing_is_tampered_by_default(docs):
    got = manifest.manifest(docs([(i, "UP") for i in range(20)]))
    assert got.filter("verified").count() == 20


def test_single_row_and_long_text(docs):
    (one,) = result(docs, [row(3, "Ä" * 2_000_000)], 3)
    assert one[1] == one[2] == one[3] and one[4] == h("")
    assert [one] == plain([row(3, "Ä" * 2_000_000)])


def test_empty_table(docs):
    assert result(docs, [], 3) == []


def test_a_field_cannot_pass_for_another(docs):
    got = result(docs, [row(1, "b", "en", "a"), row(1, "", "en", "a1:b"), row(1, None, "en", "a")], 1)
    assert len({r[1] for r in got}) == 3
