"""The pipeline's stages against plain versions."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import mixing, simhash, toxicity

from .test_copies import near_texts, plain_fingerprint, union

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_keep_one(docs):
    import random
    rng = random.Random(11)
    texts = near_texts(rng) + [None, ""]
    rows = [(5 * i, t) for i, t in enumerate(texts)]
    rows += [(None, texts[0]), (None, "a lone text"), (0, texts[0]), (3, "once more " * 9), (3, "once more " * 9),
             (10**6, "same id"), (10**6, "another text with the same id")]
    fp = [plain_fingerprint(t) for _, t in rows]
    root = union([(a, b) for a in set(fp) for b in set(fp) if a < b and (a ^ b).bit_count() <= 4], set(fp))
    best = {}
    for f, (d, _) in zip(fp, rows, strict=True):
        k = (d is None, d or 0)
        best[root[f]] = min(k, best.get(root[f], k))
    frame = docs(rows)
    got = simhash.keep_one(frame)
    assert got.columns == frame.columns
    assert Counter(r.doc_id for r in got.collect()) == Counter(None if n else d for n, d in best.values())
    assert simhash.keep_one(docs([])).collect() == []


def test_mix_repeats_rows(docs):
    rows = [(i, "w " * (1 + i % 7), "en", "abc"[min(2, i % 9)]) for i in range(200)] + [(500, "x y z", "en", "a")] * 40
    frame = docs(rows)
    want = Counter()
    for r in mixing.mix_documents(frame).collect():
        want[r.doc_id] += r.copies
    got = mixing.repeat_mixed(frame)
    assert got.columns == frame.columns
    got = Counter(r.doc_id for r in got.collect())
    assert {k: v for k, v in got.items() if k != 500} == {k: v for k, v in want.items() if k != 500 and v}
    assert abs(got[500] - want[500]) <= 1
    assert mixing.repeat_mixed(docs([])).collect() == []


CLASHING = ("mix_times", "n_rows", "n_taken", "mix_nth", "mix_key", "key", "row", "row_key", "times", "copies",
            "toxic", "component_id", "fp", "a.b", "first", "drawn", "whole", "u")


def odd_table(docs):
    """Nulls, empty and repeated rows, clashing names and a map."""
    rows = [(None, None, None, None)] * 3 + [(1, "", "en", "s"), (1, "", "en", "s"), (2, None, "en", "s")] + [
        (i, f"some words of text number {i} that is its own " * 3, "en", "st"[i % 2]) for i in range(10, 60)]
    made = docs(rows).withColumn("m", F.create_map(F.lit("a"), F.lit(1)))
    for i, c in enumerate(CLASHING):
        made = made.withColumn(c, F.lit(i))
    return made


def test_stages_keep_any_column(docs, spark, tmp_path):
    made = odd_table(docs)
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, made, str(tmp_path))
        assert got.columns == made.columns, name
        rows = got.collect()
        assert rows and all(r["m"] == {"a": 1} and [r[c] for c in CLASHING] == list(range(len(CLASHING)))
                            for r in rows), name
        assert {r.doc_id for r in rows} <= {r.doc_id for r in made.collect()}
        assert stage(spark, made.limit(0), str(tmp_path)).collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, made, str(tmp_path)).count() == made.count()


def test_empty_pipeline(spark, docs, tmp_path):
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    columns = docs.columns
    marks = {r.doc_id: r for r in toxicity.score_toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near copies", "decontamination", "mixing", "sharding"]
    seen = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
        got = docs.collect()
        assert all(r == rows[r.doc_id] for r in got)
        seen.append(Counter(r.doc_id for r in got))
    toxic, near, clean, mixed = seen
    assert set(toxic) == {d for d, m in marks.items() if not m.predicted}
    fp = {d: plain_fingerprint(rows[d].text) for d in toxic}
    values = set(fp.values())
    root = union([(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 4], values)
    least = {}
    for d in sorted(toxic):
        least.setdefault(root[fp[d]], d)
    assert set(near) == set(least.values())
    items = [r.text.lower().split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    holds = {d for d in near if any(" ".join(i) in " ".join(rows[d].text.lower().split()) for i in items)}
    assert set(clean) <= set(near) and not holds & set(clean)
    assert len(near) - len(clean) - len(holds) <= 0.05 * len(near)
    assert set(mixed) <= set(clean) and max(mixed.values()) <= 3
    final = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r.doc_id for r in final) == mixed
    for s in range(corpus_pipeline.SHARDS):
        slots = sorted(r.slot for r in final if r.shard == s)
        assert slots == list(range(len(slots)))
