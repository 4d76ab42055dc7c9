import random

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_small import DOCS, brute_components, prose


def test_stages(spark, tmp_path):
    rng = random.Random(11)
    base, passage = prose(rng, 200), prose(rng, 70)
    near = base.split()
    near[50] = "other"
    rows = [
        (0, base, "en", "s", 1), (1, " ".join(near), "en", "s", 1), (2, base, "en", "s", 1), (3, None, "en", "s", 1), (4, "12 34 !", "en", "s", 1), (5, "First " + prose(rng, 60) + " é" + passage, "en", "s", 1),
        (6, passage + " then " + prose(rng, 60), None, "s", 1), (7, "write to joe@example.com now", "en", "s", 1), (8, prose(rng, 90), "en", "s", 1), (8, rng.random().hex() + " clean words", "en", "s", 1), (9, prose(rng, 40_000), "en", "s", 1),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    for name in ("th", "key", "__found", "__lang", "__r1", "__spans", "Node"):
        docs = docs.withColumn(name, F.lit("own"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.columns == docs.columns and out.where("th <> 'own' OR __found <> 'own' OR __lang <> 'own' OR __r1 <> 'own' OR `key` <> 'own'").count() == 0
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        got = {(r["doc_id"], r["text"]) for r in docs.collect()} if k < 4 else docs.collect()
        if name == "language_id":
            assert got == {(i, t) for i, t, *_ in rows if i not in (3, 4)} and docs.where("lang IS NULL").count() == 0
        if name == "near_dedup":
            texts = [(r["doc_id"], r["text"]) for r in before.collect()]
            assert len(got) == len({c for _, _, c in brute_components(texts, 5, 80)}) + 1  # two documents are named 8
            assert (0, base) in got and not {i for i, _ in got} & {1, 2}
        if name == "suffix_dedup":
            left = dict(got)
            assert passage not in left[5] and passage not in left[6] and left[0] == base and left[5].startswith("First ") and " then " in left[6]
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        if name == "pii":
            assert dict(got)[7] == "write to [EMAIL] now"
        if name == "packing":
            assert {r["doc_id"] for r in got} == {0, 5, 6, 7, 8, 9}
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, whole.collect())) == sorted(map(str, docs.collect()))


def test_empty(spark):
    docs = spark.createDataFrame([], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        assert out.count() == 0
        docs = out if name != "packing" else docs
