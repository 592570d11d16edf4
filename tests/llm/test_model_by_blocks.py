"""A language model above the bound of a broadcast stays in its blocks, and the texts are not read once per part of it."""

import random

import numpy as np

from wardflow.llm import bloom_lm


def test_large_model_is_asked_and_not_sent(spark, monkeypatch):
    r = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(r.choices(words[: r.choice([5, 200, 3000])], k=r.randint(0, 300))) for _ in range(300)]
    rows = [(i % 280, t, {"n": i}) for i, t in enumerate([*texts, texts[0], None, "", "never seen before", "the end " * 20_000])]
    docs = spark.createDataFrame(rows, "doc_id int, text string, extra struct<n int>").repartition(3, "doc_id")
    train = docs.where("doc_id % 10 <> 0")
    monkeypatch.setattr(bloom_lm, "BLOCK_BYTES", 1 << 14)
    model = bloom_lm.build(train)
    monkeypatch.setattr(bloom_lm, "build", lambda train: model)
    key = lambda x: (x.doc_id, x.extra.n)
    want = {key(x): x for x in bloom_lm.score_texts(docs, train, ["doc_id", "extra"]).collect()}
    monkeypatch.setattr(bloom_lm, "SHARD_BYTES", 1 << 12)
    monkeypatch.setattr(bloom_lm, "TEXT_BYTES", 1 << 15)
    monkeypatch.setattr(bloom_lm, "read_blocks", None)  # it would bring blocks to the driver
    small = {"spark.sql.files.maxRecordsPerFile": "7", "spark.sql.files.openCostInBytes": "1000000000"}  # rows of a chunk lie in several tasks
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    d = bloom_lm.score_texts(docs, train, ["doc_id", "extra"])
    got = {key(x): x for x in d.collect()}
    for k, v in before.items():
        spark.conf.set(k, v)
    assert got.keys() == want.keys() and len(got) == len(rows)
    for k, a in want.items():
        assert got[k][:5] == a[:5]
        assert np.allclose(got[k][5:], a[5:], rtol=1e-9)


def test_chunks_are_runs_of_rows(spark):
    texts = ["a" * 30] * 7 + ["b" * 500, None, "c"]
    d = spark.createDataFrame([(t,) for t in texts], "__text string").coalesce(1).mapInArrow(bloom_lm._chunks(100), "__text string, __chunk long, __row long")
    rows = sorted(d.collect(), key=lambda x: x["__row"])
    assert [x["__chunk"] for x in rows] == [0, 0, 0, 0, 1, 1, 1, 2, 7, 7] and [x["__row"] for x in rows] == list(range(10))
