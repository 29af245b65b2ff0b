import random

from pyspark.sql import functions as F

import corpus_pipeline
from commerce_lake.llm import mixing, packing
from tests.conftest import SMALL


def shares(rows, docs, prefix):
    """Each source's share of the tokens in the first sequences."""
    source = {r.doc_id: r.source for r in docs}
    sums = {}
    for r in rows:
        if r.sequence_id < prefix:
            sums[source[r.doc_id]] = sums.get(source[r.doc_id], 0) + r.length
    return {s: n / sum(sums.values()) for s, n in sums.items()}


def test_sequences_follow_the_weights(spark, monkeypatch):
    rnd = random.Random(5)
    rows = [(i, s, " ".join(rnd.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(rnd.randint(200, 9000))))
            for i, s in enumerate(["a"] * 150 + ["b"] * 150)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").cache()
    plain = packing.pack_documents(docs, corpus_pipeline.TOKENIZER).collect()
    seen = []
    for a in (0.8, 0.2):
        weights = spark.createDataFrame([("a", a), ("b", 1 - a)], "source string, weight double")
        monkeypatch.setattr(corpus_pipeline, "WEIGHTS", lambda d, w=weights: w)
        mixed = corpus_pipeline.source_mix(spark, docs, SMALL)
        got = corpus_pipeline.pack(spark, mixed, SMALL).collect()
        assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in plain)
        ids = {r.sequence_id for r in got}
        assert ids == set(range(len(ids))) and len(ids) == len({r.sequence_id for r in plain})
        used = {}
        for r in sorted(got, key=lambda r: r.offset):
            assert r.offset == used.get(r.sequence_id, 0)
            used[r.sequence_id] = r.offset + r.length
        assert max(used.values()) <= 1024
        for part in (4, 3, 2):  # before the heavier source runs out
            assert abs(shares(got, rows_of(docs), len(ids) // part)["a"] - a) < 0.1
        seen.append(sorted((r.doc_id, r.piece, r.sequence_id) for r in got))
    assert seen[0] != seen[1]
    assert corpus_pipeline.pack(spark, docs.where(F.lit(False)), SMALL).count() == 0


def rows_of(docs):
    return docs.select("doc_id", "source").collect()
