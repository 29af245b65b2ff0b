import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from commerce_lake.llm import lm
from tests.conftest import MEDIUM


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def brute(rows):
    counts = Counter()
    for i, t in rows:
        if not held(i):
            counts.update([*(t or "").encode().lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        tokens = [*(t or "").encode().lower().split(), None]
        out.append((str(i), held(i), len(tokens), sum(counts[w] > 0 for w in tokens), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens), 6)))
    return sorted(out)


def test_counts_and_better_than_the_base(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    # a small lexicon: most words go through the join
    out = lm.score_documents(docs, n_words=200, lexicon=500, batch=1024).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == brute(rows)
    mine = [(r.score, r.base_score, r.n_tokens) for r in out if r.held_out]
    assert sum(m[0] for m in mine) > sum(m[1] for m in mine)


def test_normalised():
    model = lm.Model([b"a", b"b", b"cc."], np.array([5, 3, 1]), 4, 13, 4, np.zeros(32, int), np.zeros(32, int), 2, 8)
    s = lm.shape(b"cc.")
    model.shape_n[s], model.shape_v[s] = 1, 1
    rng = np.random.default_rng(0)
    model.params = {k: rng.standard_normal((model.classes, 8)).astype(np.float32) for k in ("e1", "e2", "q")} | {"b": rng.standard_normal(model.classes).astype(np.float32)}
    every = np.arange(model.classes, dtype=np.int32)
    for one, two in ((0, 0), (1, 2), (5, 34)):
        p = np.exp(lm.Scorer(model)(np.full_like(every, one), np.full_like(every, two), every))
        assert abs(p.sum() - 1) < 1e-4


def test_edge_cases(spark):
    rows = [(1, "A b a"), (2, None), (3, ""), (4, "b b\tb"), (4, "b b\tb"), (None, "c"), (5, "É  x y"), (6, "z" * 3000)] + [(i, "a b c") for i in range(20, 40)]
    docs = spark.createDataFrame([(*r, 0.0) for r in rows], "doc_id long, text string, score double")
    out = lm.score_documents(docs, n_words=2, lexicon=3, batch=64).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == brute(rows)
    assert all(r.score < 0 for r in out)
    assert lm.score_documents(docs.where(F.lit(False))).count() == 0
    only = [r for r in rows if held(r[0])][:1]
    alone = lm.score_documents(spark.createDataFrame([(*r, 0.0) for r in only], docs.schema)).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in alone] == [(0, 0, 0.0)]


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm, "LANE_TOKENS", 4000)
    rnd = random.Random(8)
    rows = [(i, " ".join(rnd.choice("the a cat dog sat on mat ran to of".split()) for _ in range(rnd.randint(0, 200)))) for i in range(150)]
    docs = spark.createDataFrame(rows + rows[:5], "doc_id long, text string")
    got = [sorted((r.doc_id, r.score) for r in lm.score_documents(docs.repartition(n), n_words=8, dim=6, batch=256).collect()) for n in (1, 5)]
    assert [i for i, _ in got[0]] == [i for i, _ in got[1]]
    assert max(abs(a - b) / abs(a) for (_, a), (_, b) in zip(*got)) < 1e-5


def test_lexicon_of_words_with_equal_counts(spark):
    docs = spark.createDataFrame([(i, f"w{i} v{i}") for i in range(300)], "doc_id long, text string")
    model, _ = lm.gather(docs, 50, 100, 4)
    assert 60 < len(model.lexicon) < 140 and model.n_words == 50
    model, _ = lm.gather(docs, 50, 600, 4)
    assert len(model.lexicon) == 600


def test_words_of_many_texts_at_once():
    rnd = random.Random(6)
    parts = ["a", "B", "É", "é", "7", ".", ",", " ", " ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x85", "\xa0", "漢", "word", "LongerWord"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 30))) if rnd.random() < 0.9 else None for _ in range(500)]
    expected = [(t or "").encode().lower().split() for t in texts]
    words, number, before = lm.words_of(pa.array(["x", *texts]).slice(1))
    distinct = words.to_pylist()
    assert [[distinct[i] for i in number[a:b]] for a, b in zip(before, before[1:])] == expected
    assert len(distinct) == len(set(distinct))

    def of(word):
        last, size = word[-1], len(word)
        end = 0 if last >= 128 or 97 <= last <= 122 else 1 if last == 46 else 2 if last == 44 else 3
        return end * 8 + (0 if size <= 4 else 1 if size <= 8 else 2 if size <= 12 else 3) * 2 + (not word.isascii())

    assert lm.shapes(words).tolist() == [of(w) for w in distinct]
    model = lm.Model(distinct[:20], np.arange(20, 0, -1), 4, 500, 90, np.zeros(32, int), np.zeros(32, int), 8, 4)
    places = model.indexer().positions(words)
    tokens, starts = lm.with_ends(model.indexer().classes(words, places)[number], before)
    one, two = lm.contexts(tokens, starts)
    at = {w: 1 + i for i, w in enumerate(distinct[:8])}
    for text, a, b in zip(expected, starts, starts[1:]):
        mine = [*(at.get(w) or 9 + of(w) for w in text), 0]
        assert tokens[a:b].tolist() == mine
        assert one[a:b].tolist() == [0, *mine[:-1]] and two[a:b].tolist() == [0, 0, *mine[:-2]][:len(mine)]
    asked = []
    index = model.indexer()
    index.index = type("Asked", (dict,), {"get": lambda self, w, d: asked.append(w) or d})()
    index.positions(lm.words_of(pa.array(["a b a b"] * 100))[0])
    assert asked == [b"a", b"b"]  # distinct words only
