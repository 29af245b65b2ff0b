import random

import numpy as np
from pyspark.sql import functions as F

from commerce_lake.llm import ann
from tests.conftest import MEDIUM


def brute(rows, is_query, k=10):
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    out = {}
    for i in np.flatnonzero(is_query(ids)):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{MEDIUM}/embeddings.parquet").collect()]
    want = brute(rows, lambda i: i % 20 == 0)
    got = found(ann.search(spark.read.parquet(f"{MEDIUM}/embeddings.parquet"), F.col("id") % 20 == 0))
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (10 * len(want)) >= 0.9
    x = dict(rows)
    for q, near in got.items():
        assert near == sorted(near, key=lambda t: (t[1], t[0]))
        for i, d in near:
            assert abs(d - np.sqrt(((np.array(x[q], float) - np.array(x[i], float)) ** 2).sum())) < 1e-12


def test_all_probed_is_exact_with_ties_and_copies(spark):
    rnd = random.Random(3)
    rows = [(i, [float(rnd.randrange(3)) for _ in range(6)]) for i in range(1, 400)]
    rows += [(i, [1.0] * 6) for i in range(400, 700)]
    rows = [r for r in rows if any(r[1])]
    odd = [(9000, None), (9001, [0.0] * 6), (9002, [1.0, None] + [1.0] * 4), (9003, [float("nan")] + [1.0] * 5), (9004, [float("inf")] * 6), (9005, [1.0, 2.0]), (None, [1.0] * 6), (rows[0])]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("list", F.lit("x"))
    want = brute(rows, lambda i: i % 100 == 0)
    got = found(ann.search(frame, F.col("id") % 100 == 0, lists=4, probes=4))
    assert {q: [(i, round(d, 9)) for i, d in v] for q, v in got.items()} == {q: [(i, round(d, 9)) for i, d in v] for q, v in want.items()}
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, 2.0])], frame.drop("list").schema)
    assert found(ann.search(few, F.col("id") % 100 == 0)) == {0: [(1, 0.0), (2, 2.0)]}
    assert ann.search(few.where(F.lit(False)), F.col("id") % 100 == 0).count() == 0


def test_recall_where_ids_follow_the_clusters(spark):
    rng = np.random.default_rng(5)
    dims, tight = 32, 1500
    centres = rng.standard_normal((15, dims)) * 3
    clustered = centres[np.arange(tight) // 100] + 0.01 * rng.standard_normal((tight, dims))
    loose = rng.standard_normal((4500, dims))
    x = np.concatenate([clustered, loose])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(ann.search(frame, F.col("id") % 10 == 0))
    want = brute(rows, lambda i: i % 10 == 0)
    hit = {q: len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want}
    for c in range(15):
        assert np.mean([h for q, h in hit.items() if q < tight and q // 100 == c]) >= 0.9
    assert np.mean([h for q, h in hit.items() if q >= tight]) >= 0.9


def test_lengths_are_searched_apart(spark):
    rnd = random.Random(1)
    rows = [(i, [rnd.random() + 0.1 for _ in range(3 if i % 3 else 5)]) for i in range(90)] + [(300, [1.0, 2.0])]
    got = found(ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 10 == 0, lists=2, probes=2))
    for n in (3, 5):
        same = [r for r in rows if len(r[1]) == n]
        for q, near in brute(same, lambda i: i % 10 == 0).items():
            assert [i for i, _ in got[q]] == [i for i, _ in near]
    assert 300 not in got
