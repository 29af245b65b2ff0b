import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from commerce_lake.llm import periodic, queries
from tests.conftest import SMALL


def brute(words, min_length=6, min_periods=4):
    n, out = len(words), []
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            run = words[i:j + q]
            if len(run) >= max(min_length, min_periods * q) and not any(
                    all(run[x] == run[x + p] for x in range(len(run) - p)) for p in range(1, q)):
                out.append((i, len(run), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def some_words(rnd):
    k = rnd.choice([1, 2, 2, 3, 5])
    words = [rnd.randrange(k) for _ in range(rnd.randint(0, 120))]
    for _ in range(rnd.randint(0, 3)):
        period = [rnd.randrange(k + 1) for _ in range(rnd.randint(1, 9))]
        at = rnd.randint(0, len(words))
        words[at:at] = (period * rnd.randint(3, 9))[:rnd.randint(1, 60)]
    return words


@pytest.mark.parametrize("v", sorted(periodic.COVERS))
def test_runs_equal_brute_force(v):
    rnd = random.Random(v)
    for _ in range(250):
        words = some_words(rnd)
        assert [tuple(r) for r in periodic.runs(np.array(words, np.int64), v=v).tolist()] == brute(words)


def test_other_limits_and_small_grids(monkeypatch):
    rnd = random.Random(4)
    monkeypatch.setattr(periodic, "GRID", 40)
    for _ in range(120):
        words = some_words(rnd)
        least, periods = rnd.randint(1, 20), rnd.randint(4, 6)
        assert [tuple(r) for r in periodic.runs(np.array(words, np.int64), least, periods).tolist()] == brute(words, least, periods)
    with pytest.raises(ValueError):
        periodic.runs(np.zeros(9, np.int64), min_periods=2)


def test_extensions_equal_comparison():
    rnd = np.random.default_rng(5)
    for v in periodic.COVERS:
        words = np.tile(rnd.integers(0, 2, 17), 12)
        words[rnd.integers(0, len(words), 6)] = 2
        n = len(words)
        i, j = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(n + 1)))
        i, j = i[i < j], j[i < j]
        want = [next((t for t in range(n - b) if words[a + t] != words[b + t]), n - b) for a, b in zip(i.tolist(), j.tolist())]
        assert periodic.Suffixes(words, v).extension(i, j).tolist() == want


def corpus():
    rnd = random.Random(7)
    rows = []
    for i in range(150):
        words = [f"w{x}" if x else "É\x1c" for x in some_words(rnd)]
        rows.append((i, rnd.choice([" ", "\n", " \t\r\x0b\x0c"]).join(words)))
    return rows + [(500, None), (501, ""), (502, " \n "), (503, "one"), (504, "a " * 40_000), (505, "x" * 200_000), (5, "b b b b b b"), (5, "b b b b b b"),
                   (None, "no id no id no id no id no id"), (506, "a b c d " * 3_000 + "a b x " * 2_000)]


def expected(rows, loops):
    out = []
    for doc_id, text in rows:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
        h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
        if loops and h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        found = [tuple(r) for r in periodic.runs(periodic.numbered([w.encode() for w in words])).tolist()] if n > 1000 else brute(words)
        out.append((doc_id, words, found))
    return out


def test_documents(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, runs string, collapsed int")
    got = periodic.find(docs).collect()
    assert sorted((str(r.doc_id), r.n_words, str([tuple(x) for x in r.runs]), r.collapsed) for r in got) == sorted(
        (str(i), len(w), str(f), " ".join(collapsed(w, f))) for i, w, f in expected(rows, loops=False))
    long = {r.doc_id: [tuple(x) for x in r.runs] for r in got if r.n_words > 5000}
    assert long == {504: [(0, 40_000, 1)], 506: [(0, 12_002, 4), (12_000, 6_000, 3)]}
    assert periodic.find(docs.where(F.lit(False))).count() == 0


def test_query_on_edge_rows(spark, scratch):
    rows = corpus()
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, length int").write.parquet(f"{scratch}/documents.parquet")
    got = sorted((str(r.doc_id), r.n_runs, str((r.start, r.length, r.period, r.exponent_milli)), r.runs_sha256, r.collapsed_sha256)
                 for r in queries.op11_periodic_runs(spark, scratch).collect())
    want = []
    for doc_id, words, found in expected(rows, loops=True):
        s, n, q = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
        want.append((str(doc_id), len(found), str((s, n, q, 1000 * n // q if found else None)),
                     hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()).hexdigest(),
                     hashlib.sha256(" ".join(collapsed(words, found)).encode()).hexdigest()))
    assert got == sorted(want)


def test_query_equals_sql(spark):
    got = queries.op11_periodic_runs(spark, SMALL)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    want = con.execute(queries.oracle_sql()["op11_periodic_runs"])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    rows = want.fetchall()
    assert sorted(map(str, rows)) == sorted(str(tuple(r[c] for c in names)) for r in got.collect())
    assert sum(r[names.index("n_runs")] > 0 for r in rows) > 5
