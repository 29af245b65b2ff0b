import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from commerce_lake.llm import simhash
from commerce_lake.llm.components import components


def brute_fingerprint(text, n=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ")
             .replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, max_bits=3):
    root = {k: k for k in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= max_bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def test_fingerprint():
    for text in ["", "a", "A b", "a b c", "x y z " * 50, "É é\x1cÉ b c d e", "one\ttwo\x0bthree\x0cfour\rfive\nsix"]:
        assert simhash.fingerprint(text) & (2 ** 64 - 1) == brute_fingerprint(text)


def test_anchors_cover():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 32, 300, dtype=np.uint64)
    near = simhash.near_anchors(x)
    home = simhash.home_anchor(x)
    assert (np.bitwise_count(home ^ x) <= 1).all() and (np.bitwise_count(near ^ x[:, None]) <= 2).all()
    for bit in range(32):  # one bit away: meets the home anchor
        y = x ^ np.uint64(1 << bit)
        assert (simhash.near_anchors(y) == home[:, None]).any(axis=1).all()
    assert all(len(set(r.tolist())) <= 17 for r in near)


def clustered(rnd, n):
    out = []
    while len(out) < n:
        x = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 12)):
            out.append(x)
            for _ in range(rnd.randint(0, 5)):
                x ^= 1 << rnd.randrange(64)
    return out[:n]


def test_links_equal_brute_force(spark):
    rnd = random.Random(2)
    base = rnd.getrandbits(64)
    crowd = [base ^ (1 << i) ^ (1 << j) for i in range(12) for j in range(i)]  # a long run at one anchor
    prints = dict(enumerate(dict.fromkeys(clustered(rnd, 700) + crowd)))
    signed = [(i, int(np.uint64(p).astype(np.int64))) for i, p in prints.items()]
    found = components(simhash.links(spark.createDataFrame(signed, "rep long, fp long").select("fp", "rep")))
    labels = {i: i for i in prints} | {r.node: r.component for r in found.collect()}
    assert labels == brute_groups(prints)


def test_split_anchors_equal_brute_force(spark, monkeypatch):
    rnd = random.Random(8)
    base = rnd.getrandbits(64)
    family = [base ^ sum(1 << b for b in rnd.sample(range(32), rnd.randint(1, 4))) for _ in range(500)]  # one half is the same in all
    wide = [base ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 6))) for _ in range(300)]
    prints = dict(enumerate(dict.fromkeys(family + wide + clustered(rnd, 200))))
    table = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)), i) for i, p in prints.items()], "fp long, rep long")
    want = brute_groups(prints)
    for counted, broadcast in ((1, 100), (4, 0)):
        monkeypatch.setattr(simhash, "COUNTED", counted)
        monkeypatch.setattr(simhash, "MOST_BROADCAST", broadcast)
        found = components(simhash.links(table, 3, anchor_rows=40))
        assert {i: i for i in prints} | {r.node: r.component for r in found.collect()} == want


def test_split_runs_are_bounded(spark):
    family = spark.range(4000).select((F.col("id") * 2 ** 32).alias("fp"), F.col("id").alias("rep"))  # all at anchors of the low half 0
    spread = simhash.replicas(family)
    hot = spread.groupBy("anchor").agg(F.ceil(F.count("*") / 100).alias("blocks")).where("blocks > 1")
    longest = simhash.split_runs(spread, hot).groupBy("run").count().agg(F.max("count")).first()[0]
    assert spread.groupBy("anchor").count().agg(F.max("count")).first()[0] == 4000
    assert longest < 300  # two blocks of about 100


def test_documents(spark):
    rnd = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        t = rnd.choices(words, k=400)
        rows.append((i * 3, " ".join(t)))
        if i % 2:
            t[rnd.randrange(400)] = "changed"
            rows.append((i * 3 + 1, " ".join(t)))
    rows += [(500 + i, "same text of a copy") for i in range(40)] + [(900, None), (901, ""), (902, " \n"), (900, None), (None, "same text of a copy"), (None, "alone"), (None, "alone")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, fp int, rep string")
    out = simhash.near_duplicates(docs).select("doc_id", simhash.fingerprint_hex("fp").alias("f"), "component_id").collect()
    assert len(out) == len(rows)
    known = {i: brute_fingerprint(t) for i, t in rows if i is not None}
    want = brute_groups(known)
    assert {r.doc_id: r.component_id for r in out if r.doc_id is not None} == want
    assert {r.doc_id: r.f for r in out if r.doc_id is not None} == {i: f"{p:016x}" for i, p in known.items()}
    assert sorted(str(r.component_id) for r in out if r.doc_id is None) == ["500", "None", "None"]
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted([str(i) for i in set(want.values())] + ["None"])
    assert simhash.near_duplicates(docs.where(F.lit(False))).count() == 0


def test_components_on_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(5, 5), (1000, 1001), (1001, 1000), (None, 3)], "u long, v long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 1000: 1000, 1001: 1000}


def test_one_per_group_with_helper_names(spark):
    names = ["row", "id", "n", "fp", "print", "digest", "_n", "rep", "component_id"]
    rows = [(1, "a b c d", *names), (2, "a b c d", *names), (3, "other words in here", *names), (3, "other words in here", *names), (None, "a b c d", *names), (None, "alone", *names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns and {tuple(r[2:]) for r in kept.collect()} == {tuple(names)}
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "None"]


def test_batch_size_comes_back(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a b c d e")], "doc_id long, text string")
    simhash.fingerprints(docs)  # texts: small batches from here on
    before = spark.conf.get(name)
    simhash.near_duplicates(docs).collect()
    assert spark.conf.get(name) == before
