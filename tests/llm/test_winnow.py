import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from commerce_lake.llm import queries, winnow
from tests.conftest import SMALL


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, span=10):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(span, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        names = sorted(str(x) for x in found if x is not None)
        out.append((str(doc_id), len(w), len(hit), len(names), names))
    return sorted(out)


def corpus():
    rnd = random.Random(5)
    vocabulary = ["The", "a", "é", "Ñu", "x9", "𝄞", "and", "of", "to", "in"] + [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randint(10, 30)))) for i in range(25)]
    items += [(100, "Short item"), (101, "one"), (102, "exactly five words are here"), (103, None), (104, ""), (105, "?!"), (None, items[3][1]),
              (106, items[4][1]), (4, items[4][1]), (107, "a a a a a a a a a a a a a a"), (108, items[0][1] + " a preamble of every item " + items[1][1])]
    docs = []
    for i in range(250):
        w = rnd.choices(vocabulary, k=rnd.randint(0, 80))
        if i % 3 == 0:  # a stretch of an item, at times too short to be a window
            source = (rnd.choice(items[:25])[1]).split()
            low = rnd.randrange(len(source))
            at = rnd.randrange(len(w) + 1)
            w[at:at] = source[low:low + rnd.randint(8, 14)]
        docs.append((i, rnd.choice([" ", ", ", "\n"]).join(w)))
    docs += [(900, None), (901, ""), (902, "...!"), (903, "short ITEM"), (904, "shortitem one"), (905, items[3][1].upper()), (905, items[3][1].upper()),
             (906, "b " + "a " * 40), (None, items[4][1]), (None, "no hit at all"), (907, "exactly five words are here exactly five words are here"),
             (908, "z" * 70_000 + " " + items[2][1] + " " + "q " * 50_000)]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, row string, key int"),
            spark.createDataFrame([(*r, "y") for r in items], "item_id long, text string, span string"))


@pytest.mark.parametrize("most", [winnow.MOST_WINDOWS, 0])
def test_equals_brute_force(spark, most):
    docs, items = corpus()
    out = winnow.decontaminate(*frames(spark, docs, items), most_windows=most).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r["items"]) for r in out) == brute(docs, items)
    assert sum(r.n_hit > 0 for r in out) > 30


@pytest.mark.parametrize("most", [winnow.MOST_WINDOWS, 0])
def test_empty_tables(spark, most):
    docs, items = corpus()
    d, b = frames(spark, docs, items)
    assert winnow.decontaminate(d.where(F.lit(False)), b, most_windows=most).count() == 0
    none = winnow.decontaminate(d, b.where(F.lit(False)), most_windows=most).collect()
    assert len(none) == len(docs) and not any(r.n_hit or r.n_items for r in none)


def test_a_hot_passage_with_a_preamble_of_all_items(spark):
    preamble = "please read the text below and answer the question with one word only"
    items = [(i, f"{preamble} item{i} has its own words w{i} v{i} u{i} t{i} s{i}") for i in range(60)]
    docs = [(i, f"intro {i} {preamble} outro") for i in range(300)]
    for most in (winnow.MOST_WINDOWS, 0):
        out = winnow.decontaminate(*frames(spark, docs, items), most_windows=most).collect()
        assert {(r.n_hit, r.n_items) for r in out} == {(13, 60)} and len(out) == 300


def test_kept_hashes_cover_every_window():
    rnd = np.random.default_rng(2)
    text = " ".join(rnd.choice(["a", "b", "c"], 400))
    raw = np.frombuffer(text.encode(), np.uint8)
    w = winnow.Words.of(raw, np.array([0, len(raw)]))
    for span in (1, 2, 5, 10, 17):
        window, at, grams = winnow.kept(w, span)
        k = winnow.gram_words(span)
        assert len(window) == 400 - span + 1 and (at >= window).all() and (at + k <= window + span).all()
        inner = np.stack([grams[window + i] for i in range(span - k + 1)])
        assert (grams[at] == inner.min(axis=0)).all()
    assert len(np.unique(winnow.kept(w, 10)[1])) < 300


def test_query_equals_sql(spark):
    got = queries.op12_decontamination(spark, SMALL)
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    want = con.execute(queries.oracle_sql()["op12_decontamination"])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    rows = want.fetchall()
    assert sorted(map(str, rows)) == sorted(str(tuple(r[c] for c in names)) for r in got.collect())
    assert any(r[names.index("contaminated")] for r in rows)
