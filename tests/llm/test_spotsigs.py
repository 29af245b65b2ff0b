import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from commerce_lake.llm import spotsigs


def test_signatures():
    a, b = spotsigs.signatures("The quick brown fox, the lazy dog and a cat"), spotsigs.signatures("THE quick brown fox the lazy dog and a cat!")
    assert len(a) == 4 and (a == b).all()  # the+quick brown, the+lazy dog, and+cat, a+cat
    assert len(spotsigs.signatures("")) == 0 and len(spotsigs.signatures("!!!")) == 1 and len(spotsigs.signatures("the the")) == 1
    assert spotsigs.likeness(spotsigs.signatures("!!!"), spotsigs.signatures("???")) == 0
    assert spotsigs.likeness(a, a) == 1 and spotsigs.likeness(a[:2], a) == 0.5


def test_next_document(spark):
    rnd = random.Random(8)
    vocabulary = list(spotsigs.ANCHORS)[:20] + [f"w{i}" for i in range(50)]
    rows = [(rnd.choice([i, i * 1000]), " ".join(rnd.choices(vocabulary, k=rnd.randint(0, 60)))) for i in range(150)]
    rows += [(7, None), (8, ""), (9, "é𝄞" * 30), (9, "é𝄞" * 30), (10, rows[0][1]), (None, "the null id of all")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, range string")
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = []
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        s, e, n = map(spotsigs.signatures, (text, edited, after))
        want.append((str(doc_id), len(text), hashlib.sha256(edited.encode()).hexdigest(), spotsigs.as_text(s), spotsigs.as_text(e), spotsigs.likeness(s, e), spotsigs.likeness(s, n)))
    for chars in (200, 1 << 24):
        fn_rows = spotsigs.with_next(docs, lambda d, t, a: (d, t, a), "doc_id long, text string, next string", chars).collect()
        assert sorted((str(r.doc_id), r.text, r.next) for r in fn_rows) == sorted(
            (str(a[0]), a[1] or "", order[(i + 1) % len(order)][1] or "") for i, a in enumerate(order))
    out = [(str(r.doc_id), *r[1:7]) for r in spotsigs.compare_with_next(docs).collect()]
    assert sorted(out) == sorted(want)
    one = spotsigs.compare_with_next(docs.where("doc_id = 8 and text = ''")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert spotsigs.compare_with_next(docs.where(F.lit(False))).count() == 0


def test_near_duplicates_equal_brute_force(spark):
    rnd = random.Random(9)
    anchors = sorted(spotsigs.ANCHORS)[:15]
    rows = []
    for i in range(40):
        words = [w for _ in range(40) for w in (rnd.choice(anchors), f"c{rnd.randrange(900)}")]
        for j in range(rnd.randint(1, 5)):
            rows.append((10 * i + j, " ".join(words)))
            words[rnd.randrange(40) * 2 + 1] = f"new{rnd.randrange(900)}"
    rows += [(900, None), (901, ""), (902, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: (r.class_id, r.component_id) for r in spotsigs.near_duplicates(docs, 0.8).collect()}
    sets = {i: spotsigs.signatures(t or "") for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if spotsigs.likeness(sets[a], sets[b]) >= 0.8:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert {i: c for i, (_, c) in out.items()} == {i: find(i) for i in keys}
    assert all(out[i][0] == min(j for j in keys if np.array_equal(sets[i], sets[j])) for i in keys)
