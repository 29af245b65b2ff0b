import hashlib
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from commerce_lake.llm import fim, queries
from tests.conftest import SMALL


def brute(doc_id, text, rate=100):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return (str(doc_id), n, "plain", None, None, text)
    if h[3] % 100 < 50:
        return (str(doc_id), n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (str(doc_id), n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def corpus():
    rnd = random.Random(3)
    rows = [(i, "".join(rnd.choices(["a", "é", "𝄞", "\n", "\r", " ", " ", "<", ">", "P", "<Q>"], k=rnd.randint(0, 60)))) for i in range(300)]
    rows += [(500, None), (501, ""), (502, "\n"), (503, "\n\n\n"), (504, "no end"), (505, "a <P> b\nc"), (506, "<"), (507, "<M>"), (508, "<S"), (509, ">x\ny"),
             (510, "P>\nq\n"), (None, "no id\nat all\n"), (4, "twice\nthe same id"), (4, "twice\nthe same id"), (511, "long\n" * 30_000), (512, "x" * 100_000)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "o", 1) for r in rows], "doc_id long, text string, output string, n int")


@pytest.mark.parametrize("rate", [100, 40])
def test_equals_brute_force(spark, rate, monkeypatch):
    rows = corpus()
    out = fim.transform(frame(spark, rows), rate=rate)
    assert sorted(map(str, ((str(r[0]), *r[1:]) for r in out.collect()))) == sorted(str(brute(*r, rate=rate)) for r in rows)
    back = fim.restore(out).collect()
    assert sorted((str(r.doc_id), r.restored) for r in back) == sorted((str(i), t or "") for i, t in rows)


def test_blocks_do_not_matter(monkeypatch):
    text = fim.Text.of(pa.array([t or "" for _, t in corpus()]))
    rnd = np.random.default_rng(1)
    draws = rnd.integers(0, 1 << 32, (len(text.at) - 1, 2))
    form = np.where(np.diff(text.at) > 0, rnd.integers(1, 3, len(text.at) - 1), 0)
    form[text.owner(text.markers())] = 0
    _, cut1, cut2 = fim.cut_places(text, draws)
    whole, chars = fim.scatter(text, cut1, cut2, form), fim.code_points(text.data, cut1, cut2)
    monkeypatch.setattr(fim, "BLOCK", 17)
    parts = fim.scatter(text, cut1, cut2, form)
    assert (chars == fim.code_points(text.data, cut1, cut2)).all()
    assert (whole.data == parts.data).all() and (whole.at == parts.at).all()
    back = fim.gather(parts, form)
    assert (back.data == text.data).all() and (back.at == text.at).all()


def test_edges(spark):
    assert fim.transform(frame(spark, corpus()).where(F.lit(False))).count() == 0
    assert fim.restore(fim.transform(frame(spark, corpus()).where(F.lit(False)))).count() == 0
    named = fim.transform(frame(spark, [(1, "a\nb")]).withColumnRenamed("doc_id", "key"), key="key")
    assert named.columns[0] == "key" and named.count() == 1
    bad = pa.array(["<P>a<S>b"])
    with pytest.raises(ValueError):
        fim.gather(fim.Text.of(bad), np.array([1]))


def test_query_equals_sql(spark):
    got = queries.op13_fill_in_middle(spark, SMALL)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    want = con.execute(queries.oracle_sql()["op13_fill_in_middle"])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(str, want.fetchall())) == sorted(str(tuple(r[c] for c in names)) for r in got.collect())
