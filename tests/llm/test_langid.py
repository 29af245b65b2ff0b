import itertools
import math

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from commerce_lake.llm import langid
from tests.conftest import MEDIUM

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_forward_sums_all_segmentations():
    pieces = {"▁": [0.1, 0.2], "▁a": [0.2, 0.1], "a": [0.1, 0.3], "ab": [0.3, 0.1], "b": [0.2, 0.2], "ba": [0.1, 0.2]}
    model = langid.Model(["x", "y"], np.zeros(2), pieces)
    for word in ("a", "ab", "abba", "zab"):
        text = langid.MARK + word
        want = np.zeros(2)
        for cuts in itertools.product([0, 1], repeat=len(text) - 1):
            parts, part = [], text[0]
            for cut, c in zip(cuts, text[1:]):
                if cut:
                    parts.append(part)
                    part = c
                else:
                    part += c
            parts.append(part)
            p = np.ones(2)
            for x in parts:
                p = p * (np.array(pieces[x]) if x in pieces else langid.UNKNOWN if len(x) == 1 else 0)
            want += p
        assert np.allclose(np.exp(langid.forward(word, model)), want)
        assert np.allclose(np.exp(langid.forward_batch(["b", word, "abab"], langid._prefixes(pieces), langid.table_of(pieces))[1]), want)
    used = dict(zip(pieces, langid.expectations(["ab"], np.ones(1), langid._prefixes(pieces), langid.table_of(pieces)[:, 0])))
    ways = {("▁a", "b"): .2 * .2, ("▁", "a", "b"): .1 * .1 * .2, ("▁", "ab"): .1 * .3}
    total = sum(ways.values())
    for piece, n in used.items():
        assert math.isclose(n, sum(w for k, w in ways.items() if piece in k) / total, abs_tol=1e-12)


def test_long_words_do_not_vanish():
    model = langid.Model(["x"], np.zeros(1), {"a": [1e-5]})
    assert math.isclose(langid.forward("a" * 500, model)[0], 500 * math.log(1e-5) + math.log(langid.UNKNOWN), rel_tol=1e-9)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    out = langid.identify_languages(docs, PIECES).join(docs.select("doc_id", "lang"), "doc_id").cache()
    held = out.where("held_out")
    assert out.count() == docs.count() and held.count() > 100
    assert held.where("lang_pred = lang").count() / held.count() > 0.95
    assert out.where("score < 0 or score > 1").count() == 0


def test_edge_cases(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the house and the tree", "en"), ("das haus und der baum", "de")] * 20)]
    rows += [(100, None, "en"), (101, "", None), (102, "123 !?", "de"), (103, "the tree", None), (103, "the tree", None), (None, "der baum", "de"), (104, "x" * 5000, "en")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, score int")
    out = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify_languages(docs, PIECES).collect()}
    assert out[100] == out[101] == out[102] == ("und", 0.0) and out[103][0] == "en" and out[None][0] == "de"
    kept = langid.drop_undetermined(docs, PIECES)
    assert kept.columns == docs.columns and {100, 101, 102} & {r.doc_id for r in kept.collect()} == set() and kept.where("doc_id = 103").count() == 2
    assert langid.identify_languages(docs.where(F.lit(False)), PIECES).count() == 0
    nobody = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify_languages(nobody, PIECES).collect()} == {"und"}


def test_long_words_are_learned():
    rng = np.random.default_rng(3)
    pieces = {p: [float(x)] for p, x in zip(["▁", "▁a", "a", "ab", "b", "ba", "bab", "aab"], rng.random(8))}
    trie, table = langid._prefixes(pieces), langid.table_of(pieces)[:, 0]
    for word in ("a", "abba", "zabab", "ab" * 10):
        assert np.allclose(langid.long_expectations(word, 2.0, trie, table), langid.expectations([word], np.array([2.0]), trie, table))
    used = langid.long_expectations("ab" * 3000, 1.0, trie, table * 1e-3)
    assert np.isfinite(used).all() and used.sum() > 1000


def test_scores_do_not_depend_on_the_batches(monkeypatch):
    rng = np.random.default_rng(4)
    letters = list("abcdeﬁé")
    pieces = {p: rng.random(3).tolist() for p in ["▁", *letters, "ab", "▁ab", "cd", "éa", "abc"]}
    model = langid.Model(["x", "y", "z"], np.log([0.2, 0.3, 0.5]), pieces)
    texts = [" ".join("".join(rng.choice(letters, rng.integers(1, 50))) for _ in range(rng.integers(0, 60))) for _ in range(80)] + [None, "", "12 !"]
    whole = langid.Identifier(model)(texts)
    for together in (1, 40, 700):
        monkeypatch.setattr(langid, "TOGETHER", together)
        some = langid.Identifier(model)(texts)
        assert [a for a, _ in some] == [a for a, _ in whole] and np.allclose([b for _, b in some], [b for _, b in whole])
    for text, (lang, score) in zip(texts, whole):
        if text and langid.words_of(text):
            sums = model.priors + sum(np.array(langid.forward(w, model)) for w in langid.words_of(text))
            assert lang == model.languages[int(np.argmax(sums))] and math.isclose(score, 1 / np.exp(sums - sums.max()).sum(), rel_tol=1e-6)
