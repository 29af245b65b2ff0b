import bisect
import random
import zlib
from array import array

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from commerce_lake.llm import packing, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for x in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, x)
        gap = gaps.pop(at) if at < len(gaps) else capacity
        bisect.insort(gaps, gap - x)
    return len(gaps)


def check_layout(rows, capacity):
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seqs)


def test_plan_equals_one_at_a_time_best_fit():
    rnd = random.Random(5)
    for capacity in (7, 64, 1024):
        for _ in range(20):
            lengths = [rnd.randint(1, capacity if rnd.random() < 0.3 else max(1, capacity // 5)) for _ in range(rnd.randint(1, 900))]
            runs = {x: lengths.count(x) for x in lengths}
            used = set()
            for _, a, b, seq, each, _ in packing.best_fit_plan(runs.items(), capacity):
                used |= {seq + i // each for i in range(b - a)}
            assert len(used) == best_fit_decreasing(lengths, capacity)


def test_documents(spark):
    long = "the quick brown fox jumps over it " * 700
    rows = [(1, None, "x"), (2, "", "x"), (3, long, "x"), (4, "a b c", "x"), (4, "a b c", "x"), (5, " \n\n x\x1c y \r\n\n z  ", "x"), (None, "null id", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string")
    out = packing.pack_documents(docs, PATH, 64, 2).collect()
    check_layout(out, 64)
    tok = Tokenizer.from_file(PATH)
    for doc_id, text, _ in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 2]
        mine = sorted({(r.piece, r.start, r.length, r.ids_crc32) for r in out if r.doc_id == doc_id})
        assert [m[0] for m in mine] == list(range(len(mine)))
        assert sum(m[2] for m in mine) == len(ids)
        assert all(m[2] == 64 for m in mine[1:])
        for _, start, length, crc in mine:
            assert crc == zlib.crc32(array("I", ids[start:start + length]).tobytes())
    assert sum(r.doc_id == 4 for r in out) == 2
    assert packing.pack_documents(docs.where(F.lit(False)), PATH, 64, 2).count() == 0


def test_hot_length(spark):
    pieces = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 10).otherwise(F.col("id") % 60 + 1).alias("length"))
    out = packing.pack(pieces, 64).collect()
    assert len({r.id for r in out}) == len(out) == 3000
    assert check_layout(out, 64) == best_fit_decreasing([r.length for r in out], 64)


def test_memo_equals_library():
    tok, enc = Tokenizer.from_file(PATH), tokens.Encoder(PATH)
    rnd = random.Random(3)
    alphabet = ["a", "B", "é", "7", " ", " ", "  ", "\n", "\r\n", "\t", " ", " ", "'s", "!", "<|endoftext|>", "漢", "\x1c", "\x85", "²", "é"]
    for _ in range(6000):
        text = "".join(rnd.choices(alphabet, k=rnd.randint(0, 25)))
        assert list(array("I", enc.encode(text))) == tok.encode(text, add_special_tokens=False).ids, repr(text)
