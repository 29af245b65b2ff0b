import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from commerce_lake.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_a_full_memo_gives_the_same_ids(monkeypatch):
    rnd = random.Random(2)
    words = ["it's", "Ünïcode", "don't!", "x1y2", "<|endoftext|>", "a" * 60, "\n\n", "(see", "12,5%", "ß"]
    texts = [rnd.choice([" ", "\n", "  "]).join(rnd.choices(words, k=rnd.randint(0, 40))) for _ in range(60)]
    library = Tokenizer.from_file(PATH)
    for size in (1, 5, 1000):
        monkeypatch.setattr(tokens, "MEMO_CHUNKS", size)
        encoder = tokens.Encoder(PATH)
        for text in texts:
            assert np.frombuffer(encoder.encode(text), np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(encoder.memo) <= size


def test_texts_together_give_the_same_ids_in_few_calls(monkeypatch):
    rnd = random.Random(4)
    parts = ["a", "B", "é", "7", " ", " ", "  ", "\n", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", " ", " ", " ", " ", "　", "×", "÷",
             "'s", "'", "!", "<|endoftext|>", "<|endoftext", "漢", "́", "😀", "word", "z" * 60]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 30))) if rnd.random() < 0.95 else None for _ in range(3000)]
    library = Tokenizer.from_file(PATH)
    expected = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for cut, size in ((1, 700_000), (100, 3), (8 << 20, 5), (8 << 20, 700_000)):
        monkeypatch.setattr(tokens, "CUT_BYTES", cut)
        monkeypatch.setattr(tokens, "MEMO_CHUNKS", size)
        encoder = tokens.Encoder(PATH)
        got = encoder.encode_all(pa.array([None, *texts]).slice(1))
        assert [np.frombuffer(ids, np.uint32).tolist() for ids in got] == expected
        assert len(encoder.memo) <= size
    calls = []
    encoder = tokens.Encoder(PATH)
    plain = encoder._plain_all
    encoder.memo.encode = lambda chunk: calls.append(1) or encoder._plain(chunk)
    encoder.memo.encode_all = lambda chunks: calls.append(len(chunks)) or plain(chunks)
    assert len(list(encoder.encode_all(pa.array([f"word{i} of text {i}" for i in range(2000)])))) == 2000
    assert len(calls) == 1 and list(encoder.encode_all(pa.array([], pa.string()))) == []
