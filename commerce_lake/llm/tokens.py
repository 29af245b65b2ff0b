"""Token ids of a Hugging Face ``tokenizers`` file, with a memo of repeated chunks.

A byte-level BPE pre-tokenizer never lets a token run from a non-space
into a following space, so a text may be cut before every run of white
space: the ids of the chunks, one after another, are the ids of the
text.  Each chunk (leading white space and one run of other characters)
is encoded by the library once per worker and then looked up; a new
chunk is first cut where letters meet punctuation or digits.  A batch
of texts is cut as one run of bytes, only its distinct chunks are looked
up, and what is new among them goes to the library in few calls.  That
also bounds the memory for very long texts, which are never encoded
whole.  ``cuttable`` checks that the tokenizer is of that kind; any
other tokenizer encodes whole texts.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import SPACES, utf8_of

CHUNK = re.compile(r"\s*\S+|\s+")
#: Places inside a chunk where a token always ends as well: between a letter and ASCII punctuation or a digit, and
#: (but after an apostrophe, which may start a contraction) between those and a letter.
_LETTER, _OTHER = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-@\[-`{-~"
INNER = re.compile(f"(?<=[{_LETTER}])(?=[{_OTHER}'])|(?<=[{_OTHER}])(?=[{_LETTER}])")
LETTERS = np.isin(np.arange(256), np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", np.uint8))
OTHERS = np.isin(np.arange(256), [c for c in range(0x21, 0x7F) if c != 0x27]) & ~LETTERS
#: White space to Python's ``re`` but not to Unicode and the library: such texts are not cut.
ODD_SPACE = re.compile("[\x1c-\x1f]")
#: Longest chunk that is remembered, and most chunks of each of the two generations that a worker remembers.
MEMO_CHARS, MEMO_CHUNKS = 48, 700_000
#: Bytes of texts that are cut at a time (a longer text is cut alone), and most chunks of one call of the library.
CUT_BYTES, CALL_CHUNKS = 4 << 20, 1 << 15


def version_digest(path: str) -> str:
    """SHA-256 over the tokenizer file, the library version and the encoding options."""
    import tokenizers

    h = hashlib.sha256(f"tokenizers {tokenizers.__version__} add_special_tokens=False\n".encode())
    with open(path, "rb") as f:
        for block in iter(lambda: f.read(1 << 20), b""):
            h.update(block)
    return h.hexdigest()


def cuttable(path: str) -> bool:
    """Whether texts may be cut before white space: plain byte-level BPE, no normalizer, no stripping special tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    added = all(not t["lstrip"] and not t["rstrip"] and not re.search(r"\s", t["content"]) for t in spec.get("added_tokens", []))
    return bool(plain and added and spec.get("normalizer") is None and spec.get("truncation") is None)


def chunk_starts(data: np.ndarray, starts: np.ndarray, special: list[bytes] = []) -> np.ndarray:
    """Where UTF-8 bytes may be cut: the ``starts`` of texts, ASCII white space that follows none at all, the places of ``INNER``.

    Nothing is cut inside the ``special`` strings.
    """
    begin = SPACES[data]
    begin[1:] &= ~SPACES[data[:-1]]
    begin[:1] = False
    at = np.flatnonzero(begin)
    wide = at[data[at - 1] >= 0x80]  # after a character beyond ASCII, which may be white space as well
    a, b, c = data[np.maximum(wide - 3, 0)], data[wide - 2], data[wide - 1]
    general = (a == 0xE2) & (((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F)))
    other = ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
    begin[wide[((b == 0xC2) & ((c == 0x85) | (c == 0xA0))) | general | other]] = False
    first, last, other = LETTERS[data], LETTERS[data], OTHERS[data]  # the first and last bytes of letters
    latin = np.flatnonzero(data == 0xC3)
    latin = latin[(data[latin + 1] != 0x97) & (data[latin + 1] != 0xB7)]
    first[latin], last[latin + 1] = True, True
    begin[1:] |= (last[:-1] & (other | (data == 0x27))[1:]) | (other[:-1] & first[1:])
    if special:
        text = data.tobytes()
        for s in special:
            at = text.find(s)
            while at >= 0:
                begin[at + 1:at + len(s)] = False
                at = text.find(s, at + 1)
    begin[starts[:-1][starts[:-1] < starts[1:]]] = True
    return np.flatnonzero(begin)


class _Memo(dict):
    """Ids of chunks.  When it is full, all but what is met again while the next one fills is forgotten."""

    def __init__(self, encode, encode_all, special: list[str]):
        super().__init__()
        self.encode, self.encode_all, self.special, self.older = encode, encode_all, special, {}

    def __missing__(self, chunk: str) -> bytes:
        if len(chunk) > MEMO_CHARS:
            return self.encode(chunk)
        ids = self.older.get(chunk)
        if ids is None:
            parts = INNER.split(chunk) if not any(s in chunk for s in self.special) else [chunk]
            ids = b"".join([self[p] for p in parts]) if len(parts) > 1 else self.encode(chunk)
        if len(self) >= MEMO_CHUNKS:
            self.older = dict(self)
            self.clear()
        self[chunk] = ids
        return ids

    def look_up(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks; what is not remembered goes to the library in few calls."""
        ids = list(map(self.get, chunks))
        met = [i for i, known in enumerate(ids) if known is None]
        for i in met:
            ids[i] = self.older.get(chunks[i])
        new = [i for i in met if ids[i] is None]
        for i, coded in zip(new, self.encode_all([chunks[i] for i in new])):
            ids[i] = coded
        keep = [i for i in met if len(chunks[i]) <= MEMO_CHARS][:MEMO_CHUNKS]
        if len(self) + len(keep) > MEMO_CHUNKS:
            self.older = dict(self)
            self.clear()
        self.update((chunks[i], ids[i]) for i in keep)
        return ids

    def forget(self) -> None:
        self.older = {}
        self.clear()


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers in one ``bytes``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cuttable = cuttable(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = [s.encode() for s in special]
        self.memo = _Memo(self._plain, self._plain_all, special)

    def _plain(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _plain_all(self, chunks: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(chunks), CALL_CHUNKS):
            some = chunks[at:at + CALL_CHUNKS]
            coded = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            ids = array("I", coded.ids).tobytes()
            ends = (4 * np.bincount(coded.word_ids, minlength=len(some)).cumsum()).tolist()
            out += [ids[a:b] for a, b in zip([0, *ends], ends)]
        return out

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.cuttable or ODD_SPACE.search(text):
            return self._plain(text)
        return b"".join(map(self.memo.__getitem__, CHUNK.findall(text)))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """What ``encode`` gives for each of the texts (NULL: empty)."""
        if not self.cuttable:
            yield from (self.encode(t or "") for t in texts.to_pylist())
            return
        data, starts = utf8_of(texts)
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(starts, starts[at] + CUT_BYTES, "right")) - 1)
            yield from self._encode_run(data[starts[at]:starts[to]], starts[at:to + 1] - starts[at])
            at = to

    def _encode_run(self, data: np.ndarray, starts: np.ndarray) -> Iterator[bytes]:
        cuts = chunk_starts(data, starts, self.special)
        offsets = np.append(cuts, len(data)).astype(np.int64)
        coded = pa.LargeStringArray.from_buffers(len(cuts), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        ids = self.memo.look_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist())  # much faster than to_pylist
        index = coded.indices.to_numpy()
        flat = np.frombuffer(b"".join(ids), np.uint32)
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first = size.cumsum() - size
        chunks = np.searchsorted(cuts, starts).tolist()  # number of chunks before each text
        for a, b in zip(chunks, chunks[1:]):
            some = index[a:b]
            n = size[some]
            ends = n.cumsum()
            yield flat[np.repeat(first[some] - (ends - n), n) + np.arange(ends[-1] if b > a else 0)].tobytes()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of that file; later tasks of the same worker use its memo again."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
