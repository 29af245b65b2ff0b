"""Benchmark decontamination by winnowing.

A *window* is ``span`` consecutive words of a benchmark item (all words
of an item that has fewer).  A document's words inside any occurrence of
a window are hit.  Looking up every window of every document would take
one row a word; winnowing takes about one in three: of each window's
``w`` hashes of ``k`` words (k + w - 1 = span) the smallest is kept, the
last of equal ones.  The choice depends on the window alone, so a window
that a document shares with an item has the same kept hash, at the same
distance from its start, on both sides: every shared span of ``span``
words is found.  Kept hashes of documents and items are joined, and a
hit is extended to its windows, which are compared word by word.  Items
with fewer words than ``span`` have windows, and thus k and w, of their
own length; only lengths that occur are looked for.

Words and hashes of a batch are worked out in numpy over all its bytes
at a time.  The windows of the benchmark are distinct rows with the set
of their items (``windows_of``).  Up to ``MOST_WINDOWS`` of them are
broadcast (counted first; a window has at most ``span`` words, and their
bytes are counted as well); the lookup and the extension then happen
where the text is and nothing is shuffled.  Beyond that bound kept
hashes and windows are shuffled and joined by Spark, and only the texts
that share a kept hash are read again.  Both ways give the same rows.

What documents share is aggregated by sets of items: documents with the
same sets have their items listed once, whatever their number.

Edge cases: NULL and empty texts have no words, on both sides; an item
with a NULL id makes words hit but is neither counted nor listed;
repeated rows of documents give repeated results, repeated items count
once; a NULL doc_id is kept; an empty table on either side gives rows
without hits, or no rows; columns other than id and text are left behind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, text_of

#: Windows, and bytes of their text, up to which the benchmark is broadcast.
MOST_WINDOWS, MOST_BYTES = 200_000, 32 << 20
#: Bytes of text worked on at a time (or one document, if that is longer).
BLOCK = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True
#: The same words for Spark and DuckDB, after lower-casing A-Z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# odd multipliers of the hashes (public constants of SplitMix64 and of FNV)
_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x100000001B3)
_POWERS = np.cumprod(np.full(1024, _M3, np.uint64), dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """The words of some texts: lower-cased bytes, each word's place and hash, and each text's first word (one more: the end)."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, at: np.ndarray) -> Words:
        data = _LOWER[data]
        inside = _IN_WORD[data]
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = at[(at > 0) & (at < len(data))]  # no word runs on into the next text
        before[edges], after[edges - 1] = False, False
        start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        hashes = np.empty(len(start), np.uint64)
        for low, high in _shares(start, end):
            place = np.arange(start[low], end[high - 1])
            lengths = end[low:high] - start[low:high]
            gaps = np.append(start[low + 1:high], end[high - 1]) - start[low:high]
            in_word = place - np.repeat(start[low:high], gaps)
            value = (data[place].astype(np.uint64) + np.uint64(1)) * _POWERS[in_word & 1023] * (in_word < np.repeat(lengths, gaps))
            hashes[low:high] = np.add.reduceat(value, start[low:high] - start[low])
        return cls(data, start, end, _mixed(hashes), np.searchsorted(start, at))

    def text(self, low: int, high: int) -> list[bytes]:
        """The words from number ``low`` up to ``high``, at least one."""
        begin = int(self.start[low])
        raw = self.data[begin:self.end[high - 1]].tobytes()
        return [raw[s - begin:e - begin] for s, e in zip(self.start[low:high].tolist(), self.end[low:high].tolist())]

    def only(self, text: int) -> Words:
        """The words of one text."""
        low, high = int(self.first[text]), int(self.first[text + 1])
        return Words(self.data, self.start[low:high], self.end[low:high], self.hash[low:high], np.array([0, high - low]))


def _shares(start: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of words of about a block of bytes."""
    low = 0
    while low < len(start):
        high = max(low + 1, int(np.searchsorted(end, start[low] + BLOCK, side="right")))
        yield low, high
        low = high


def gram_words(span: int) -> int:
    """k for windows of ``span`` words."""
    return span // 2 + 1


def kept(words: Words, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word of each window, the window's kept k-gram as its first word, all k-gram hashes)."""
    k = gram_words(span)
    n = len(words.hash)
    none = np.empty(0, np.int64)
    if n < span:
        return none, none, np.empty(0, np.uint64)
    grams = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        grams = grams * _M3 + words.hash[i:n - k + 1 + i]
    grams = _mixed(grams + np.uint64(span))
    least, at = grams[:n - span + 1].copy(), np.arange(n - span + 1)
    for step in range(1, span - k + 1):
        other = grams[step:n - span + 1 + step]
        better = other <= least
        np.copyto(least, other, where=better)
        at[better] = np.flatnonzero(better) + step
    window = np.arange(n - span + 1)
    owner = np.searchsorted(words.first, window, side="right") - 1
    whole = window + span <= words.first[owner + 1]
    return window[whole], at[whole], grams


def _blocks(column: pa.Array) -> Iterator[tuple[int, Words]]:
    """(number of the first text, words) of runs of texts of about a block of bytes."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(at, at[low] + BLOCK, side="right")) - 1)
        yield low, Words.of(data[at[low]:at[high]], at[low:high + 1] - at[low])
        low = high


# --- the benchmark ---------------------------------------------------------------

def words_of(text: str) -> Column:
    """The words of a column as an array."""
    return F.regexp_extract_all(F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _UPPER.lower()), F.lit(WORD), F.lit(0))


def windows_of(items: DataFrame, span: int = 10) -> DataFrame:
    """(span, window, items): every distinct window (words joined by a space) with the sorted distinct ids of its items, as strings."""
    words = items.select(F.col("item_id").cast("string").alias("item"), words_of("text").alias("w")).where(F.size("w") > 0)
    words = words.withColumn("span", F.least(F.size("w"), F.lit(span)))
    each = words.select("item", "span", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("span") + 1),
                                                              lambda i: F.concat_ws(" ", F.slice("w", i, F.col("span"))))).alias("window"))
    return each.groupBy("span", "window").agg(F.sort_array(F.collect_set("item")).alias("items"))


# --- documents -------------------------------------------------------------------

@dataclass
class Hits:
    """Windows found in the texts of a block: text, first word in it, words, and what to note."""

    doc: list
    start: list
    span: list
    note: list

    def column(self, n: int) -> tuple[np.ndarray, pa.Array]:
        """(hits of each of the n texts, a list column of them)."""
        order = np.argsort(np.array(self.doc, np.int64), kind="stable")
        count = np.bincount(np.array(self.doc, np.int64), minlength=n)
        fields = [pa.array(self.start, pa.int32()), pa.array(self.span, pa.int32()), pa.array(self.note, pa.string())]
        flat = pa.StructArray.from_arrays([f.take(pa.array(order)) for f in fields], ["start", "span", "note"])
        return count, pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32()), flat)


def _row_key(doc_id, text: bytes) -> bytes:
    return hashlib.sha1(repr(doc_id).encode() + b"\0" + text).digest()


def _scan(docs: DataFrame, found) -> DataFrame:
    """(doc_id, n_words, row, hits) of every document; ``found(words, batch, low)`` gives the hits of a block of texts.

    ``row`` is a digest of id and text, NULL where nothing was found.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for low, words in _blocks(texts):
                n = len(words.first) - 1
                count, hits = found(words, batch, low).column(n)
                rows = [_row_key(ids[low + i].as_py(), texts[low + i].as_buffer().to_pybytes()) if count[i] else None for i in range(n)]
                yield pa.RecordBatch.from_arrays([ids.slice(low, n), pa.array(np.diff(words.first), pa.int64()), pa.array(rows, pa.binary()), hits],
                                                 ["doc_id", "n_words", "row", "hits"])

    return docs.mapInArrow(run, f"doc_id {kind}, n_words long, row binary, hits array<struct<start:int,span:int,note:string>>")


def _looked_up(docs: DataFrame, windows: DataFrame, spans: list[int]) -> DataFrame:
    """Hits by a broadcast of the windows and their kept hashes; the caller has checked their number and size."""
    known = {r["window"].encode(): r["set_id"] for r in windows.select("window", "set_id").collect()}
    sent = docs.sparkSession.sparkContext.broadcast((known, {span: _marks(known, span) for span in spans}))

    def found(words, batch, low):
        hits = Hits([], [], [], [])
        known, marks = sent.value
        for span in spans:
            window, at, grams = kept(words, span)
            _extend(words, window[np.isin(grams[at], marks[span])], span, known, hits)
        return hits

    return _scan(docs, found)


def _marks(windows: dict[bytes, str], span: int) -> np.ndarray:
    """The kept hashes of the windows of ``span`` words."""
    mine = [w for w in windows if w.count(b" ") == span - 1]
    words = Words.of(np.frombuffer(b"".join(mine), np.uint8), np.cumsum([0, *map(len, mine)]))
    _, place, grams = kept(words, span)
    return np.unique(grams[place])


def _extend(words: Words, window: np.ndarray, span: int, known: dict[bytes, str] | None, hits: Hits) -> None:
    """Compare the windows that start at these words with the known ones and note their sets; with None each notes itself."""
    if not len(window):
        return
    owner = np.searchsorted(words.first, window, side="right") - 1
    for stretch in np.split(np.arange(len(window)), np.flatnonzero((np.diff(window) > span) | (np.diff(owner) > 0)) + 1):
        doc, low = int(owner[stretch[0]]), int(window[stretch[0]])
        first, text = int(words.first[doc]), words.text(low, int(window[stretch[-1]]) + span)
        for start in window[stretch].tolist():
            joined = b" ".join(text[start - low:start - low + span])
            note = joined.decode() if known is None else known.get(joined)
            if note is not None:
                hits.doc.append(doc)
                hits.start.append(start - first)
                hits.span.append(span)
                hits.note.append(note)


def fingerprints(texts: DataFrame, spans: list[int]) -> DataFrame:
    """(key, span, pos, hash): the kept k-grams of every text of (key long, text)."""
    def run(batches):
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            for low, words in _blocks(batch.column(1)):
                for span in spans:
                    _, at, grams = kept(words, span)
                    at = np.unique(at)
                    owner = np.searchsorted(words.first, at, side="right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key[low + owner], pa.int64()), pa.array(np.full(len(at), span), pa.int32()),
                         pa.array(at - words.first[owner], pa.int32()), pa.array(grams[at].view(np.int64))], ["key", "span", "pos", "hash"])

    return texts.mapInArrow(run, "key long, span int, pos int, hash long")


def _joined(docs: DataFrame, windows: DataFrame, spans: list[int]) -> DataFrame:
    """Hits by joins of kept hashes and of windows, for a benchmark of any size."""
    keyed = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    marks = fingerprints(windows.select(F.lit(0).cast("long").alias("key"), F.col("window").alias("text")), spans)
    # a window also gives the hashes of shorter spans; these only add candidates, which are compared
    marks = checkpointed(marks.select("span", "hash").distinct())
    shared = (fingerprints(keyed.select("key", "text"), spans).join(marks, ["span", "hash"], "left_semi")
              .groupBy("key").agg(F.collect_set(F.struct("span", "pos")).alias("kept")))
    marked = keyed.join(checkpointed(shared), "key", "left").select("doc_id", "text", F.col("kept.span").alias("spans"), F.col("kept.pos").alias("places"))

    def found(words, batch, low):
        hits = Hits([], [], [], [])
        for i in range(len(words.first) - 1):
            mark_span, place = batch.column(2)[low + i].as_py(), batch.column(3)[low + i].as_py()
            for span in spans if place else ():
                mine = np.array(place)[np.array(mark_span) == span]
                one = words.only(i)
                window, at, _ = kept(one, span)
                _extend(words, window[np.isin(at, mine)] + words.first[i], span, None, hits)
        return hits

    candidates = checkpointed(_scan(marked, found))
    some = candidates.where("row is not null")
    each = some.select("row", F.explode("hits").alias("hit")).distinct()
    same = (each.join(windows, (F.col("hit.note") == F.col("window")) & (F.col("hit.span") == F.col("span")))
            .groupBy("row").agg(F.collect_list(F.struct("hit.start", "hit.span", F.col("set_id").alias("note"))).alias("hits")))
    return candidates.where("row is null").unionByName(some.drop("hits").join(same, "row", "left"))


def decontaminate(docs: DataFrame, items: DataFrame, span: int = 10, most_windows: int = MOST_WINDOWS) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items): words hit in every document, and the ids of the items that hit them.

    ``items`` is a sorted array of the item ids as strings; documents
    without a hit have an empty one.
    """
    if span < 1:
        raise ValueError("a window has at least one word")
    sets = F.sha2(F.concat_ws(",", F.transform("items", lambda i: F.concat(F.length(i).cast("string"), F.lit(":"), i))), 256)
    windows = checkpointed(windows_of(items, span).withColumn("set_id", sets))
    spans = sorted(r["span"] for r in windows.select("span").distinct().collect())  # at most ``span`` rows
    held = windows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("window")), F.lit(0)).alias("bytes")).first()
    docs = text_of(docs, "doc_id")
    broadcast = held["n"] <= most_windows and held["bytes"] <= MOST_BYTES
    scanned = checkpointed((_looked_up if broadcast else _joined)(docs, windows, spans))
    # distinct texts with hits; repeated rows of a document share their digest
    hit = scanned.where("size(hits) > 0").select("row", "hits").dropDuplicates(["row"]).select("row", F.array_sort("hits").alias("hits"))
    covered = F.aggregate(
        "hits", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda a, h: F.struct((a["n"] + F.greatest(F.lit(0), h["start"] + h["span"] - F.greatest(a["end"], h["start"]))).cast("long").alias("n"),
                              F.greatest(a["end"], h["start"] + h["span"]).alias("end")))["n"]
    shared = checkpointed(hit.select("row", covered.alias("n_hit"), F.array_sort(F.array_distinct("hits.note")).alias("set_ids")))
    # the items of each combination of sets, once
    named = (shared.select("set_ids").distinct().select("set_ids", F.explode("set_ids").alias("set_id"))
             .join(windows.select("set_id", "items").dropDuplicates(["set_id"]), "set_id")
             .select("set_ids", F.explode_outer("items").alias("item"))
             .groupBy("set_ids").agg(F.sort_array(F.collect_set("item")).alias("items")))
    result = shared.join(checkpointed(named), "set_ids").select("row", "n_hit", "items")
    clean = scanned.where("row is null").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"))
    rest = scanned.where("row is not null").join(result, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return clean.unionByName(rest).select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items")


#: DuckDB statement for the rows of the query.
ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{WORD}') AS w FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{WORD}') AS w
  FROM benchmark),
iw AS (
  SELECT DISTINCT item, least(len(w), 10) AS span,
         array_to_string(list_slice(w, s, s + least(len(w), 10) - 1), ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0)),
dw AS (
  SELECT r, s, span, array_to_string(list_slice(w, s, s + span - 1), ' ') AS win
  FROM (SELECT r, w, span, unnest(range(1, len(w) - span + 2)) AS s
        FROM d, (SELECT DISTINCT span FROM iw) WHERE len(w) >= span)),
hits AS (SELECT dw.r, dw.s, dw.span, iw.item FROM dw JOIN iw USING (span, win)),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(s, s + span)) AS p FROM (SELECT DISTINCT r, s, span FROM hits)) GROUP BY r),
found AS (SELECT r, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(f.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(f.items, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c USING (r) LEFT JOIN found f USING (r)
"""
