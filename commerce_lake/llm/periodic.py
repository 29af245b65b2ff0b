"""Periodic runs of words, found by difference-cover LCE on a harmonic grid.

A run is a longest stretch of words with smallest period q (words q
apart are equal) that holds at least ``min_periods`` periods and
``min_length`` words.

*Grid.*  Two words q apart are equal over the whole run but its last
period, so over at least three periods; whatever its place, three
successive multiples g of q lie there.  For each q the multiples of q
are looked at, n/1 + n/2 + n/3 + ... places in all, and only where three
in a row have an equal word q further is a run possible.  Of these
every third multiple is enough.

*LCE.*  From such a place the run extends to both sides as far as the
text equals itself q further: a longest common extension forwards, and
one backwards (forwards in the reversed text).  It is answered from the
suffixes at the places whose remainder modulo v is in a difference
cover: for any two places there is a distance below v that takes both
into the cover.  Only these suffixes are sorted (by their first v words,
then by prefix doubling, which stays in the cover), and the common
prefixes of neighbours go into a sparse table for range minima.  A query
compares fewer than v words and then takes one minimum.

A stretch that is found with several periods keeps the smallest: with
two of these, their greatest common divisor is a period as well.

Each text is worked on by itself, in numpy, in memory in proportion to
it; nothing is shuffled.  Texts without a candidate on the grid, which
are most, never get to the sorting.

Edge cases: NULL and empty texts have no words and no run; words are
compared as bytes, exactly; repeated rows give repeated results; NULL
ids are kept; an empty input gives an empty result; columns other than
id and text are left behind.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

# Perfect difference sets; every remainder modulo v is a difference of two members.
COVERS = {7: (1, 2, 4), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14), 31: (1, 5, 11, 24, 25, 27)}
#: Places of the grid looked at together (at least those of one period).
GRID = 1 << 20
#: White space between words, for Spark.
SPACE = r"[\x20\x09-\x0D]+"


@cache
def _cover(v: int) -> tuple[np.ndarray, np.ndarray]:
    """(which remainders are in the cover, the distance that takes two places, by their remainders, into it)."""
    cover = np.zeros(v, bool)
    cover[list(COVERS[v])] = True
    ahead = (np.arange(v)[:, None] + np.arange(v)) % v  # remainder, distance
    return cover, (cover[ahead][:, None] & cover[ahead][None]).argmax(axis=2)


@dataclass
class Suffixes:
    """Longest common extensions of a sequence of numbers (not negative) from difference-cover samples."""

    words: np.ndarray
    v: int = 13

    def __post_init__(self):
        n, v = len(self.words), self.v
        # beyond the end all numbers differ, so no comparison runs over it
        self.padded = np.concatenate([self.words.astype(np.int64), -1 - np.arange(2 * v)])
        cover, self.distance = _cover(v)
        self.places = np.flatnonzero(cover[np.arange(n + v) % v])
        self.number = np.full(n + v, -1)
        self.number[self.places] = np.arange(len(self.places))
        levels = self._sort()
        order = np.argsort(levels[-1])
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order))
        self._minima(self._neighbours(order, levels))

    def _sort(self) -> list[np.ndarray]:
        """Ranks of the samples by their first v, 2v, 4v, ... words, until all differ; ties share a rank."""
        first = [self.padded[self.places + i] for i in range(self.v)]
        order = np.lexsort(first[::-1])
        new = np.zeros(len(order), bool)
        for column in first:
            new[1:] |= column[order[1:]] != column[order[:-1]]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new)
        levels, reach = [rank], self.v
        while len(rank) and rank.max() < len(rank) - 1:
            _, rank = np.unique(rank * (len(rank) + 1) + self._after(rank, reach) + 1, return_inverse=True)
            levels.append(rank)
            reach *= 2
        return levels

    def _after(self, rank: np.ndarray, reach: int) -> np.ndarray:
        """The rank of the sample ``reach`` words on (a multiple of v), -1 beyond the last."""
        then = self.places + reach
        inside = then < len(self.number)
        out = np.full(len(rank), -1)
        out[inside] = rank[self.number[then[inside]]]
        return out

    def _neighbours(self, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Words that each sample, in sorted order, shares with the next."""
        a, b = self.places[order[:-1]], self.places[order[1:]]
        shared = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            reach = self.v << k
            inside = np.maximum(a, b) + shared < len(self.number)
            at = np.where(inside, shared, 0)
            same = inside & (levels[k][self.number[a + at]] == levels[k][self.number[b + at]])
            shared += reach * same
        return shared + self._words(a + shared, b + shared, np.full(len(a), self.v))

    def _words(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from places a and b on, up to ``most`` (at most v)."""
        out = np.zeros(len(a), np.int64)
        going = np.ones(len(a), bool)
        last = len(self.padded) - 1
        for i in range(self.v):
            going &= (i < most) & (np.maximum(a, b) + i <= last)
            going[going] = self.padded[a[going] + i] == self.padded[b[going] + i]
            out += going
        return out

    def _minima(self, shared: np.ndarray) -> None:
        self.table = [shared]
        while 2 << (len(self.table) - 1) <= len(shared):
            half = 1 << (len(self.table) - 1)
            self.table.append(np.minimum(self.table[-1][:-half], self.table[-1][half:]))

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words from i and from j on (i < j, j at most the length)."""
        h = self.distance[i % self.v, j % self.v]
        out = self._words(i, j, h)
        on = np.flatnonzero(out == h)
        on = on[j[on] + h[on] < len(self.words)]
        a, b = (self.rank[self.number[x[on] + h[on]]] for x in (i, j))
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp(high - low)[1] - 1  # floor of the binary logarithm
        least = np.empty(len(on), np.int64)
        for k in np.unique(level).tolist():
            mine = level == k
            least[mine] = np.minimum(self.table[k][low[mine]], self.table[k][high[mine] - (1 << k)])
        out[on] += least
        return out


def grid(words: np.ndarray, min_periods: int = 4) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period): multiples of three periods, in rows of three or more multiples with an equal word one period on.

    A run holds at least three multiples of its period in a row, thus one of these.
    """
    n, low = len(words), 1
    while low <= n // min_periods:
        high = low + 1  # periods low .. high - 1
        total = (n - 1) // low
        while high <= n // min_periods and total + (n - 1) // high <= GRID:
            total += (n - 1) // high
            high += 1
        if high - low > 1:
            counts = (n - 1) // np.arange(low, high)
            period = np.repeat(np.arange(low, high), counts)
            place = (np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)) * period
        else:
            place = np.arange(total) * low
            period = np.full(total, low)
        same = words[place] == words[place + period]
        three = same.copy()
        for step in (1, 2):
            three[:-step] &= same[step:] & (period[step:] == period[:-step])
            three[-step:] = False
        near = three.copy()  # in a row of three that begins here, one place before or two
        for step in (1, 2):
            near[step:] |= three[:-step]
        near &= place // period % 3 == 0
        yield place[near], period[near]
        low = high


def runs(words: np.ndarray, min_length: int = 6, min_periods: int = 4, v: int = 13) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start, then period."""
    if min_periods < 4:
        raise ValueError("the grid needs runs of at least four periods")
    n, forwards, found = len(words), None, []
    for place, period in grid(words, min_periods):
        if not len(place):
            continue
        if forwards is None:
            forwards, backwards = Suffixes(words, v), Suffixes(words[::-1], v)
        ahead = forwards.extension(place, place + period)
        back = backwards.extension(n - place - period, n - place)
        length = back + ahead + period
        long = length >= np.maximum(min_length, min_periods * period)
        found.append(np.unique(np.stack([place - back, length, period], axis=1)[long], axis=0))
    if not found:
        return np.empty((0, 3), np.int64)
    out = np.unique(np.concatenate(found), axis=0)
    # of one stretch the smallest period, which comes first
    new = np.ones(len(out), bool)
    new[1:] = (out[1:, :2] != out[:-1, :2]).any(axis=1)
    out = out[new]
    return out[np.lexsort([out[:, 2], out[:, 0]])]


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal words have equal numbers."""
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def repeats(n: int, found: np.ndarray) -> np.ndarray:
    """Which of n words some run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    return np.cumsum(change[:-1]) > 0


def find(docs: DataFrame, min_length: int = 6, min_periods: int = 4, v: int = 13) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every document.

    ``runs`` is an array of (start, length, period) by start, then
    period; ``collapsed`` holds the words without repeats, joined by a
    space: of each run only the first period stays, as far as no other
    run drops it.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    run_kind = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def one_batch(batches):
        for batch in batches:
            counts, totals, rows, texts = [], [], [], []
            for text in batch.column(1).to_pylist():
                words = text.encode().split()  # bytes: split() knows ASCII white space only
                ids = numbered(words)
                found = runs(ids, min_length, min_periods, v)
                if len(found):
                    words = [w for w, gone in zip(words, repeats(len(words), found).tolist()) if not gone]
                counts.append(len(ids))
                totals.append(len(found))
                rows.append(found)
                texts.append(b" ".join(words).decode())
            flat = np.concatenate([np.empty((0, 3), np.int64), *rows])
            each = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(run_kind))
            listed = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *totals]), pa.int32()), each)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), listed, pa.array(texts, pa.string())],
                                             ["doc_id", "n_words", "runs", "collapsed"])

    return text_of(docs, "doc_id").mapInArrow(
        one_batch, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def longest(column: str) -> Column:
    """The run of greatest length; of equal ones that with the smallest start, then period (NULL without runs)."""
    key = F.transform(column, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    best = F.array_max(key)
    return F.when(F.size(column) > 0, F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period")))


def listed(column: str) -> Column:
    """Every run's ``start,length,period`` and a line feed, in order."""
    return F.array_join(F.transform(column, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")


#: DuckDB statement for the rows of the query; crc32 is worked out from its table of 256 remainders.
ORACLE = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce([b] || range(8), lambda c, i:
           CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS remainders),
base AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         xor(list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
                         lambda c, b: xor(c >> 8, remainders[xor(c & 255, b) + 1])), 4294967295) AS h
  FROM documents, crc),
placed AS (SELECT *, len(w) AS n, (h // 10) % len(w) AS a FROM base),
looped AS (
  SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
         THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END])
         ELSE w END AS w
  FROM placed),
words AS (SELECT r, n, unnest(w) AS word, unnest(range(n)) AS i FROM looped),
pairs AS (
  SELECT x.r, y.i - x.i AS q, x.i FROM words x JOIN words y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretches AS (
  SELECT r, q, min(i) AS s, count(*) + q AS l
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS g FROM pairs) GROUP BY r, q, g
  HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT r, s, l, min(q) AS q FROM stretches GROUP BY r, s, l),
found AS (
  SELECT r, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS listed,
         first(s ORDER BY l DESC, s, q) AS s, max(l) AS l, first(q ORDER BY l DESC, s, q) AS q
  FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS collapsed FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(s AS BIGINT) AS start, CAST(l AS BIGINT) AS length, CAST(q AS BIGINT) AS period,
       CAST(1000 * l // q AS BIGINT) AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
       sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM looped LEFT JOIN found USING (r) LEFT JOIN kept USING (r)
"""
