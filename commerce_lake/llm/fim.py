"""Fill-in-middle transformation by displacement scatter.

A text of n lines is cut after two line counts that its id's digest
fixes, into prefix, middle and suffix; the output holds the parts in
another order, each behind a marker.  Nothing is sliced text by text:
the bytes of a whole batch lie in one array, one scan finds the cuts,
and each part is a run of bytes that moves by one distance.  The
distances are written as differences at the first byte of each part;
their cumulative sum gives every byte its output place, and one scatter
builds all outputs.  ``restore`` finds the markers in the outputs, works
out the distances again from these alone, and gathers the bytes back.

The sums run over blocks of ``BLOCK`` bytes with a carried total, so
besides input and output a batch needs memory for one block, however
long a text is.  There is no shuffle: each row is worked on where it is.

Edge cases: NULL text is empty; an empty text and one that holds a
marker stay as they are (form ``plain``, NULL part lengths); a text
without a newline is one line; repeated rows give repeated results; a
NULL id counts as an empty string in the digest; an empty input gives an
empty result; columns other than the id and the text are left behind.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_of

# The markers, all of one length.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
WIDTH = len(PREFIX)
#: The order of the parts (0 prefix, 1 middle, 2 suffix) in the output of each form.
ORDERS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
#: The markers before the parts, by the place in the output.
MARKS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
FORMS = ("plain", "psm", "spm")
#: Bytes whose places are worked out at a time.
BLOCK = 1 << 20


@dataclass
class Text:
    """The bytes of a batch of texts in one array, and where each text begins (one more: the end)."""

    data: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, column: pa.Array) -> Text:
        column = column.cast(pa.large_binary())
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
        data = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
        return cls(data[at[0]:at[-1]], at - at[0])

    def column(self) -> pa.Array:
        bare = pa.Array.from_buffers(pa.large_binary(), len(self.at) - 1, [None, pa.py_buffer(self.at.astype(np.int64)), pa.py_buffer(self.data)])
        return bare.cast(pa.binary()).cast(pa.string())

    def owner(self, places: np.ndarray) -> np.ndarray:
        """The text that each byte place is in."""
        return np.searchsorted(self.at, places, side="right") - 1

    def markers(self) -> np.ndarray:
        """Places where a marker begins and, within the same text, ends."""
        d = self.data
        if len(d) < WIDTH:
            return np.empty(0, np.int64)
        found = np.flatnonzero((d[:-2] == PREFIX[0]) & (d[2:] == PREFIX[2]))
        found = found[np.isin(d[found + 1], [m[1] for m in (PREFIX, SUFFIX, MIDDLE)])]
        owner = self.owner(found)
        return found[found + WIDTH <= self.at[owner + 1]]


def shifts(starts: np.ndarray, shift: np.ndarray, total: int):
    """(block, distance of each of its bytes): bytes from ``starts[i]`` up to the next start move by ``shift[i]``.

    ``starts`` ascend and may repeat (an empty part); the last of equal ones holds.
    """
    change = np.diff(shift, prepend=0)
    carried = 0
    for low in range(0, total, BLOCK):
        high = min(total, low + BLOCK)
        first, last = np.searchsorted(starts, [low, high])
        difference = np.zeros(high - low, np.int64)
        np.add.at(difference, starts[first:last] - low, change[first:last])
        distance = np.cumsum(difference) + carried
        carried = int(distance[-1])
        yield slice(low, high), distance


def code_points(data: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Code points between byte places: bytes that do not go on with a character."""
    places = np.concatenate([low, high])
    order = np.argsort(places, kind="stable")
    ranked, before, counted = places[order], np.zeros(len(places), np.int64), 0
    for start in range(0, len(data), BLOCK):
        heads = np.concatenate([[0], np.cumsum((data[start:start + BLOCK] & 0xC0) != 0x80)])
        mine = slice(np.searchsorted(ranked, start, side="right"), np.searchsorted(ranked, start + len(heads) - 1, side="right"))
        before[order[mine]] = counted + heads[ranked[mine] - start]
        counted += int(heads[-1])
    return before[len(low):] - before[:len(low)]


def cut_places(text: Text, draws: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lines of each text, byte place of its first cut, of its second cut)."""
    begin, end = text.at[:-1], text.at[1:]
    breaks = np.flatnonzero(text.data == 10)
    first, last = np.searchsorted(breaks, begin), np.searchsorted(breaks, end)
    ends_open = np.zeros(len(begin), bool)
    some = end > begin
    ends_open[some] = text.data[end[some] - 1] != 10
    lines = last - first + ends_open
    picked = np.sort(draws % (lines + 1)[:, None], axis=1)

    def place(after: np.ndarray) -> np.ndarray:
        inside = (after > 0) & (after <= last - first)
        out = np.where(after > 0, end, begin)
        out[inside] = breaks[(first + after - 1)[inside]] + 1
        return out

    return lines, place(picked[:, 0]), place(picked[:, 1])


def _layout(begin, cut1, cut2, end, form):
    """Per text: starts of its parts in the text, lengths, and the places of the parts in the output, relative to the output's start."""
    part = np.stack([begin, cut1, cut2], axis=1)
    length = np.stack([cut1 - begin, cut2 - cut1, end - cut2], axis=1)
    place = np.zeros_like(part)
    place[:, 1], place[:, 2] = length[:, 0], length[:, 0] + length[:, 1]  # plain: as they are
    for name, order in ORDERS.items():
        mine = form == FORMS.index(name)
        at = np.zeros(int(mine.sum()), np.int64)
        for p in order:
            place[mine, p] = at + WIDTH
            at = at + WIDTH + length[mine, p]
    return part, length, place


def scatter(text: Text, cut1: np.ndarray, cut2: np.ndarray, form: np.ndarray) -> Text:
    """The outputs of all texts of a batch."""
    begin, end = text.at[:-1], text.at[1:]
    part, _, place = _layout(begin, cut1, cut2, end, form)
    at = np.concatenate([[0], np.cumsum(end - begin + np.where(form > 0, 3 * WIDTH, 0))])
    place += at[:-1, None]
    out = np.empty(int(at[-1]), np.uint8)
    for block, distance in shifts(part.ravel(), (place - part).ravel(), len(text.data)):
        out[np.arange(block.start, block.stop) + distance] = text.data[block]
    for name, order in ORDERS.items():
        mine = np.flatnonzero(form == FORMS.index(name))
        for mark, p in zip(MARKS[name], order):
            out[(place[mine, p] - WIDTH)[:, None] + np.arange(WIDTH)] = np.frombuffer(mark, np.uint8)
    return Text(out, at)


def gather(output: Text, form: np.ndarray) -> Text:
    """The texts of a batch of outputs; the markers that a form writes are found in the output itself."""
    begin, end = output.at[:-1], output.at[1:]
    found = output.markers()
    owner = output.owner(found)
    count = np.bincount(owner[form[owner] > 0], minlength=len(begin))
    if (count[form > 0] != 3).any():
        raise ValueError("an output does not hold its three markers")
    found = found[form[owner] > 0].reshape(-1, 3)
    changed = np.flatnonzero(form > 0)
    # where the parts lie in the output, in the order of the output
    low = found + WIDTH
    high = np.concatenate([found[:, 1:], end[changed][:, None]], axis=1)
    length = np.stack([end - begin, np.zeros_like(begin), np.zeros_like(begin)], axis=1)
    source = np.stack([begin, end, end], axis=1)
    for name, order in ORDERS.items():
        mine = form[changed] == FORMS.index(name)
        for column, p in enumerate(order):
            length[changed[mine], p] = (high - low)[mine, column]
            source[changed[mine], p] = low[mine, column]
    at = np.concatenate([[0], np.cumsum(length.sum(axis=1))])
    target = at[:-1, None] + np.cumsum(length, axis=1) - length
    data = np.empty(int(at[-1]), np.uint8)
    for block, distance in shifts(target.ravel(), (source - target).ravel(), len(data)):
        data[block] = output.data[np.arange(block.start, block.stop) + distance]
    return Text(data, at)


def draw(key: str, seed: int, number: int) -> Column:
    """The ``number``-th unsigned 32-bit integer (from 1) of the id's digest."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * number - 7, 8), 16, 10).cast("long")


def transform(docs: DataFrame, key: str = "doc_id", seed: int = 7, rate: int = 100, spm_rate: int = 50) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output) of every document.

    Of 100 texts about ``rate`` change, of these about ``spm_rate`` to
    the form ``spm`` (suffix first), the others to ``psm``.
    """
    kind = docs.schema[key].dataType
    drawn = text_of(docs, key).select(F.col(key).alias("key"), "text", draw(key, seed, 1).alias("h1"), draw(key, seed, 2).alias("h2"),
                                      F.when(draw(key, seed, 3) % 100 >= rate, 0).when(draw(key, seed, 4) % 100 < spm_rate, 2).otherwise(1).alias("form"))

    def run(batches):
        for batch in batches:
            text = Text.of(batch.column(1))
            begin, end = text.at[:-1], text.at[1:]
            form = batch.column(4).to_numpy(zero_copy_only=False).copy()
            form[begin == end] = 0
            form[text.owner(text.markers())] = 0
            lines, cut1, cut2 = cut_places(text, np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3)], axis=1))
            plain = form == 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lines, pa.int64()), pa.array(np.array(FORMS, object)[form], pa.string()),
                 pa.array(code_points(text.data, begin, cut1), mask=plain), pa.array(code_points(text.data, cut1, cut2), mask=plain),
                 scatter(text, cut1, cut2, form).column()], ["key", "n", "form", "prefix_chars", "middle_chars", "output"])

    out = drawn.mapInArrow(run, f"key {kind.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string")
    return out.withColumnRenamed("key", key)


def restore(transformed: DataFrame) -> DataFrame:
    """``transformed`` with a column ``restored``: the text that each output was made of, from output and form alone."""
    schema = transformed.schema
    form_at, output_at = (schema.names.index(c) for c in ("form", "output"))

    def run(batches):
        for batch in batches:
            form = pc.index_in(batch.column(form_at), value_set=pa.array(FORMS)).to_numpy(zero_copy_only=False)
            text = gather(Text.of(batch.column(output_at)), form).column()
            yield pa.RecordBatch.from_arrays([*batch.columns, text], [*batch.schema.names, "restored"])

    return transformed.mapInArrow(run, T.StructType([*schema.fields, T.StructField("restored", T.StringType())]))


#: DuckDB statement for the rows of the query: the digests of output and restored text.
ORACLE = r"""
WITH lines AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex
  FROM documents),
drawn AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || hex[1:8] AS BIGINT) AS h1, CAST('0x' || hex[9:16] AS BIGINT) AS h2,
         CAST('0x' || hex[17:24] AS BIGINT) AS h3, CAST('0x' || hex[25:32] AS BIGINT) AS h4
  FROM lines),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, array_to_string(list_slice(u, 1, a), '') AS p, array_to_string(list_slice(u, a + 1, b), '') AS m,
         array_to_string(list_slice(u, b + 1, n), '') AS s
  FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
