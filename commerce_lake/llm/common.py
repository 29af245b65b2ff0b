"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Rows of one Arrow batch sent to a Python worker; a batch also ends at
#: ``spark.sql.execution.arrow.maxBytesPerBatch``.
BATCH_ROWS = 512
#: Of each byte whether it is ASCII white space (space, tab, line feed, vertical tab, form feed, carriage return).
SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Send fewer rows at a time to Python: texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Send so many rows at a time to Python in what is computed inside; the session's setting comes back afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def text_of(df: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """Only the named columns and the text, with NULL text as empty; other columns are left behind."""
    return df.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("text"))


def crc32_mod(column: str, modulus: int) -> Column:
    """crc32 of the column as text, modulo ``modulus`` (NULL: -1)."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus)), F.lit(-1))


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[list]:
    """The named columns of each batch as Python lists."""
    for batch in batches:
        if batch.num_rows:
            yield [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def joined(batches: Iterator[pa.RecordBatch], size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches as one, up to about so many bytes; empty ones are left out."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.nbytes for b in held) >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def utf8_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (NULL: empty), and where each begins among them, with the end of the last."""
    whole = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = whole.buffers()
    starts = np.frombuffer(offsets, np.int64, len(whole) + 1, 8 * whole.offset) if len(whole) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[starts[0]:starts[-1]], starts - starts[0]
