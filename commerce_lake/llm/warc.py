"""Zstandard WARC archives: one frame per record, the dictionary in a leading skippable frame.

An archive file (.warc.zst) starts with a skippable frame (magic number
0x184D2A5D) that holds the Zstandard dictionary; each record follows as
one frame compressed with it.  The reader loads the dictionary from that
frame, decodes one frame per record in a stream, and validates the
version line, the mandatory headers, Content-Length, the end of the
record, and (for responses) length and SHA-1 of the payload.

Each task writes its own files into a shared store (any that pyarrow.fs
knows by its URI) under a name of its own and reports them in a manifest
table; only files of the manifest are read, so what a lost or repeated
task left is never seen.

Of records with equal payloads the one with the smallest page_id is a
response; the others are revisits that name it and carry no payload.

Edge cases: NULL html is an empty payload, a NULL url an empty one; a
repeated row of the smallest page_id is a response too; rows with a NULL
page_id revisit the smallest id of their payload, or are responses when
there is none; payloads under ``least_bytes`` are always responses; an
empty input gives no archive and an empty result; other columns are left
behind.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.materialize import materialize
from .common import checkpointed, rows_of, small_batches

MAGIC = 0x184D2A5D
RECORD_ID = "urn:page:"
BLOCK = 1 << 20
#: A new file is begun after so many bytes.
FILE_BYTES = 256 << 20
RESULT = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


class WarcError(ValueError):
    """An archive that is not what the format says."""


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def uri_of(page_id: int | None) -> str:
    return f"<{RECORD_ID}{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; with ``refers_to`` a revisit, whose block is the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {uri_of(page_id)}",
             "WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Target-URI: {re.sub(r'[\r\n]', ' ', url)}", f"WARC-Payload-Digest: sha1:{digest}",
             "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {uri_of(refers_to)}"]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""])
    return head.encode() + block + b"\r\n\r\n"


def _headers(text: bytes, what: str) -> dict[str, str]:
    out = {}
    for line in text.decode("utf-8").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon:
            raise WarcError(f"{what}: a line without a colon: {line[:80]!r}")
        out[name.lower()] = value.strip()
    return out


def _id(uri: str) -> int | None:
    m = re.fullmatch(rf"<{RECORD_ID}(-?\d*)>", uri)
    if not m:
        raise WarcError(f"not a record id: {uri[:80]!r}")
    return int(m[1]) if m[1] else None


def parse_record(data: bytes) -> dict:
    """Validates one record; returns its page_id, url, payload, length, digest, type and the page it refers to."""
    head, split, rest = data.partition(b"\r\n\r\n")
    version, _, fields = head.partition(b"\r\n")
    if not split or version != b"WARC/1.1":
        raise WarcError(f"not a WARC/1.1 record: {data[:40]!r}")
    h = _headers(fields, "record")
    for name in ("warc-type", "warc-record-id", "warc-date", "warc-payload-digest", "content-length"):
        if name not in h:
            raise WarcError(f"no {name}")
    length = int(h["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise WarcError(f"Content-Length is {length}, the block has {len(rest) - 4} bytes")
    http, split, payload = rest[:length].partition(b"\r\n\r\n")
    if not split or not http.startswith(b"HTTP/1.1 "):
        raise WarcError("the block has no HTTP header")
    size = int(_headers(http.partition(b"\r\n")[2], "HTTP header").get("content-length", "-1"))
    digest = h["warc-payload-digest"].removeprefix("sha1:")
    kind = h["warc-type"]
    if kind == "response":
        if size != len(payload) or sha1_base32(payload) != digest:
            raise WarcError("the payload has another length or digest than its headers say")
    elif kind != "revisit" or payload or "warc-refers-to" not in h:
        raise WarcError(f"neither a response nor a revisit without payload: {kind[:40]!r}")
    return {"page_id": _id(h["warc-record-id"]), "url": h.get("warc-target-uri", ""), "payload_bytes": size, "payload_digest": digest,
            "record_type": kind, "refers_to": _id(h["warc-refers-to"]) if kind == "revisit" else None,
            "payload": payload if kind == "response" else None}


def skippable(dictionary: bytes) -> bytes:
    return struct.pack("<II", MAGIC, len(dictionary)) + dictionary


def frames(stream) -> Iterator[bytes]:
    """The content of each frame of an archive, decoded with the dictionary of the leading skippable frame."""
    import zstandard

    start = stream.read(8)
    if not start:
        return
    if len(start) < 8 or struct.unpack("<I", start[:4])[0] != MAGIC:
        raise WarcError("no leading skippable frame")
    size = struct.unpack("<I", start[4:])[0]
    dictionary = stream.read(size)
    if len(dictionary) < size:
        raise WarcError("the dictionary is cut off")
    d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    data = stream.read(BLOCK)
    while data:
        one, parts = d.decompressobj(), []
        while not one.eof:
            if not data:
                raise WarcError("the last frame is cut off")
            parts.append(one.decompress(data))
            data = one.unused_data if one.eof else stream.read(BLOCK)
        yield b"".join(parts)
        data = data or stream.read(BLOCK)


def train_dictionary(pages: DataFrame, samples: int = 1000, sample_bytes: int = 2000, size: int = 64 << 10) -> bytes:
    """A dictionary from the beginnings of about ``samples`` pages (a bounded sample); empty if there are too few."""
    import zstandard

    rows = pages.where(F.col("html").isNotNull()).select(F.substring(F.col("html"), 1, sample_bytes).alias("html")).limit(samples).collect()
    texts = [t for r in rows if (t := r["html"].encode())]
    if len(texts) < 50:
        return b""
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, texts)) // 10), texts).as_bytes()
    except zstandard.ZstdError:  # e.g. all samples alike
        return b""


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme of its store: without one it is in Spark's default store, not on each machine's own disk."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub(r"^file:/(?!/)", "file:///", re.sub(r"^s3[an]:", "s3:", uri))  # as pyarrow calls them


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, level: int = 3) -> DataFrame:
    """Writes the pages' records to archives in ``folder``; returns the manifest (path, records, bytes)."""
    spark = pages.sparkSession
    folder = qualified(spark, folder)
    small_batches(spark, 128)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
                        F.coalesce("html", F.lit("")).cast("binary").alias("html"))
    rows = rows.withColumn("sha1", F.unhex(F.sha1("html")))
    # copies are pre-aggregated; the table of first pages (of payloads that occur again) is written, so a hot payload meets it in a join that can be split
    first = checkpointed(rows.where(F.length("html") >= least_bytes).groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
                         .where("n > 1").select("sha1", "first"))
    joined = rows.join(first, "sha1", "left").withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))
    dictionary = train_dictionary(pages)
    sent = spark.sparkContext.broadcast(dictionary)

    def write(batches):
        import pyarrow as pa
        import zstandard
        from pyspark import TaskContext

        data = zstandard.ZstdCompressionDict(sent.value) if sent.value else None
        compressor = zstandard.ZstdCompressor(level=level, dict_data=data)
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        out, path, records, size, made = None, "", 0, 0, []
        for ids, urls, bodies, digests, refers in rows_of(batches, "page_id", "url", "html", "sha1", "refers_to"):
            for page_id, url, body, digest, ref in zip(ids, urls, bodies, digests, refers):
                if out is None:
                    path = f"{root}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
                    out, records = store.open_output_stream(path, compression=None), 0
                    out.write(skippable(sent.value))
                    size = 8 + len(sent.value)
                frame = compressor.compress(record(page_id, url, body, base64.b32encode(digest).decode(), ref))
                out.write(frame)
                records, size = records + 1, size + len(frame)
                if size >= FILE_BYTES:
                    out.close()
                    made.append((path, records, size))
                    out = None
        if out is not None:
            out.close()
            made.append((path, records, size))
        yield pa.RecordBatch.from_pydict({"path": pa.array([m[0] for m in made], pa.string()), "records": pa.array([m[1] for m in made], pa.int64()),
                                          "bytes": pa.array([m[2] for m in made], pa.int64())})

    return materialize(joined.mapInArrow(write, "path string, records long, bytes long"), "warc-manifest")


def read_archives(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The validated records of the manifest's archives, one row each; a file is one task's stream."""
    files = max(1, manifest.count())
    folder = qualified(manifest.sparkSession, folder)

    def read(batches):
        import pyarrow as pa

        store, _ = _store(folder)
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        for paths, counts in rows_of(batches, "path", "records"):
            for path, count in zip(paths, counts):
                rows, held, n = [], 0, 0
                with store.open_input_stream(path, compression=None) as stream:
                    for data in frames(stream):
                        rows.append(parse_record(data))
                        n, held = n + 1, held + len(data)
                        if not payloads:
                            rows[-1]["payload"] = None
                        if held > 8 << 20 or len(rows) >= 2000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                if n != count:
                    raise WarcError(f"{path} has {n} records; {count} were written")

    return manifest.select("path", "records").repartition(files).mapInArrow(read, RESULT)


#: Five hex digits of the SHA-1 are four base32 digits.
ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::INTEGER >> (15 - 5 * (i % 4)))::INTEGER & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""
