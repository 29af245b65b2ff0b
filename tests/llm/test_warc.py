import base64
import hashlib
import io
import os

import pytest
import zstandard
from pyspark.sql import functions as F

from commerce_lake.llm import warc


def test_round_trip(spark, scratch):
    rows = [(5, "http://a/", "<p>é</p>"), (3, "http://b/", "<p>é</p>"), (9, None, None), (8, "u\r\nx", ""), (3, "http://b/", "<p>é</p>"), (None, "n", "<p>é</p>"), (None, "n", "alone"),
            (20, "big", "a\r\n\r\nb" * 400_000)] + [(100 + i, f"http://c/{i}", "<html><body>" + f"text {i} " * (i + 5)) for i in range(200)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, sha1 string")
    folder = f"file://{scratch}/w"
    out = warc.read_archives(warc.write_archives(pages, folder), folder).collect()
    assert len(out) == len(rows)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = []
    for i, _, h in rows:
        body = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        ref = first.get(h or "") if first.get(h or "") != i else None
        want.append((i, len(body), digest, "revisit" if ref is not None else "response", ref, body if ref is None else None))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload) if r.payload is not None else None) for r in out), key=key) == sorted(want, key=key)
    names = [n for n in os.listdir(f"{scratch}/w") if n.endswith(".warc.zst")]
    data = open(f"{scratch}/w/{names[0]}", "rb").read()
    assert data[:4] == bytes.fromhex("5d2a4d18")
    none = warc.write_archives(pages.where(F.lit(False)), f"file://{scratch}/n")
    assert warc.read_archives(none, f"file://{scratch}/n").count() == 0
    all_full = warc.read_archives(warc.write_archives(pages, f"file://{scratch}/l", least_bytes=1 << 30), f"file://{scratch}/l")
    assert all_full.where("record_type = 'response'").count() == len(rows)


def archive(*records, dictionary=b""):
    c = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    return warc.skippable(dictionary) + b"".join(map(c.compress, records))


def test_damage_is_found():
    body = b"<p>x</p>"
    good = warc.record(1, "u", body, warc.sha1_base32(body), None)
    assert warc.parse_record(good)["payload"] == body
    assert list(warc.frames(io.BytesIO(archive(good, good)))) == [good, good]
    assert list(warc.frames(io.BytesIO(b""))) == []
    for bad in (good.replace(b"WARC/1.1", b"WARC/9.9"), good[:-4] + b"xxxx", good.replace(body, b"<p>y</p>"), good.replace(b"WARC-Date", b"X"),
                good.replace(b"Content-Length: 8", b"Content-Length: 7"), good.replace(b"urn:page:1", b"urn:page:z"), good[:30]):
        with pytest.raises(warc.WarcError):
            warc.parse_record(bad)
    with pytest.raises(warc.WarcError):
        list(warc.frames(io.BytesIO(archive(good)[8:])))
    with pytest.raises(warc.WarcError):
        list(warc.frames(io.BytesIO(archive(good)[:-3])))
