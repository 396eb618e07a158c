"""WARC archives: exact round trip, revisits, broken archives."""

import glob
import hashlib
import os
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from trendlens.llm import warc


def pages():
    rows = [(i, f"http://h{i % 7}.example/{i}", f"<html><body>page {i} " + f"text {i} " * (i % 40) + "</body></html>")
            for i in range(200)]
    long = "<p>the same long body " + "x" * 200 + "</p>"
    rows += [(300 + i, f"http://copy.example/{i}", long) for i in range(60)]
    rows += [(299, "http://copy.example/first", long), (500, None, None), (501, "http://e.example/", ""),
             (None, "http://n.example/", "no id " * 40), (502, "http://é.example/ü\r\nX: y", "größer 😀 " * 30),
             (503, "u", "short"), (504, "u", "short"), (505, "u", "WARC/1.1\r\n\r\n" * 20),
             (299, "http://copy.example/first", long), (None, "http://copy.example/none", long),
             (506, "u", "y" * 300_000)]
    return rows


def expected(rows):
    out = []
    for i, _, html in rows:
        payload = (html or "").encode()
        same = [j for j, _, h in rows if h == html and j is not None] if len(payload) >= 100 else []
        first = min(same, default=None)
        revisit = len([1 for _, _, h in rows if h == html]) > 1 and first is not None and i != first
        out.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response",
                    first if revisit else None))
    return out


def key(r):
    return tuple((x is None, x) for x in r)


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn(
        "payload", F.lit("clash")).withColumn("digest", F.lit(1)).withColumn("first", F.lit(2))


@pytest.mark.parametrize("archive_bytes", [warc.ARCHIVE_BYTES, 2000])
def test_round_trip(spark, workdir, archive_bytes):
    rows = pages()
    manifest = warc.write_archives(frame(spark, rows).repartition(3), workdir, archive_bytes)
    files = glob.glob(os.path.join(workdir, "*.warc.zst"))
    assert len(files) == manifest.count() and (len(files) > 10 or archive_bytes > 2000)
    assert all(os.path.getsize(f.path) == f.bytes for f in manifest.collect())
    records = warc.read_records(spark, workdir)
    payloads = {(r.page_id, bytes(r.payload)) for r in records.filter("record_type = 'response'").collect()}
    assert payloads == {(i, (h or "").encode()) for (i, _, h), e in zip(rows, expected(rows)) if e[3] == "response"}
    got = warc.resolve_revisits(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected(rows), key=key)
    urls = {r.page_id: r.url for r in records.collect()}
    assert urls[500] is None and urls[502] == "http://é.example/ü%0D%0AX: y"


def test_dictionary_comes_from_the_leading_frame(spark, workdir):
    warc.write_archives(frame(spark, pages()).coalesce(1), workdir)
    data = open(glob.glob(os.path.join(workdir, "*.warc.zst"))[0], "rb").read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == warc.SKIPPABLE
    with pytest.raises(zstandard.ZstdError):  # the records need it
        zstandard.ZstdDecompressor().decompressobj().decompress(data[8 + size:])
    assert len(list(warc.read_archive(data))) == len(pages())


def test_orphans_of_failed_attempts_are_not_read(spark, workdir):
    warc.write_archives(frame(spark, pages()), workdir)
    with open(os.path.join(workdir, "part-00000-999-0000.warc.zst"), "wb") as f:
        f.write(b"cut off")
    assert warc.read_records(spark, workdir).count() == len(pages())


def test_a_listed_archive_that_is_gone_raises(spark, workdir):
    warc.write_archives(frame(spark, pages()), workdir, 2000)
    os.remove(sorted(glob.glob(os.path.join(workdir, "*.warc.zst")))[0])
    with pytest.raises(Exception, match="listed in the manifest, but not in the folder"):
        warc.read_records(spark, workdir).collect()


def archive(*records, dictionary=b""):
    press = zstandard.ZstdCompressor(write_checksum=True)
    return warc.archive_head(dictionary) + b"".join(map(press.compress, records))


def good():
    return warc.format_record(1, "http://a/", b"payload", hashlib.sha256(b"payload").hexdigest(), None)


def test_broken_archives():
    whole = archive(good(), good())
    assert [warc.parse_record(r)[1] for r in warc.read_archive(whole)] == [b"payload"] * 2
    flipped = whole[:-10] + bytes([whole[-10] ^ 255]) + whole[-9:]
    for bad in (whole[:-5], flipped, whole + b"\x00\x01"):
        with pytest.raises(warc.WarcError):
            list(warc.read_archive(bad))
    with pytest.raises(warc.WarcError):
        warc.load_dictionary(memoryview(struct.pack("<II", warc.SKIPPABLE, 99) + b"short"))
    assert list(warc.read_archive(b"")) == []


@pytest.mark.parametrize("change", [
    (b"WARC/1.1", b"WARC/0.9"), (b"Content-Length: ", b"Content-Length: 1"), (b"WARC-Date: ", b"X-Date: "),
    (b"WARC-Type: response", b"WARC-Type response"), (b"\r\n\r\npayload\r\n\r\n", b"\r\n\r\npayload\r\n"),
    (b"Content-Length: ", b"Content-Length: x")])
def test_broken_records(change):
    with pytest.raises(warc.WarcError):
        warc.parse_record(good().replace(*change))


def test_empty_table(spark, workdir):
    assert warc.write_archives(frame(spark, pages()).limit(0), workdir).collect() == []
    assert warc.resolve_revisits(warc.read_records(spark, workdir)).collect() == []
