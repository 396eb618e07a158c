"""WARC archives compressed with Zstandard, one frame per record.

An archive begins with a skippable frame that holds the dictionary its
records are compressed with (itself a Zstandard frame); every record is a
frame of its own, with its size and a checksum.  Archives are written by the
tasks that hold the records, under names that no other attempt uses, and
count only once they are listed in the returned manifest, so a task that is
run again leaves nothing that is read.  Reading goes through Spark's binary
file source.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.llm.common import bounded_sample, python_workers, written

VERSION = b"WARC/1.1"
SKIPPABLE = 0x184D2A5D  # magic number of the frame that holds the dictionary
LEVEL = 3
ARCHIVE_BYTES = 16 << 20  # an archive is closed once it holds so many bytes
# The dictionary is trained on the payloads of so many pages, those with small
# hashes of page_id and url, of each so many leading characters.
DICTIONARY_SAMPLES, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 8 << 10, 32 << 10
MIN_REVISIT_BYTES = 100
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122, names that are URLs
_CHUNK = 1 << 14

MANIFEST = "path string, records long, bytes long"
RECORDS = ("archive string, record_id string, page_id long, url string, record_type string, refers_to long, "
           "payload_digest string, payload_bytes long, payload binary")


class WarcError(ValueError):
    """A record or an archive that breaks the format."""


def record_id(page_id: int | None, url: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id} {digest} {url}')}>"


def _field(value: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in value)


def format_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit holds the HTTP head without the payload."""
    kind = "response" if refers_to is None else "revisit"
    block = HTTP_HEAD + (payload if refers_to is None else b"")
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page_id, url, digest)),
              ("WARC-Date", "1970-01-01T00:00:00Z"), ("Content-Type", "application/http; msgtype=response"),
              ("Content-Length", str(len(block))), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if url is not None:
        fields.append(("WARC-Target-URI", _field(url)))
    if page_id is not None:
        fields.append(("WARC-Page-ID", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To-Page-ID", str(refers_to))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    return head + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and payload of one record; checks the
    version line, the required headers, the length and the closing lines."""
    end = data.find(b"\r\n\r\n")
    if end < 0 or not data.startswith(VERSION + b"\r\n"):
        raise WarcError("not a WARC/1.1 record")
    fields: dict[str, str] = {}
    for line in data[len(VERSION) + 2:end].decode().split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or not name.strip() or name.strip().lower() in fields:
            raise WarcError(f"bad header line {line[:80]!r}")
        fields[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise WarcError(f"header {name} is missing")
    if not fields["content-length"].isdigit():
        raise WarcError("Content-Length is no number")
    block = data[end + 4:-4]
    if len(block) != int(fields["content-length"]) or data[-4:] != b"\r\n\r\n":
        raise WarcError(f"Content-Length is {fields['content-length']}, the block has {len(block)} bytes")
    body = block.find(b"\r\n\r\n")
    if body < 0:
        raise WarcError("the HTTP head does not end")
    return fields, block[body + 4:]


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary for the samples, empty if they are too few for one."""
    try:
        return zstandard.train_dictionary(size, samples, k=200, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def archive_head(dictionary: bytes) -> bytes:
    if not dictionary:
        return b""
    packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", SKIPPABLE, len(packed)) + packed


def load_dictionary(data: memoryview) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """Dictionary from the leading skippable frame, if the archive has one,
    and the place where the records begin."""
    if len(data) < 8:
        return None, 0
    magic, size = struct.unpack("<II", data[:8])
    if magic != SKIPPABLE:
        return None, 0
    if 8 + size > len(data):
        raise WarcError("the dictionary frame is cut off")
    held = bytes(data[8:8 + size])
    if held[:4] == b"\x28\xb5\x2f\xfd":
        held = zstandard.ZstdDecompressor().decompress(held)
    return zstandard.ZstdCompressionDict(held), 8 + size


def read_archive(content: bytes) -> Iterator[bytes]:
    """The records of an archive, one frame after another."""
    data = memoryview(content)
    dictionary, at = load_dictionary(data)
    reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while at < len(data):
        frame, parts = reader.decompressobj(), []
        while not frame.eof:
            chunk = data[at:at + _CHUNK]
            if not len(chunk):
                raise WarcError("the last frame is cut off")
            try:
                parts.append(frame.decompress(chunk))
            except zstandard.ZstdError as e:
                raise WarcError(f"bad frame: {e}") from None
            at += len(chunk)
        at -= len(frame.unused_data)
        yield b"".join(parts)


def payload_col(html: Column) -> Column:
    return F.encode(F.coalesce(html, F.lit("")), "UTF-8")


def plan_records(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, digest, refers_to``: of pages with equal
    payloads of ``MIN_REVISIT_BYTES`` or more, ``refers_to`` is the smallest
    page_id, NULL on the page that has it and on all smaller payloads.

    Digests are grouped without the payloads and summed per task before the
    exchange.  Rows that share the smallest page_id (repeated rows), and rows
    without page_id among copies that all lack one, are responses.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload_col(F.col("html"))
                        .alias("payload")).withColumn("digest", F.sha2("payload", 256))
    light = pages.select(F.col("page_id").cast("long").alias("page_id"), payload_col(F.col("html")).alias("p")).filter(
        F.octet_length("p") >= MIN_REVISIT_BYTES).select("page_id", F.sha2("p", 256).alias("digest"))
    firsts = written(light.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
                     .filter("n > 1 AND first IS NOT NULL").select("digest", "first"), "warc-firsts")
    same = F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(firsts, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(F.col("first").isNotNull() & ~same, F.col("first"))
        .alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as archives under ``folder`` and
    return their manifest (``path, records, bytes``), itself written there.

    ``folder`` is a path or URI that every executor reaches.  A NULL html is
    an empty payload; a NULL url or page_id has no header; an empty table
    gives an empty manifest.
    """
    spark = pages.sparkSession
    python_workers(spark)
    named = pages.filter("html IS NOT NULL").select("page_id", "url", F.substring("html", 1, SAMPLE_BYTES).alias("s"))
    sample = bounded_sample(named, ["page_id", "url"], DICTIONARY_SAMPLES)
    dictionary = train_dictionary([r["s"].encode() for r in sample.select("s").collect()])
    head, base = archive_head(dictionary), folder.rstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        fs, root = pafs.FileSystem.from_uri(base) if "://" in base or base.startswith("file:") else (
            pafs.LocalFileSystem(), base)
        fs.create_dir(root, recursive=True)
        press = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True, **(
            {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}))
        out, made = None, []
        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{len(made):04d}.warc.zst"
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    out.write(head)
                    made.append([f"{base}/{name}", 0, len(head)])
                frame = press.compress(format_record(page_id, url, payload, digest, refers_to))
                out.write(frame)
                made[-1][1] += 1
                made[-1][2] += len(frame)
                if made[-1][2] >= archive_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        columns = list(zip(*made)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()),
                                          pa.array(columns[2], pa.int64())], ["path", "records", "bytes"])

    manifest = f"{base}/manifest"
    plan_records(pages).mapInArrow(write, MANIFEST).write.mode("overwrite").parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


def read_records(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the archives under ``folder`` that its manifest lists.

    Every header, length and frame is checked, each archive's number of
    records against the manifest, and a response's payload against its
    digest; the first bad record raises :class:`WarcError`.
    ``payload_bytes`` and ``payload`` of a revisit are NULL (see
    :func:`resolve_revisits`).
    """
    python_workers(spark)
    base = folder.rstrip("/")
    name = F.substring_index("path", "/", -1).alias("name")
    listed = spark.read.schema(MANIFEST).parquet(f"{base}/manifest").select(name, "records")
    stored = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(base)
    # Listed archives that the folder lacks come without content and raise; names are met without contents.
    lost = listed.join(stored.select(name), "name", "left_anti").select(
        "name", F.lit(None).cast("binary").alias("content"), "records")
    files = stored.select(name, "content").join(listed, "name").select("name", "content", "records").unionAll(lost)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content, expected in zip(*batch.columns):
                rows, held, n = [], 0, 0
                if not content.is_valid:
                    raise WarcError(f"{path}: listed in the manifest, but not in the folder")
                for data in read_archive(content.as_py()):
                    fields, payload = parse_record(data)
                    n += 1
                    kind, claim = fields["warc-type"], fields.get("warc-payload-digest", "")
                    digest = claim.removeprefix("sha256:")
                    if kind == "response":
                        found = hashlib.sha256(payload).hexdigest()
                        if claim and found != digest:
                            raise WarcError(f"{path}: payload digest is {found}, the header says {digest}")
                        digest = found
                    number = {k: int(fields[k]) if k in fields else None
                              for k in ("warc-page-id", "warc-refers-to-page-id")}
                    rows.append((path.as_py(), fields["warc-record-id"], number["warc-page-id"],
                                 fields.get("warc-target-uri"), kind, number["warc-refers-to-page-id"], digest,
                                 len(payload) if kind == "response" else None,
                                 payload if with_payload and kind == "response" else None))
                    held += len(payload)
                    if held > _BATCH_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
                if n != expected.as_py():
                    raise WarcError(f"{path}: {n} records, the manifest says {expected}")
                if rows:
                    yield _batch(rows)

    return files.mapInArrow(read, RECORDS)


_BATCH_BYTES = 8 << 20


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(),
             pa.binary()]
    names = [f.split()[0] for f in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records`` with the payload size of the response that each revisit
    refers to; the response is met by digest and page_id, without payloads."""
    light = written(records.drop("payload"), "warc-records")
    sizes = (light.filter("record_type = 'response' AND page_id IS NOT NULL")
             .groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("size")))
    revisits = light.filter("record_type = 'revisit'").join(
        written(sizes.join(light.filter("record_type = 'revisit'").select("refers_to", "payload_digest").distinct(),
                           ["refers_to", "payload_digest"], "left_semi"), "warc-sizes"),
        ["refers_to", "payload_digest"], "left")
    whole = light.filter("record_type <> 'revisit'")
    return whole.unionByName(revisits.withColumn("payload_bytes", F.col("size")).drop("size"))
