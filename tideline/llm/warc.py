"""WARC archives: write one gzip member per record, read them back in byte ranges.

The reader is splittable: a task takes a byte range of a file, looks for gzip magic, inflates the
start of each candidate, accepts it only if a WARC header follows, and then owns every record
that begins inside its range, reading past the end of the range for the last one. Files are
opened through Arrow's file systems, so the archive folder may be on any store that Arrow and
Spark both reach. A retried writer task writes a file of another name, and only files of the
tasks that succeeded are in the manifest.
"""

from __future__ import annotations

import base64
import os
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.shared import shared_dir, stored, table

LEAST_BYTES = 1000          # payloads from this size on may be revisited
RANGE_BYTES = 8 << 20
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

WRITTEN = "file string, bytes bigint, records bigint"
RECORD = ("page_id bigint, url string, record_type string, payload_digest string, payload_bytes bigint, "
          "refers_to bigint, payload binary, file string, offset bigint")


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.UUID(int=(0 if page_id is None else page_id) % (1 << 64))}>"


def _member(page_id, url, digest: bytes, payload: bytes, refers_to, is_revisit: bool) -> bytes:
    """One record as a gzip member. Line ends in a url are percent-encoded."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if is_revisit else http + payload
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
        f"Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    if url is None:
        lines.append("Page-URL: none")
    if is_revisit:
        lines += [f"WARC-Refers-To: {_record_id(refers_to)}", f"Refers-To-Page-ID: {refers_to}", f"WARC-Profile: {PROFILE}"]
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, records, path = None, 0, 0, f"{folder}/{uuid.uuid4().hex}.warc.gz"
        for batch in batches:
            for row in range(batch.num_rows):
                page_id, url, digest, payload, refers_to, revisit = (batch.column(k)[row].as_py() for k in range(6))
                if out is None:
                    system, name = _file_system(path)
                    system.create_dir(os.path.dirname(name), recursive=True)
                    out = system.open_output_stream(name, compression=None)
                member = _member(page_id, url, digest, payload, refers_to, revisit)
                out.write(member)
                size, records = size + len(member), records + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"file": path, "bytes": size, "records": records}])
    return run


def write_warc(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) below ``folder``.

    The payload is the html in UTF-8, empty for null. Of equal payloads of at least
    ``least_bytes`` the one with the largest page_id is a response (all rows that tie on it are),
    the others are revisits of it; rows without page_id are responses. Other columns are ignored.
    Returns the manifest (file, bytes, records), itself stored so that nothing is written twice.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url",
                        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload"))
    keyed = rows.withColumn("digest", F.unhex(F.sha1("payload"))).withColumn("same", F.sha2("payload", 256))
    first = (keyed.where(F.col("size") >= least_bytes).groupBy("same")
             .agg(F.max("page_id").alias("last"), F.count("*").alias("held")).where("held > 1 and last is not null"))
    joined = keyed.join(first, "same", "left").withColumn("revisit", F.coalesce(F.col("page_id") < F.col("last"), F.lit(False)))
    ready = joined.select("page_id", "url", "digest", "payload", "last", "revisit")
    return stored(ready.mapInArrow(_writer(folder), WRITTEN))


class _Window:
    """Bytes of a file from some place on, read in pieces as they are needed."""

    def __init__(self, path: str):
        system, name = _file_system(path)
        self.file = system.open_input_file(name)
        self.size = self.file.size()

    def read(self, at: int, length: int) -> bytes:
        length = min(length, self.size - at)
        return self.file.read_at(length, at) if length > 0 else b""


def _header(raw: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields and where the block begins, or None if these bytes are no WARC record."""
    end = raw.find(b"\r\n\r\n")
    if not raw.startswith(b"WARC/1.") or end < 0:
        return None
    fields = {}
    for line in raw[:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if "warc-type" not in fields or not fields.get("content-length", "").isdigit():
        return None
    return fields, end + 4


def _inflate(window: _Window, at: int, piece: int = 1 << 18) -> tuple[dict[str, str], bytes, int] | None:
    """(header, block, offset behind the member) of a record at ``at``; None if there is none."""
    inflater, raw, where = zlib.decompressobj(31), bytearray(), at
    head, end = None, -1
    while not inflater.eof:
        part = window.read(where, piece if raw else 1 << 14)
        if not part:
            return None
        where += len(part)
        try:
            got = inflater.decompress(part)
        except zlib.error:
            return None
        seen = len(raw)
        raw += got
        if end < 0:
            if not raw.startswith(b"WARC/1."[:len(raw)]):
                return None
            # A header ends where it ends, however long an address in it.
            end = raw.find(b"\r\n\r\n", max(seen - 3, 0))
            if end >= 0:
                head = _header(bytes(raw[:end + 4]))
                if head is None:
                    return None
    if head is None:
        return None
    fields, start = head
    return fields, bytes(raw[start:start + int(fields["content-length"])]), where - len(inflater.unused_data)


def _records(path: str, start: int, stop: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Records of ``path`` that begin in [start, stop)."""
    window, at = _Window(path), start
    stop = min(stop, window.size)
    chunk, base = b"", start
    while at < stop:
        found = _inflate(window, at) if window.read(at, 3) == MAGIC else None
        if found:
            yield at, found[0], found[1]
            at = found[2]
            continue
        at += 1
        while at < stop:      # no record here: on to the next place with gzip magic
            if not base <= at < base + len(chunk) - 2:
                base, chunk = at, window.read(at, min(1 << 20, stop - at + 2))
            hit = chunk.find(MAGIC, at - base)
            if hit >= 0:
                at = base + hit
                break
            at = max(at + 1, base + len(chunk) - 2)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in RECORD.split(", ")]
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in RECORD.split(", ")])
    rows, held = [], 0
    for batch in batches:
        for part in batch.to_pylist():
            for at, fields, block in _records(part["file"], part["start"], part["stop"]):
                split = block.find(b"\r\n\r\n") + 4
                revisit = fields["warc-type"] == "revisit"
                algorithm, _, digest = fields.get("warc-payload-digest", "").partition(":")
                page, refers = fields.get("page-id"), fields.get("refers-to-page-id")
                payload = None if revisit else block[split:]
                rows.append(dict(zip(names, (
                    int(page) if page else None, None if "page-url" in fields else fields.get("warc-target-uri"),
                    fields["warc-type"], base64.b32decode(digest).hex() if algorithm == "sha1" else None,
                    int(fields.get("payload-length", len(payload or b""))),
                    int(refers) if revisit and refers else None, payload, part["file"], at))))
                held += len(block) + 500
                if held > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def read_warc(manifest: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records of the files in ``manifest`` (file, bytes), read in ranges of ``range_bytes``.

    Returns page_id, url, record_type, payload_digest (hex), payload_bytes, refers_to, payload
    (null for revisits), file, offset. Bytes that are no WARC record are passed over.
    """
    starts = F.explode(F.expr(f"sequence(0L, greatest(bytes - 1, 0L), {int(range_bytes)}L)"))
    ranges = manifest.where("bytes > 0").select("file", starts.alias("start"))
    ranges = ranges.select("file", "start", (F.col("start") + range_bytes).alias("stop"))
    # As many tasks as ranges: a given number is not coalesced, although the rows are tiny.
    tasks = manifest.agg(F.sum(F.ceil(F.col("bytes") / range_bytes))).first()[0] or 1
    return ranges.repartition(int(min(tasks, 100_000)), "file", "start").mapInArrow(_reader, RECORD)


def incomplete_files(manifest: DataFrame, records: DataFrame) -> DataFrame:
    """Files of which another number of records was read than was written: file, records, found."""
    found = records.groupBy("file").agg(F.count(F.lit(1)).alias("found"))
    return manifest.select("file", "records").join(found, "file", "left").select(
        "file", "records", F.coalesce("found", F.lit(0)).alias("found")).where("records <> found")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    records = read_warc(write_warc(table(spark, sf_dir, "pages"), folder))
    # Payload figures of a response come from the bytes read back, those of a revisit from its header.
    whole = F.col("record_type") == "response"
    return records.select(
        "page_id",
        F.when(whole, F.octet_length("payload")).otherwise(F.col("payload_bytes")).cast("bigint").alias("payload_bytes"),
        F.when(whole, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", "refers_to")
