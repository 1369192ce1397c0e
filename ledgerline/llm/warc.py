"""WARC archives: a writer with revisit records and a splittable reader.

``write_archives`` turns page rows into WARC/1.1 files of one gzip member per
record. Of the records with equal payloads of at least ``min_bytes`` bytes the
one with the largest page id is the response, the others are revisits that
refer to it; smaller payloads are always responses. Who refers to whom is
settled on ids and digests alone, then the pages are shuffled once by page id
and digest, so a payload that very many pages share is spread over all
tasks. A task names its files after its partition and attempt and reports them
in manifest rows that Spark commits with the task; files of failed or
repeated attempts are in no manifest and are never read.

``read_archives`` cuts the files of a manifest into byte ranges. A task scans
its range for the gzip magic, takes a place as a member only if it decodes,
checksum included, to a WARC header and is followed by another magic or the
end of the file, and from there follows the members. It owns the records that
start inside its range and reads the last one beyond its end. A damaged
member is passed over to the next valid one. The writer breaks up any gzip
magic inside a record, so its own archives split exactly; in an archive by
another writer that stores an archive uncompressed inside a record, a range
that starts there can take the inner records for outer ones.

Nulls: a null payload is empty, a null url gives no target header, a null page
id gives a record without one (it can revisit, never be revisited). Rows that
repeat a page id and payload give one response and revisits of it. An empty
table gives no files and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import os
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.common import Scratch, map_arrow, open_fs, shared_folder, sized_partitions, stored

FILE_BYTES = 1 << 30
SPLIT_BYTES = 16 * 1024 * 1024
LEVEL = 6
MAGIC = b"\x1f\x8b\x08"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_ID = -(1 << 63)

MANIFEST = "path string, bytes long, records long"
RECORD = ("path string, offset long, record_type string, page_id long, target_uri string, "
          "payload_bytes long, payload_digest string, refers_to long, payload binary")


def record_id(page_id: int | None, repeat: int = 0) -> str:
    """A version 8 UUID that holds the page id, or none, and the number of an
    equal earlier record."""
    p = (page_id or 0) & (1 << 64) - 1
    value = (0x6C6C << 32 | repeat & 0xFFFFFFFF) << 80 | 0x8 << 76
    value |= ((0 if page_id is not None else 0x800) | p >> 62) << 64
    value |= 0b10 << 62 | p & (1 << 62) - 1
    h = f"{value:032x}"
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def page_of(record: str) -> int | None:
    """The page id in a record id of ``record_id``, else None."""
    value = int(record.strip("<>").removeprefix("urn:uuid:").replace("-", ""), 16)
    high = value >> 64 & 0xFFF
    if value >> 112 != 0x6C6C or high & 0x800:
        return None
    p = (high & 3) << 62 | value & (1 << 62) - 1
    return p - (1 << 64) if p >> 63 else p


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_text(value: str) -> str:
    """Control characters and blanks percent-encoded: a header is one line."""
    return "".join(f"%{ord(c):02X}" if ord(c) <= 32 or ord(c) == 127 else c for c in value)


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None,
                 repeat: int = 0, date: str = DATE) -> bytes:
    """One uncompressed record; a revisit keeps the HTTP head, whose length is
    that of the full payload, and leaves the payload out."""
    head = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = head + payload if refers_to is None else head
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {record_id(page_id, repeat)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_text(url)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    lines += [f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
              "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def gzip_member(record: bytes, level: int = LEVEL) -> bytes:
    """A record as one gzip member. Incompressible data is stored as it is; a
    flush inside every gzip magic of the record (a payload can be an archive)
    sees to it that none shows, so readers find the member's own only."""
    if MAGIC not in record:
        return zlib.compress(record, level, 31)
    coder, out, at = zlib.compressobj(level, zlib.DEFLATED, 31), [], 0
    while (hit := record.find(MAGIC, at)) >= 0:
        out += [coder.compress(record[at:hit + 1]), coder.flush(zlib.Z_FULL_FLUSH)]
        at = hit + 1
    return b"".join([*out, coder.compress(record[at:]), coder.flush()])


def _info_record(name: str) -> bytes:
    block = b"software: ledgerline\r\nformat: WARC File Format 1.1\r\n"
    return ("WARC/1.1\r\nWARC-Type: warcinfo\r\n"
            f"WARC-Record-ID: {record_id(None, zlib.crc32(name.encode()))}\r\nWARC-Date: {DATE}\r\n"
            f"Content-Type: application/warc-fields\r\nContent-Length: {len(block)}\r\n\r\n").encode() \
        + block + b"\r\n\r\n"


def _writer(folder: str, file_bytes: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        stem = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}"
        out, name, size, records, number = None, "", 0, 0, 0
        last, repeat = None, 0

        def manifest() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [name], "bytes": [size], "records": [records]})

        for b in batches:
            for row in b.to_pylist():
                if out is not None and size >= file_bytes:
                    yield manifest()
                    out, number = None, number + 1
                if out is None:
                    name = f"{stem}-{number:04d}.warc.gz"
                    fs, path = open_fs(name)
                    fs.create_dir(os.path.dirname(path), recursive=True)
                    out = fs.open_output_stream(path, compression=None)
                    size, records = out.write(gzip_member(_info_record(name), level)), 0
                page, keep = row["page_id"], row["keep"]
                repeat = repeat + 1 if (page, row["digest"]) == last else 0
                last = (page, row["digest"])
                refers = None if keep is None or (keep == page and not repeat) else keep
                data = build_record(page, row["url"], row["payload"] or b"", refers, repeat)
                size += out.write(gzip_member(data, level))
                records += 1
        if out is not None:
            yield manifest()
    return run


def write_archives(pages: DataFrame, min_bytes: int = 0, folder: str | None = None,
                   file_bytes: int = FILE_BYTES, level: int = LEVEL) -> DataFrame:
    """Write ``pages(page_id, url, html)``; returns the stored manifest
    ``(path, bytes, records)``."""
    spark = pages.sparkSession
    folder = folder or shared_folder(spark, "warc")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn(
        "_pid", F.coalesce("page_id", F.lit(NO_ID)))
    slim = rows.where(F.octet_length("payload") >= min_bytes).select("page_id", "_pid", "digest")
    n = sized_partitions(pages, "html")
    with Scratch() as scratch:
        groups = scratch.store(slim.groupBy("digest").agg(F.max("page_id").alias("keep"), F.count("*").alias("n"))
                               .where("n > 1 and keep is not null").select("digest", "keep"), "warc-groups")
        shared = scratch.store(slim.join(groups, "digest").select("_pid", "digest", "keep").distinct(),
                               "warc-shared")
        spread = rows.repartition(n, "_pid", "digest")
        ready = (spread.join(shared, ["_pid", "digest"], "left")
                 .sortWithinPartitions("_pid", "digest", "url")
                 .select("page_id", "url", "payload", "digest", "keep"))
        return stored(map_arrow(ready, _writer(folder, file_bytes, level), MANIFEST), "warc-manifest")


class ByteWindow:
    """Forward reads of a file through one buffer."""

    def __init__(self, source, size: int, ahead: int = 1 << 20):
        self.source, self.size, self.ahead = source, size, ahead
        self.base, self.data = 0, b""

    def get(self, at: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``at``; fewer only at the end of the file."""
        n = max(0, min(n, self.size - at))
        if at < self.base or at + n > self.base + len(self.data):
            self.base, self.data = at, self.source.read_at(min(max(n, self.ahead), self.size - at), at)
        return self.data[at - self.base:at - self.base + n]


def read_member(window: ByteWindow, at: int, piece: int = 16_384) -> tuple[bytes, int] | None:
    """The decoded WARC member at ``at`` and where the next one starts; None
    unless it is whole, a WARC record, and followed by a member or the end."""
    if window.get(at, 3) != MAGIC:
        return None
    decoder, out, got, pos = zlib.decompressobj(31), [], 0, at
    try:
        while not decoder.eof:
            data = window.get(pos, piece)
            if not data:
                return None
            pos += len(data)
            out.append(decoder.decompress(data))
            got += len(out[-1])
            if got and not b"".join(out[:8])[:7].startswith(b"WARC/1."[:min(got, 7)]):
                return None
    except zlib.error:
        return None
    end = pos - len(decoder.unused_data)
    if end < window.size and window.get(end, 3) != MAGIC:
        return None
    data = b"".join(out)
    return (data, end) if data.startswith(b"WARC/1.") else None


def find_member(window: ByteWindow, start: int, stop: int) -> int | None:
    """The first valid member that starts in ``[start, stop)``."""
    at = start
    while at < stop:
        data = window.get(at, min(1 << 20, stop - at) + len(MAGIC) - 1)
        hit = data.find(MAGIC)
        if hit < 0:
            at += max(1, len(data) - len(MAGIC) + 1)
            continue
        at += hit
        if at >= stop:
            return None
        if read_member(window, at) is not None:
            return at
        at += 1
    return None


def members(window: ByteWindow, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """Offset and data of the records that start in ``[start, stop)``."""
    at = find_member(window, start, stop)
    while at is not None and at < stop:
        found = read_member(window, at)
        if found is None:                       # damaged: on to the next valid one
            at = find_member(window, at + 1, stop)
            continue
        yield at, found[0]
        at = found[1] if found[1] < window.size else None


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, names in lower case, and the block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        key, _, value = line.partition(":")
        headers[key.strip().lower()] = value.strip()
    return headers, rest[:int(headers.get("content-length", len(rest)))]


def _row(path: str, at: int, data: bytes, with_payload: bool) -> dict | None:
    headers, block = parse_record(data)
    kind = headers.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    head, _, payload = block.partition(b"\r\n\r\n")
    row = {"path": path, "offset": at, "record_type": kind, "page_id": page_of(headers["warc-record-id"]),
           "target_uri": headers.get("warc-target-uri"), "payload_bytes": len(payload),
           "payload_digest": payload_digest(payload), "refers_to": None,
           "payload": payload if with_payload else None}
    if kind == "revisit":
        sizes = [x.partition(b":")[2] for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        row |= {"payload_bytes": int(sizes[0]), "payload": None,
                "payload_digest": headers["warc-payload-digest"].removeprefix("sha1:"),
                "refers_to": page_of(headers["warc-refers-to"])}
    elif headers.get("warc-payload-digest", "") != f"sha1:{row['payload_digest']}":
        raise ValueError(f"{path} at {at}: the payload does not match its digest")
    return row


def _reader(with_payload: bool):
    schema = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()),
                        ("page_id", pa.int64()), ("target_uri", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in b.to_pylist():
                fs, path = open_fs(part["path"])
                rows, size = [], 0
                with fs.open_input_file(path) as source:
                    window = ByteWindow(source, part["bytes"])
                    for at, data in members(window, part["first"], part["last"]):
                        row = _row(part["path"], at, data, with_payload)
                        if row:
                            rows.append(row)
                            size += len(row["payload"] or b"")
                        if len(rows) >= 5000 or size >= 1 << 25:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)
    return run


def read_archives(manifest: DataFrame, split_bytes: int = SPLIT_BYTES, with_payload: bool = True) -> DataFrame:
    """The response and revisit records of the files of ``manifest``, one row
    each, with where they were found. A revisit's length and digest are those
    of the full payload."""
    step = F.lit(split_bytes).cast("long")
    ranges = manifest.where("bytes > 0").select(
        "path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, step)).alias("first"))
    ranges = ranges.withColumn("last", F.least(F.col("first") + step, F.col("bytes")))
    # a row per range, dealt round robin so that every core reads
    spread = ranges.repartition(max(1, manifest.sparkSession.sparkContext.defaultParallelism * 2))
    return map_arrow(spread, _reader(with_payload), RECORD)
