"""WARC archives: written by tasks with repeated payloads as revisits, read back by byte ranges.

Writing: every task writes one ``.warc.gz`` into the shared folder, each record a gzip member of its own. A file's name
holds the task attempt, and only files of attempts whose manifest row came through are read, so a lost or repeated task
leaves nothing double. Reading: archives are cut into byte ranges; a task looks for gzip magic in its range, takes a
hit for a member if it decodes to a WARC header and is followed by another magic or the end of the file, owns the
records that start inside its range, and reads past the range's end to finish the last one.

Files are opened through ``pyarrow.fs``, which reaches local, HDFS and S3 folders.

Defined cases: a null html is an empty payload; among rows of equal payload all rows with the smallest id are
responses, the others revisit it, and rows with a null id are responses that nothing refers to; a null url is an empty
target; an empty table writes no archive and reads back as no rows; other columns are neither read nor returned.
Payloads are text, in which the magic's bytes can't follow each other; a payload that is itself a stored gzip WARC
would defy any reader that starts in mid-file.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, shared_folder, table

MAGIC = b"\x1f\x8b\x08"
RANGE_BYTES = 8 << 20
READ_BYTES = 256 << 10
GZIP_LEVEL = 2
# Fixed value: the profile of a revisit whose payload equals an earlier one's.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "path string, bytes long, records long"
RECORD = "path string, offset long, record_type string, record_id string, target string, refers_to string, payload_bytes long, payload_digest string, payload binary"
_ARROW_RECORD = pa.schema([
    ("path", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("target", pa.string()),
    ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
])


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_urn(page_id: object) -> str:
    return "<urn:page:" + ("" if page_id is None else quote(str(page_id), safe="")) + ">"


def _member(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), *fields, ("Content-Length", str(len(block)))])
    z = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return z.compress(f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n") + z.flush()


def page_record(page_id: object, url: str | None, payload: bytes, first: object, date: str) -> bytes:
    """One gzip member: a response, or a revisit if ``first`` is the id of another page with this payload."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [
        ("WARC-Record-ID", page_urn(page_id)), ("WARC-Date", date), ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{digest32(payload)}"), ("Content-Type", "application/http; msgtype=response"),
    ]
    if first is None or first == page_id:
        return _member("response", fields, http + payload)
    return _member("revisit", [*fields, ("WARC-Refers-To", page_urn(first)), ("WARC-Profile", SAME_PAYLOAD)], http)


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else "file://" + os.path.abspath(folder))


def with_first(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """_id, _url, _payload (binary) and _first: the smallest id of the rows of that payload, if it occurs again.

    Ids and digests are grouped (partial sums first, so a payload that most pages share is no burden); of that only
    the repeated payloads are joined back, from a checkpoint, so that Spark can split a skewed side.
    """
    d = pages.select(F.col("page_id").alias("_id"), F.col("url").alias("_url"), F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("_payload"))
    d = d.withColumn("_sha", F.sha1("_payload")).withColumn("_bytes", F.octet_length("_payload"))
    again = cut(
        d.where(F.col("_bytes") >= min_bytes).groupBy("_sha", "_bytes")
        .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    )
    # A row without an id refers to no other, and (min ignores it) no other refers to it.
    return d.join(again, ["_sha", "_bytes"], "left").select("_id", "_url", "_payload", F.when(F.col("_id").isNotNull(), F.col("_first")).alias("_first"))


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0, date: str | None = None) -> DataFrame:
    """Writes the archives; returns their manifest (path, bytes, records), already computed."""
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    fs, root = _open(folder)
    fs.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        fs, root = _open(folder)
        name = f"{root}/part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        out, size, n = None, 0, 0
        try:
            for b in batches:
                for page_id, url, payload, first in zip(*(c.to_pylist() for c in b.columns)):
                    if out is None:
                        out = fs.open_output_stream(name, compression=None)
                        size += out.write(_member("warcinfo", [("WARC-Record-ID", f"<urn:file:{os.path.basename(name)}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                    size += out.write(page_record(page_id, url, payload, first, date))
                    n += 1
        finally:
            if out is not None:
                out.close()
        if n:
            yield pa.RecordBatch.from_pydict({"path": [os.path.basename(name)], "bytes": [size], "records": [n]})

    return cut(with_first(pages, min_bytes).mapInArrow(write, MANIFEST))


class _Window:
    """Bytes of a file by position, a block at a time."""

    def __init__(self, f: pa.NativeFile, size: int):
        self.f, self.size, self.base, self.data = f, size, 0, b""

    def at(self, pos: int) -> bytes:
        """What follows ``pos``, at least three bytes unless the file ends."""
        if not self.base <= pos <= self.base + len(self.data) - len(MAGIC):
            self.f.seek(pos)
            self.base, self.data = pos, self.f.read(READ_BYTES)
        return self.data[pos - self.base :]

    def magic(self, pos: int, end: int) -> int | None:
        """The first magic that starts in [pos, end)."""
        while pos < end:
            data = self.at(pos)
            if (hit := data.find(MAGIC)) >= 0:
                return pos + hit if pos + hit < end else None
            if len(data) < len(MAGIC):
                return None
            pos += len(data) - len(MAGIC) + 1
        return None

    def member(self, pos: int) -> tuple[bytes, int] | None:
        """The WARC record that is the gzip member at ``pos``, and where the member ends; None if there's none."""
        z, out, p = zlib.decompressobj(31), [], pos
        try:
            while not z.eof:
                data = self.at(p)
                if not data:
                    return None
                out.append(z.decompress(data))
                p += len(data)
                if len(out) == 1 and out[0] and not b"WARC/1.".startswith(out[0][:7]):
                    return None
        except zlib.error:
            return None
        end, record = p - len(z.unused_data), b"".join(out)
        if not record.startswith(b"WARC/1.") or end < self.size and not self.at(end).startswith(MAGIC):
            return None
        return record, end


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of a record; ValueError if its length is wrong."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode("utf-8").split("\r\n")[1:])}
    size = int(fields["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('warc-record-id')}: the block isn't {size} bytes long")
    return fields, rest[:size]


def _row(path: str, offset: int, record: bytes, keep_payload: bool) -> tuple:
    fields, block = parse_record(record)
    kind = fields["warc-type"]
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    payload = size = None
    if fields.get("content-type", "").startswith("application/http"):
        http, _, body = block.partition(b"\r\n\r\n")
        if kind == "response":
            payload, size = body, len(body)
            if digest32(body) != digest:
                raise ValueError(f"record {fields['warc-record-id']}: the payload doesn't have its digest")
        elif m := re.search(rb"(?im)^content-length:\s*([0-9]+)", http):
            size = int(m[1])
    return (path, offset, kind, fields["warc-record-id"], fields.get("warc-target-uri"), fields.get("warc-refers-to"), size, digest, payload if keep_payload else None)


def read_warc(spark: SparkSession, folder: str, manifest: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """The records of the archives of a manifest (path in ``folder``, bytes); ``payloads=False`` leaves that column null.

    Payload digests of responses are verified. payload_bytes of a revisit is what its HTTP header says.
    """
    sizes = manifest.select("path", F.col("bytes"))
    ranges = sizes.select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    n = ranges.count()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        for b in batches:
            for path, size, start in zip(*(c.to_pylist() for c in b.columns)):
                with fs.open_input_file(f"{root}/{path}") as f:
                    w, pos, end, rows, held = _Window(f, size), start, min(start + range_bytes, size), [], 0
                    while (hit := w.magic(pos, end)) is not None:
                        found = w.member(hit)
                        if found is None:
                            pos = hit + 1
                            continue
                        record, pos = found
                        rows.append(_row(path, hit, record, payloads))
                        held += len(record) if payloads else 200
                        if held >= 4 << 20:
                            yield pa.RecordBatch.from_pylist([dict(zip(_ARROW_RECORD.names, r)) for r in rows], _ARROW_RECORD)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist([dict(zip(_ARROW_RECORD.names, r)) for r in rows], _ARROW_RECORD)

    return ranges.repartition(max(1, n)).mapInArrow(scan, RECORD)


def page_id_of(urn: str) -> Column:
    return F.regexp_extract(F.col(urn), r"^<urn:page:(.*)>$", 1)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    records = read_warc(spark, folder, write_warc(pages, folder), payloads=False).where(F.col("record_type").isin("response", "revisit"))
    kind = pages.schema["page_id"].dataType
    as_id = lambda c: F.when(page_id_of(c) != "", page_id_of(c)).cast(kind)
    return records.select(as_id("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", as_id("refers_to").alias("refers_to"))
