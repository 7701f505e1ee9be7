"""WARC archives: a writer with revisit records, and a sequential reader.

The reader inflates one gzip member per record chunk by chunk, frames the block by its content length and checks the
block and payload digests.
"""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.parse
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import file_system, lean, new_folder, pinned, text_bytes

REVISIT_FROM = 1000
ARCHIVE_BYTES = 64 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """A damaged archive."""


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, record_id: str, url: str, payload: bytes, refers_to: str | None = None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record as a gzip member. A revisit holds the HTTP header alone, with the length and digest of the whole payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date), ("WARC-Target-URI", url), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", _sha1(payload)), ("WARC-Block-Digest", _sha1(block))]
    if kind == "revisit":
        head += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    head.append(("Content-Length", str(len(block))))
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"
    return pack.compress(data) + pack.flush()


def read_records(stream: BinaryIO, chunk: int = 1 << 16) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record, one after the other; header names in lower case. Raises WarcError on damage."""
    raw = stream.read(chunk)
    while raw:
        member = zlib.decompressobj(31)
        data, head, length = bytearray(), None, 0
        while not member.eof:
            if not raw:
                raise WarcError("the archive ends within a record")
            try:
                data += member.decompress(raw)
            except zlib.error as e:
                raise WarcError(f"bad gzip member: {e}") from e
            raw = member.unused_data if member.eof else b""
            if head is None and (end := data.find(b"\r\n\r\n")) >= 0:
                first, *lines = bytes(data[:end]).decode("utf-8", "replace").split("\r\n")
                if not first.startswith("WARC/"):
                    raise WarcError("no WARC header")
                head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
                if not head.get("content-length", "").isdigit():
                    raise WarcError("no content length")
                length = int(head["content-length"])
                del data[: end + 4]
            if head is not None and len(data) > length + 4:
                raise WarcError("the record is longer than its content length")
            if not raw and not member.eof:
                raw = stream.read(chunk)
        if head is None or len(data) != length + 4 or data[length:] != b"\r\n\r\n":
            raise WarcError("the record doesn't match its content length")
        block = bytes(data[:length])
        if head.get("warc-block-digest", _sha1(block)) != _sha1(block):
            raise WarcError("block digest differs")
        yield head, block
        if not raw:
            raw = stream.read(chunk)


def split_http(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, payload = block.partition(b"\r\n\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}, payload


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", revisit_from: int = REVISIT_FROM, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per page; returns a pinned manifest (path, records, bytes).

    Of equal payloads of at least revisit_from bytes the page with the largest id is the response and the others revisit
    it (rows that repeat that page are responses too). Null html is an empty payload. Where all ids of equal payloads are
    null, each is a response. A null url becomes the record's id. A lost task writes other files; the manifest names
    those that count.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("id"), F.col(url).cast("string").alias("url"), text_bytes(html).alias("body")).withColumn("digest", F.when(F.length("body") >= revisit_from, F.unhex(F.sha2("body", 256))))
    # Two rounds, as a join's side must not stand on an aggregate for Spark to split hot keys; digests of one page go.
    groups = pinned(rows.filter(F.col("digest").isNotNull()).groupBy("digest").agg(F.count("*").alias("n"), F.max("id").alias("first")).filter("n > 1").select("digest", "first"))
    joined = rows.join(groups, "digest", "left").select("id", "url", "body", F.when(F.col("first") > F.coalesce("id", F.lit(-(1 << 63))), F.col("first")).alias("first"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        task = TaskContext.get()
        at, out, size, n, done = 0, None, 0, 0, []
        path = ""
        for b in batches:
            for i, link, body, first in zip(*(c.to_pylist() for c in b.columns), strict=True):
                name = f"urn:page:{'' if i is None else i}"
                target = name if link is None else re.sub(r"[\x00-\x20\x7f]", lambda m: urllib.parse.quote(m[0]), link)
                data = record("response" if first is None else "revisit", name, target, body, None if first is None else f"urn:page:{first}")
                if out is None:
                    path = f"{base}/{task.partitionId():06d}-{task.taskAttemptId()}-{at}.warc.gz"
                    out, at = fs.open_output_stream(path, compression=None), at + 1
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= archive_bytes:
                    out.close()
                    done.append((path, n, size))
                    out, size, n = None, 0, 0
        if out is not None:
            out.close()
            done.append((path, n, size))
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["path", "records", "bytes"])

    return pinned(joined.mapInArrow(lean(write), "path string, records long, bytes long"))


def read_archives(manifest: DataFrame, folder: str, path: str = "path", with_payload: bool = False) -> DataFrame:
    """A row per record of the archives named: page_id, url, payload_bytes, payload_digest, record_type, refers_to (and payload)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(folder)
        number = lambda v: None if v is None or v in ("<urn:page:>", "") else int(v[10:-1])
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())] + [("payload", pa.binary())] * with_payload)
        for b in batches:
            for p in b.column(0).to_pylist():
                out: list[list] = [[] for _ in schema]
                held = 0
                with fs.open_input_stream(p, compression=None) as stream:
                    for head, block in read_records(stream):
                        http, payload = split_http(block)
                        digest = head["warc-payload-digest"]
                        revisit = head["warc-type"] == "revisit"
                        if not revisit and digest != _sha1(payload):
                            raise WarcError("payload digest differs")
                        row = (number(head["warc-record-id"]), head["warc-target-uri"], int(http["content-length"]) if revisit else len(payload), base64.b32decode(digest[5:]).hex(), head["warc-type"], number(head.get("warc-refers-to")), payload)
                        for c, v in zip(out, row, strict=False):
                            c.append(v)
                        held += len(payload)
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)
                            out, held = [[] for _ in schema], 0
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    n = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return manifest.select(path).repartition(n).mapInArrow(lean(read), "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * with_payload)


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write all pages to archives in the shared folder and read them back."""
    folder = new_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, page_id, url, html), folder)
