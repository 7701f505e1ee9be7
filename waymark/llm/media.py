"""Media columns: content-addressed payloads in tar shards.

A payload becomes an 8-bit grey PNG image of a fixed width, named by its own SHA-256 in a tar shard. Rows carry digest,
shard, offset and length. Metadata columns come from range reads of the image header alone; features from the whole image.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import file_system, keyed, lean, new_folder, pinned, written

WIDTH = 192
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
HEADER_BYTES = 33


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def padded(body: bytes, width: int = WIDTH) -> bytes:
    return body + b" " * (-len(body) % width if body else width)


def to_png(payload: bytes, width: int = WIDTH) -> bytes:
    """Samples, row by row, as a grey image; the payload is a positive multiple of the width."""
    rows = np.frombuffer(payload, "u1").reshape(-1, width)
    lines = np.zeros((len(rows), width + 1), "u1")  # filter type 0 before each row
    lines[:, 1:] = rows
    return _SIGNATURE + _chunk(b"IHDR", struct.pack(">IIBBBBB", width, len(rows), 8, 0, 0, 0, 0)) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + _chunk(b"IEND", b"")


def png_header(data: bytes) -> tuple[int, int, int, int]:
    """(width, height, bit depth, colour type) from the first bytes of an image."""
    if data[:8] != _SIGNATURE or data[12:16] != b"IHDR":
        raise ValueError("not a PNG image")
    return struct.unpack(">IIBB", data[16:26])


def from_png(data: bytes) -> bytes:
    width, height, depth, colour = png_header(data)
    if (depth, colour) != (8, 0):
        raise ValueError("only 8-bit grey images are read")
    at, packed = 8, []
    while at < len(data):
        (size,) = struct.unpack(">I", data[at : at + 4])
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + size]
        if struct.unpack(">I", data[at + 8 + size : at + 12 + size])[0] != zlib.crc32(kind + body):
            raise ValueError("bad chunk checksum")
        if kind == b"IDAT":
            packed.append(body)
        at += 12 + size
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), "u1").reshape(height, width + 1)
    if lines[:, 0].any():
        raise ValueError("only filter type 0 is read")
    return lines[:, 1:].tobytes()


def features(payload: bytes, width: int, height: int) -> str:
    """Size, mean, spread, number of different samples and mean step between neighbours, all in exact integers of a thousandth."""
    x = np.frombuffer(payload, "u1").astype("i8")
    n, total = len(x), int(x.sum())
    mean = total * 1000 // n
    spread = int((x * x).sum()) * 1000 // n - total * total * 1000 // (n * n)
    step = int(np.abs(np.diff(x)).sum()) * 1000 // max(1, n - 1)
    return f"grey8 {width}x{height} mean={mean} var={spread} distinct={len(np.unique(x))} step={step}"


def store(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, shard_bytes: int = 256 << 20) -> tuple[DataFrame, DataFrame]:
    """Write payloads to tar shards. Returns (rows: doc_id, n_bytes, digest; index: digest, shard, offset, length), pinned.

    A task writes each digest once per shard; where tasks share one, the index names the first copy. Null text is empty.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        task = TaskContext.get()
        out, at, number, seen, path = None, 0, 0, set(), ""
        schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("digest", pa.string()), ("shard", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
        for b in batches:
            rows = []
            for i, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
                image = to_png(padded(body, width), width)
                digest = hashlib.sha256(image).hexdigest()
                place: tuple = (None, None, None)
                if digest not in seen:
                    if out is None:
                        path, at, number = f"{base}/{task.partitionId():06d}-{task.taskAttemptId()}-{number}.tar", 0, number + 1
                        out = fs.open_output_stream(path, compression=None)
                    info = tarfile.TarInfo(f"{digest}.png")
                    info.size = len(image)
                    head = info.tobuf(tarfile.USTAR_FORMAT)
                    out.write(head + image + b"\0" * (-len(image) % 512))
                    place = path.rpartition("/")[2], at + len(head), len(image)
                    at += len(head) + len(image) + -len(image) % 512
                    seen.add(digest)
                rows.append((i, len(body), digest, *place))
                if at >= shard_bytes:
                    out.write(b"\0" * 1024)
                    out.close()
                    out, at = None, 0
                    seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)
        if out is not None:
            out.write(b"\0" * 1024)
            out.close()

    both = written(keyed(docs, doc_id, text).select("id", "body").mapInArrow(lean(write), "doc_id long, n_bytes long, digest string, shard string, offset long, length long"))
    index = pinned(both.filter(F.col("shard").isNotNull()).groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("p")).select("digest", "p.*"))
    return both.select("doc_id", "n_bytes", "digest"), index


def _read(index: DataFrame, folder: str, schema: str, names: list[str], row) -> DataFrame:
    """row(image file, offset, length) for each entry, a shard's entries in order of offset."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        path, file = None, None
        for b in batches:
            out: list[list] = [[] for _ in names]
            for digest, shard, offset, length in zip(*(b.column(n).to_pylist() for n in ("digest", "shard", "offset", "length")), strict=True):
                if shard != path:
                    path, file = shard, fs.open_input_file(f"{base}/{shard}")
                for c, v in zip(out, (digest, *row(file, offset, length)), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_pydict(dict(zip(names, out, strict=True)))

    n = max(1, int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return index.repartitionByRange(4 * n, "shard", "offset").sortWithinPartitions("shard", "offset").mapInArrow(lean(read), schema)


def metadata(index: DataFrame, folder: str) -> DataFrame:
    """digest, width, height, bit_depth, colour from header-only range reads."""

    def row(file, offset, length):
        file.seek(offset)
        return png_header(file.read(HEADER_BYTES))

    return _read(index, folder, "digest string, width long, height long, bit_depth long, colour long", ["digest", "width", "height", "bit_depth", "colour"], row)


def contents(index: DataFrame, folder: str) -> DataFrame:
    """digest, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature and the metadata of the stored images."""

    def row(file, offset, length):
        file.seek(offset)
        head = file.read(HEADER_BYTES)
        image = head + file.read(length - len(head))
        header = png_header(head)
        payload = from_png(image)
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(image), hashlib.sha256(image).hexdigest(), features(payload, *header[:2]), *header

    names = ["digest", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height", "bit_depth", "colour"]
    return _read(index, folder, "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, width long, height long, bit_depth long, colour long", names, row)


def media_columns(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs with its image's digest, shard (a path in the shared folder), offset, length and the columns of ``contents``.

    Rows of equal texts share one stored image. Only narrow columns are joined. The header is the start of the one read of an image.
    """
    folder = new_folder(docs.sparkSession, "media")
    rows, index = store(docs, folder, doc_id, text)
    read = written(contents(index, folder))
    place = index.select("digest", F.concat(F.lit(f"{folder}/"), "shard").alias("shard"), "offset", "length")
    return rows.join(place.join(read, "digest"), "digest")
