"""Snapshots to records: a streaming XML parser in Arrow tasks."""

from __future__ import annotations

import bisect
import itertools
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from urllib.parse import unquote
from xml.parsers import expat

import pyarrow as pa
from pyarrow import parquet
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from waymark.sources import files
from waymark.sources.shared import small_batches

SCHEMA = "feed string, snapshot_name string, ordinal int, source_id string, xml string, published string, error string"
_TYPES = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string()]
_BATCH = 1 << 20  # bytes of records that go on together
_GROUP = 8 << 20  # bytes of a row group that is read again for some of its records
_PART = 1 << 16  # rows of a file that one task reads again
_DECLARED = re.compile(rb"<\?xml[^>]*?encoding\s*=\s*[\"']([A-Za-z0-9._-]+)[\"']")


def decoded(content: bytes | memoryview | str) -> str:
    """Text of a snapshot, by its declared encoding or UTF-8."""
    if isinstance(content, str):
        return content
    m = _DECLARED.match(bytes(content[:200]).lstrip(b"\xef\xbb\xbf"))
    return str(content, m[1].decode() if m else "utf-8-sig")


class _Records(Sequence):
    """(id, xml) of each record, held as places in the snapshot's text."""

    def __init__(self, data: bytes):
        self.data, self.ids = data, []
        self.starts, self.ends = array("q"), array("q")

    def add(self, ident: str | None, start: int, end: int) -> None:
        self.ids.append(ident)
        self.starts.append(start)
        self.ends.append(end)

    def xml(self, k: int) -> bytes:
        return self.data[self.starts[k] : self.ends[k]]

    def first_of_each(self) -> Iterable[int]:
        """Places of the first record of each id."""
        seen: set[str | None] = set()
        return array("q", (k for k, i in enumerate(self.ids) if not (i in seen or seen.add(i))))

    def __len__(self) -> int:
        return len(self.ids)

    def __getitem__(self, k: int) -> tuple[str | None, str]:
        return self.ids[k], self.xml(k).decode()

    def __eq__(self, other: object) -> bool:
        return list(self) == list(other) if isinstance(other, Sequence) else NotImplemented


class _Extractor:
    """Outer XML and id of each record element, and the first publication time outside records."""

    def __init__(self, text: str, record: str, ident: str, match_local: bool):
        self.data = re.sub(r"^\s*<\?xml.*?\?>", "", text, count=1, flags=re.S).encode()
        self.record, self.ident, self.local = record, ident, match_local
        self.records = _Records(self.data)
        self.published: str | None = None
        self.depth, self.record_depth, self.start, self.id, self.id_done, self.text_depth = 0, 0, 0, None, False, 0
        p = self.parser = expat.ParserCreate("utf-8")
        p.buffer_text = True
        p.StartElementHandler, p.EndElementHandler, p.CharacterDataHandler, p.StartDoctypeDeclHandler = self.open, self.close, self.chars, self.doctype

    def doctype(self, *args) -> None:
        raise ValueError("document type declarations are refused")

    def is_(self, name: str, wanted: str) -> bool:
        return name == wanted or (self.local and name.rpartition(":")[2] == wanted)

    def open(self, name: str, attrs: dict[str, str]) -> None:
        self.depth += 1
        if self.record_depth:
            if not self.id_done and self.is_(name, self.ident):
                self.id, self.id_done = attrs.get("id"), True
        elif self.is_(name, self.record):
            self.record_depth, self.start = self.depth, self.parser.CurrentByteIndex
            self.id, self.id_done = (attrs.get("id"), True) if self.record == self.ident else (None, False)
        elif self.published is None and self.is_(name, "publicationTime"):
            self.published, self.text_depth = "", self.depth

    def chars(self, text: str) -> None:
        if self.text_depth:
            self.published += text

    def close(self, name: str) -> None:
        if self.record_depth == self.depth:
            end = self.parser.CurrentByteIndex
            # A self-closing tag has ended here already; its parent, no record, has another name.
            if self.data.startswith(b"</" + name.encode(), end):
                end = self.data.index(b">", end) + 1
            self.records.add(self.id, self.start, end)
            self.record_depth = 0
        if self.text_depth == self.depth:
            self.text_depth = 0
        self.depth -= 1

    def run(self) -> None:
        self.parser.Parse(self.data, True)


def extract(content: bytes | memoryview | str, record: str, ident: str, match_local: bool = False) -> tuple[str | None, Sequence[tuple[str, str]], str | None]:
    """(publication time, [(id, xml)], error) of one snapshot; the records are cut out of its text as they are asked for."""
    try:
        found = _Extractor(decoded(content), record, ident, match_local)
        found.run()
    except (expat.ExpatError, ValueError, LookupError) as e:
        return None, [], f"malformed: {e}"
    if found.published is None:
        return None, [], "no publication time"
    if None in found.records.ids:
        return None, [], "a record has no id"
    return found.published.strip(), found.records, None


def explode_records(snapshots: DataFrame, match_local: bool = False, first_only: bool = False) -> DataFrame:
    """feed, snapshot_name, publication_time, ordinal, source_id, xml, error.

    snapshots: feed, snapshot_name, content, record_element, id_element. One row per record, or with first_only per
    different id; a snapshot that can't be used gives one row with an error, an empty one none. Wide rows: nothing is
    shuffled. A task holds the text of one snapshot at a time, and of its records some at a time.
    """
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for b in batches:
            for feed, name, content, record, ident in zip(*(b.column(c) for c in ("feed", "snapshot_name", "content", "record_element", "id_element")), strict=True):
                feed, name, published, found, error = feed.as_py(), name.as_py(), None, [], "unknown feed or no content"
                if record.is_valid and content.is_valid:
                    text = content.as_py() if isinstance(content, pa.StringScalar | pa.LargeStringScalar) else memoryview(content.as_buffer())
                    published, found, error = extract(text, record.as_py(), ident.as_py(), match_local)
                if error:
                    out.append((feed, name, None, None, None, None, error))
                    continue
                for k in found.first_of_each() if first_only else range(len(found)):
                    out.append((feed, name, k, found.ids[k], found.xml(k), published, None))
                    held += len(out[-1][4])
                    if held > _BATCH:
                        yield batch(out)
                        out, held = [], 0
            if out:  # before the next batch comes
                yield batch(out)
                out, held = [], 0

    small_batches(snapshots.sparkSession)
    rows = snapshots.select("feed", "snapshot_name", "content", "record_element", "id_element").mapInArrow(run, SCHEMA)
    time = F.try_to_timestamp("published")
    bad = F.col("error").isNull() & time.isNull()
    return rows.select("feed", "snapshot_name", time.alias("publication_time"), "ordinal", "source_id", "xml", F.when(bad, "bad publication time").otherwise(F.col("error")).alias("error"))


_PLACE = ["_file", "_row"]


def located(records: DataFrame, folder: str) -> DataFrame:
    """Records written to a folder and read back without xml, but with content_hash, length and where each one lies.

    What is shuffled from here on is as wide for long records as for short ones; ``fetched`` gets the xml of those that stay.
    """
    schema = records.schema
    records.withColumns({"content_hash": F.unhex(F.sha2("xml", 256)), "length": F.octet_length("xml").cast("bigint")}).write.mode("overwrite").option("parquet.block.size", _GROUP).parquet(folder)
    narrow = [f for f in schema.fieldNames() if f != "xml"]
    rows = records.sparkSession.read.parquet(folder)
    return rows.select(*narrow, "content_hash", "length", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def fetched(rows: DataFrame, held_in: int | None = None) -> DataFrame:
    """rows of ``located`` records with their xml in place of content_hash and place.

    They are dealt by file and part of a file, in order of place, and each task reads only the row groups that hold its rows,
    one at a time. held_in says how many files the rows lie in at most, where that is known: few files need no more tasks,
    each of which starts Python.
    """
    columns = [c for c in rows.columns if c not in (*_PLACE, "content_hash")]
    order = [*columns, *_PLACE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = source = group = texts = None
        ends: list[int] = []
        for b in batches:
            found: list[str | None] = []
            for at, row in zip(b.column("_file").to_pylist(), b.column("_row").to_pylist(), strict=True):
                if at != path:
                    fs, name = files.place(unquote(at).replace("s3a://", "s3://", 1))  # Spark gives it encoded as in a URL
                    path, source, group = at, parquet.ParquetFile(name, filesystem=fs), None
                    ends = list(itertools.accumulate(source.metadata.row_group(k).num_rows for k in range(source.num_row_groups)))
                now = bisect.bisect_right(ends, row)
                if now != group:
                    group, texts = now, source.read_row_group(now, columns=["xml"]).column("xml")
                found.append(texts[row - (ends[now] - len(texts))].as_py())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), pa.array(found, pa.string())], names=[*columns, "xml"])

    schema = StructType([*(rows.schema[c] for c in columns), StructField("xml", StringType())])
    # As many partitions as are set: what comes next, such as conversion, costs by the row.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if held_in is not None:
        parts = min(parts, max(2 * held_in, 1))
    return rows.select(*order).repartition(parts, "_file", F.floor(F.col("_row") / _PART)).sortWithinPartitions(*_PLACE).mapInArrow(run, schema)


def dedupe_records(records: DataFrame) -> DataFrame:
    """The first record of each id in a snapshot."""
    w = Window.partitionBy("feed", "snapshot_name", "source_id").orderBy("ordinal")
    return records.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def split_valid(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good records, a row for each rejected snapshot)."""
    return records.filter("error is null").drop("error"), records.filter("error is not null").select("feed", "snapshot_name", "error").distinct()
