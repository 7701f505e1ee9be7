"""Records of snapshots of any size: each file is cut into ranges that are read by tasks of their own.

Ranges begin at a ``<``. In well-formed XML one of these is either markup or within a comment, a character data section or
a processing instruction, and no closing mark of those holds one. So a range can be read from four states, and what it does
to each, with how far it opens or closes record elements, is a small row. Composing those rows gives the true state and depth
at each range's start. Then each range gives the records that begin in it, reading on to the end of the last one, and what
lies outside of records; that outside, a fraction of the file, is parsed whole for the publication time and well-formedness.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterable, Iterator
from xml.parsers import expat

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.sources import files as fs_
from waymark.sources.records import _DECLARED, _Extractor, extract
from waymark.sources.shared import scratch, stored

RANGE = 64 << 20
_CHUNK = 1 << 20
_NEAR = 1 << 12  # bytes that are first looked through for a ``<``
_VOID = b"<_/>"
_TEXT, _COMMENT, _CDATA, _PI = range(4)
_CLOSERS = {_COMMENT: b"-->", _CDATA: b"]]>", _PI: b"?>"}
_MARKUP = re.compile(rb"<(?:(!--)|(!\[CDATA\[)|(\?)|(!)|(/?)([^\s/>!?\"'<]+)([^\"'<>]*(?:\"[^\"<]*\"[^\"'<>]*|'[^'<]*'[^\"'<>]*)*)>)")
_FAILED = -1


class _Malformed(ValueError):
    pass


class _Tags:
    """Tags of consecutive pieces of a file that each end before a ``<`` or with it; state is where a piece ended."""

    def __init__(self, state: int):
        self.state = state

    def of(self, data: bytes) -> Iterator[tuple[int, int, bytes, int]]:
        """(begin, end, name, step) of each tag: step is 1 for an opening one, -1 for a closing one, 0 for one that does both."""
        at = 0
        while True:
            if self.state:
                closer = _CLOSERS[self.state]
                end = data.find(closer, at)
                if end < 0:
                    return
                at, self.state = end + len(closer), _TEXT
            at = data.find(b"<", at)
            if at < 0:
                return
            m = _MARKUP.match(data, at)
            if m is None or m[4]:
                raise _Malformed("malformed: a tag is cut or a document type declared")
            self.state = _COMMENT if m[1] else _CDATA if m[2] else _PI if m[3] else _TEXT
            if not self.state:
                yield at, m.end(), m[6], -1 if m[5] else 0 if m[7].endswith(b"/") else 1
            at = m.end()


class _File:
    """Bytes of a file from any place, up to the next ``<`` behind one."""

    def __init__(self, path: str):
        fs, name = fs_.place(path.replace("s3a://", "s3://", 1))
        self.f: pafs.NativeFile = fs.open_input_file(name)
        self.size = self.f.size()

    def tag_from(self, at: int) -> int:
        """Where the first ``<`` at or behind a place is, or the end of the file."""
        step = min(_NEAR, _CHUNK)
        while at < self.size:
            found = self.f.read_at(min(step, self.size - at), at).find(b"<")
            if found >= 0:
                return at + found
            at, step = at + step, min(2 * step, _CHUNK)
        return self.size

    def bytes(self, begin: int, end: int) -> bytes:
        return self.f.read_at(end - begin, begin)

    def encoding(self) -> str:
        m = _DECLARED.match(self.bytes(0, min(200, self.size)).lstrip(b"\xef\xbb\xbf"))
        name = m[1].decode() if m else "utf-8"
        if "<".encode(name) != b"<":
            raise _Malformed(f"malformed: a file in {name} can't be cut")
        return name


def _opened(paths: Iterable[str]) -> Iterator[_File]:
    """The file of each path; one that comes again and again is opened once."""
    for path, same in itertools.groupby(paths):
        file = _File(path)
        for _ in same:
            yield file


def _bounds(file: _File, at: int, size: int) -> tuple[int, int]:
    """The range of a file whose nominal start is at: it begins with the file or with a ``<``."""
    return (0 if at == 0 else file.tag_from(at)), file.tag_from(at + size)


def _is(record: str, match_local: bool) -> Callable[[bytes], bool]:
    wanted = record.encode()
    return (lambda name: name == wanted or name.rpartition(b":")[2] == wanted) if match_local else (lambda name: name == wanted)


def _effects(size: int, match_local: bool):
    """For each range and each of four states before it: the state behind it, and how many record elements it leaves open."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for path, at, record, file in zip(f["path"], f["at"], f["record_element"], _opened(f["path"]), strict=True):
                ours = _is(record, match_local)
                data = file.bytes(*_bounds(file, at, size))
                for state in (_TEXT, *_CLOSERS):
                    tags, depth = _Tags(state), 0
                    try:
                        for _, _, name, step in tags.of(data):
                            depth += step if ours(name) else 0
                        out.append((path, at, state, tags.state, depth))
                    except _Malformed:
                        out.append((path, at, state, _FAILED, 0))
            yield pd.DataFrame(out, columns=["path", "at", "state", "after", "opened"])

    return run


def _composed(f: pd.DataFrame) -> pd.DataFrame:
    """State and depth at the start of each range of one file; a row for four states of each range is all that is held."""
    effect = {(r.at, r.state): (r.after, r.opened) for r in f.itertuples()}
    state, depth, out = _TEXT, 0, []
    for at in sorted({a for a, _ in effect}):
        out.append((f["path"].iloc[0], at, state, depth))
        if state != _FAILED:
            state, more = effect[at, state]
            depth += more
    return pd.DataFrame(out, columns=["path", "at", "state", "depth"])


_PIECES = "path string, at bigint, k int, source_id string, xml string, outside binary, error string"


def _parts(size: int, match_local: bool):
    """Records that begin in each range, and one row with what it has outside of records; a void element stands for each.

    Two such elements stand for more on end: neither time nor well-formedness tells how many there are.
    """

    def one(file: _File, path: str, at: int, record: str, ident: str, state: int, depth: int) -> Iterator[tuple]:
        outside, ours = [], _is(record, match_local)
        around = "b" if record.startswith("a") else "a"  # no start of a record's name
        try:
            if state == _FAILED:
                raise _Malformed("malformed: a tag is cut or a document type declared")
            code = file.encoding()
            begin, end = _bounds(file, at, size)
            data, tags, clear, start, k = file.bytes(begin, end), _Tags(state), 0, None, 0
            held: list[bytes] = []  # of a record that goes on behind the range
            ended: list[bytes] = []  # records that are parsed together
            waiting, more = 0, min(_NEAR, _CHUNK)

            def parsed() -> Iterator[tuple]:
                found = _Extractor(f"<{around}>{''.join(x.decode(code) for x in ended)}</{around}>", record, ident, match_local)
                found.run()
                for n, (i, x) in enumerate(found.records, k - len(ended)):
                    yield path, at, n, i, x, None, None

            while True:
                for left, right, name, step in tags.of(data):
                    if not ours(name):
                        continue
                    if depth == 0 and step >= 0:
                        if left > clear or outside[-2:] != [_VOID, _VOID]:
                            outside += [data[clear:left], _VOID] if left > clear else [_VOID]
                        start = left
                    depth += step
                    if depth < 0:
                        raise _Malformed("malformed: a record ends that didn't begin")
                    if depth == 0:
                        if start is not None:
                            ended.append(b"".join([*held, data[start:right]]))
                            k, waiting = k + 1, waiting + len(ended[-1])
                            if waiting > _CHUNK:
                                yield from parsed()
                                ended, waiting = [], 0
                        clear, start, last = right, None, bool(held)
                        held = []
                        if last:
                            break
                else:
                    if start is not None and end < file.size:
                        held.append(data[start:])
                        begin, end, more = end, file.tag_from(end + more), min(2 * more, _CHUNK)
                        data, start = file.bytes(begin, end), 0
                        continue
                    if start is not None:
                        raise _Malformed("malformed: a record doesn't end")
                    if depth == 0:
                        outside.append(data[clear:])
                break
            yield from parsed()
        except (expat.ExpatError, ValueError, LookupError) as e:
            yield path, at, None, None, None, None, str(e) if str(e).startswith("malformed") else f"malformed: {e}"
            return
        yield path, at, None, None, None, b"".join(outside), None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in _PIECES.split(", ")]
        for f in frames:
            out, held = [], 0
            for r, file in zip(f.itertuples(index=False), _opened(f["path"]), strict=True):
                for row in one(file, r.path, r.at, r.record_element, r.id_element, r.state, r.depth):
                    out.append(row)
                    held += len(row[4] or "") + len(row[5] or b"")
                    if held > _CHUNK:
                        yield pd.DataFrame(out, columns=columns).astype({"k": "Int32"})
                        out, held = [], 0
            yield pd.DataFrame(out, columns=columns).astype({"k": "Int32"})

    return run


def _outsides(f: pd.DataFrame) -> pd.DataFrame:
    """Publication time and error of one file, from what it has outside of records."""
    errors = f["error"].dropna()
    published, error = None, errors.iloc[0] if len(errors) else None
    if error is None:
        published, _, error = extract(b"".join(f.sort_values("at")["outside"]), "\0", "\0")
    return pd.DataFrame([(f["path"].iloc[0], published, error)], columns=["path", "published", "error"])


def explode_ranges(files: DataFrame, match_local: bool = False, range_bytes: int = RANGE) -> DataFrame:
    """What ``explode_records`` gives, of files that need not fit a task: files has path and length instead of content.

    A file that can't be used gives one row with an error, also where its publication time is at fault.

    feed, snapshot_name, path, length, record_element, id_element. Files in encodings where ``<`` isn't one byte are errors.
    No task holds more of a file than a range, a record, and the file's part outside of records.
    """
    spark = files.sparkSession
    # As many partitions as are set: a range's row is small, but what is read for it isn't.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = lambda df: df.repartition(parts, "path", "at").sortWithinPartitions("path", "at")
    known = files.filter("record_element is not null")
    cut = known.select("path", "record_element", "id_element", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes).cast("bigint"))).alias("at"))
    cut = stored(cut, scratch(spark))
    effects = dealt(cut.select("path", "at", "record_element")).mapInPandas(_effects(range_bytes, match_local), "path string, at bigint, state int, after int, opened int")
    starts = effects.groupBy("path").applyInPandas(_composed, "path string, at bigint, state int, depth int")
    pieces = stored(dealt(cut.join(starts, ["path", "at"]).select("path", "at", "record_element", "id_element", "state", "depth")).mapInPandas(_parts(range_bytes, match_local), _PIECES), scratch(spark))
    whole = pieces.filter("k is null").groupBy("path").applyInPandas(_outsides, "path string, published string, error string")
    found = pieces.filter("k is not null")
    before = Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    places = found.groupBy("path", "at").agg(F.count("*").alias("n"), F.max(F.col("source_id").isNull()).alias("nameless")).withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("int"))
    nameless = places.groupBy("path").agg(F.max("nameless").alias("nameless"))
    time = F.try_to_timestamp("published")
    error = F.coalesce("error", F.when(F.col("nameless"), "a record has no id"), F.when(time.isNull() & F.col("nameless").isNotNull(), "bad publication time"))
    state = stored(whole.join(nameless, "path", "left").select("path", time.alias("publication_time"), error.alias("error")), scratch(spark))
    named = files.select("feed", "snapshot_name", "path")
    # What each range's records need is joined by range, so that their text is shuffled once, and by more than its file.
    sound = places.select("path", "at", "first").join(state.filter("error is null").drop("error"), "path").join(named, "path")
    good = found.join(sound, ["path", "at"])
    columns = ["feed", "snapshot_name", "publication_time", "ordinal", "source_id", "xml", "error"]
    rows = good.select("feed", "snapshot_name", "publication_time", (F.col("first") + F.col("k")).alias("ordinal"), "source_id", "xml", F.lit(None).cast("string").alias("error"))
    failed = state.filter("error is not null").join(named, "path").select("feed", "snapshot_name", "error")
    unknown = files.filter("record_element is null").select("feed", "snapshot_name", F.lit("unknown feed or no content").alias("error"))
    return rows.select(*columns).unionByName(failed.unionByName(unknown), allowMissingColumns=True).select(*columns)
