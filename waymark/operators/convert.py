"""Records to documents: XML to JSON, typed values, coordinates, geometries."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SITUATIONS = "getsituation"
GEOMETRY_FEEDS = (SITUATIONS, "getpredefinedtraveltimelocations")
RENAMED = {"latitude": "lat", "longitude": "lon"}
DROPPED = ("@xmlns",)
# White space and digits are ASCII, here and in the column form.
_WHITE = " \t\n\x0b\f\r"
_INTEGER = re.compile(rf"[{_WHITE}]*([+-]?)0*([0-9]+)[{_WHITE}]*")
_NUMBER = re.compile(rf"[{_WHITE}]*[+-]?([0-9][0-9,]*\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[{_WHITE}]*")


class ConversionError(ValueError):
    """A record that can't become a document."""


class Element:
    """An element without its namespaces."""

    def __init__(self, name: str, attrs: dict[str, str]):
        self.name, self.attrs = name, attrs
        self.children: list[Element] = []
        self.texts: list[str] = []
        self.closed_text = True


def _local(name: str) -> str:
    return name.rpartition(":")[2]


def parse(xml: str) -> Element:
    """The tree of a record; namespace declarations go and names become local."""
    stack: list[Element] = []
    root: list[Element] = []

    def start(name: str, attrs: dict[str, str]) -> None:
        e = Element(_local(name), {_local(k): v for k, v in attrs.items() if k != "xmlns" and not k.startswith("xmlns:")})
        if stack:
            stack[-1].children.append(e)
            stack[-1].closed_text = True
        else:
            root.append(e)
        stack.append(e)

    def end(name: str) -> None:
        stack.pop()

    def text(data: str) -> None:
        e = stack[-1]
        if e.closed_text:
            e.texts.append(data)
            e.closed_text = False
        else:
            e.texts[-1] += data

    p = expat.ParserCreate("utf-8")
    p.buffer_text = True
    p.StartElementHandler, p.EndElementHandler, p.CharacterDataHandler = start, end, text
    try:
        p.Parse(xml.encode(), True)
    except expat.ExpatError as e:
        raise ConversionError(f"malformed: {e}") from e
    return root[0]


def to_value(e: Element):
    """JSON value of an element: attributes as @name, repeated children as an array, text beside them as #text, nothing as null."""
    texts = [t for t in e.texts if t.strip()]
    if not e.attrs and not e.children:
        return "".join(texts) if texts else None
    out: dict = {f"@{k}": v for k, v in e.attrs.items()}
    names: dict[str, list[Element]] = {}
    for c in e.children:
        names.setdefault(c.name, []).append(c)
    for name, same in names.items():
        out[name] = to_value(same[0]) if len(same) == 1 else [to_value(c) for c in same]
    if texts:
        out["#text"] = texts[0] if len(texts) == 1 else texts
    return out


def split_situation(root: Element) -> list[Element]:
    """The situation records, each with a copy of the situation's header as its first child."""
    for name in ("version", "id"):
        if name not in root.attrs:
            raise ConversionError(f"a situation has no {name}")
    head = Element("situation", {k: root.attrs[k] for k in ("version", "id")})
    for name in ("overallSeverity", "headerInformation"):
        head.children += [c for c in root.children if c.name == name][:1]
    records = [c for c in root.children if c.name == "situationRecord"]
    for r in records:
        r.children.insert(0, head)
    return records


def coordinates(text) -> list[list[float]]:
    if text is None:
        return []
    if not isinstance(text, str):
        raise ConversionError("coordinates are no single text")
    tokens = [t for t in re.split(r"[ ,;\r\n]", text) if t.strip()]
    if any(not _NUMBER.fullmatch(t) for t in tokens):
        raise ConversionError("a coordinate is no number")
    numbers = [float(t) for t in tokens]
    if any(abs(x) == float("inf") for x in numbers):
        raise ConversionError("a coordinate is beyond a double")
    return [numbers[k : k + 2] for k in range(0, len(numbers) - 1, 2)]


def convert_coordinates(value):
    """Properties named coordinates become arrays of pairs, at any depth, within arrays too."""
    if isinstance(value, dict):
        return {k: coordinates(v) if k == "coordinates" else convert_coordinates(v) for k, v in value.items()}
    return [convert_coordinates(v) for v in value] if isinstance(value, list) else value


def typed(value):
    """A text as truth value, 64-bit integer or double, where it reads as one."""
    if not isinstance(value, str):
        return value
    bare = value.strip(_WHITE)
    if bare.isascii() and bare.lower() in ("true", "false"):
        return bare.lower() == "true"
    # Longer ones are out of range, and int() refuses very long ones.
    if (m := _INTEGER.fullmatch(value)) and len(m[2]) <= 19 and -(1 << 63) <= (number := int(m[1] + m[2])) < 1 << 63:
        return number
    if _NUMBER.fullmatch(value):
        number = float(bare.replace(",", ""))
        if abs(number) != float("inf"):
            return number
    return value


def map_tree(value, rename: Callable[[str], str], remove: Callable[[str], bool], change: Callable):
    """Each property renamed, removed or its value changed, then the same below it. Scalars right in arrays stay."""
    if isinstance(value, dict):
        return {rename(k): map_tree(change(v), rename, remove, change) for k, v in value.items() if not remove(k)}
    return [map_tree(v, rename, remove, change) if isinstance(v, (dict, list)) else v for v in value] if isinstance(value, list) else value


def normalized(value, doc_id: str, published: str | None):
    body = value if isinstance(value, dict) else {} if value is None else {"#text": value}
    whole = {"id": doc_id, "publicationTime": published} | {k: v for k, v in body.items() if k not in ("id", "publicationTime")}
    return map_tree(convert_coordinates(whole), lambda k: RENAMED.get(k, k), lambda k: k in DROPPED, typed)


def cut_geometry(value):
    """The first property named linearExtension, in order of the tree and not within arrays; null takes its place."""
    if isinstance(value, dict):
        for k, v in value.items():
            if k == "linearExtension":
                value[k] = None
                return v
            if isinstance(v, dict) and (found := cut_geometry(v)) is not None:
                return found
    return None


def _dumped(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"), allow_nan=False)


def _or_null(f: Callable[[str], str]) -> Callable:
    """f of a text; null for null and for what can't be converted: ill-formed, no JSON value, or nested too deep."""

    def one(t):
        try:
            return None if t is None else f(t)
        except (ValueError, RecursionError):
            return None

    return one


def _per_text(f: Callable) -> Callable[[Column], Column]:
    """A column function over JSON text; null stays null, and what can't be converted becomes null."""

    def column(text: Column) -> Column:
        return F.pandas_udf(lambda s: s.map(_or_null(lambda t: _dumped(f(json.loads(t))))), "string")(text)

    return column


def xml_to_json(xml: Column) -> Column:
    """JSON text of a record's XML, namespaces stripped; null where it is malformed or nested too deep."""
    return F.pandas_udf(lambda s: s.map(_or_null(lambda x: _dumped(to_value(parse(x))))), "string")(xml)


convert_coordinates_json = _per_text(convert_coordinates)
rename_keys = _per_text(lambda v: map_tree(v, lambda k: RENAMED.get(k, k), lambda k: False, lambda x: x))
drop_keys = _per_text(lambda v: map_tree(v, lambda k: k, lambda k: k in DROPPED, lambda x: x))
infer_scalars = _per_text(lambda v: map_tree(v, lambda k: k, lambda k: False, typed))


def map_document(text: Column, rename: Callable[[str], str], remove: Callable[[str], bool], change_type: Callable) -> Column:
    """A user's three functions over the tree of a JSON text."""
    return _per_text(lambda v: map_tree(v, rename, remove, change_type))(text)


def flatten_properties(docs: DataFrame, doc_id: str = "doc_id", text: str = "json") -> DataFrame:
    """doc_id, position, path, name, kind, value of each property in order of the tree, containers included, arrays not searched.

    Null documents, and those that aren't JSON or are nested too deep for its parser, give no rows.
    """

    def kind(v) -> str:
        return {dict: "object", list: "array", str: "string", bool: "bool", int: "int", float: "double"}.get(type(v), "null")

    def walk(whole) -> Iterator[tuple[str, str, str, str]]:
        todo = [("", iter(whole.items() if isinstance(whole, dict) else ()))]
        while todo:
            path, rest = todo[-1]
            if (item := next(rest, None)) is None:
                todo.pop()
                continue
            k, x = item
            here = f"{path}.{k}" if path else k
            yield here, k, kind(x), _dumped(x)
            if isinstance(x, dict):
                todo.append((here, iter(x.items())))

    def properties(t: str) -> list[tuple[str, str, str, str]]:
        try:
            return list(walk(json.loads(t)))
        except (ValueError, RecursionError):
            return []

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = [(i, n, *row) for i, t in zip(f["d"], f["t"], strict=True) if t is not None for n, row in enumerate(properties(t))]
            yield pd.DataFrame(out, columns=["doc_id", "position", "path", "name", "kind", "value"])

    return docs.select(F.col(doc_id).cast("string").alias("d"), F.col(text).alias("t")).mapInPandas(run, "doc_id string, position int, path string, name string, kind string, value string")


def split_situations(events: DataFrame) -> DataFrame:
    """feed, source_id, index, json: one row per situation record with its header, one row per record of other feeds."""
    return _converted(events, "UTC", raw=True).filter("error is null").select("feed", "source_id", F.col("record_index").alias("index"), "json")


def _converted(events: DataFrame, tz: str, raw: bool = False) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for feed, source, key, stamp, published, time, xml in f.itertuples(index=False):
                before = len(out)
                try:
                    root = parse(xml or "")
                    situation = feed == SITUATIONS
                    for k, r in enumerate(split_situation(root) if situation else [root]):
                        doc_id = f"{source}_{k + 1}_{stamp}" if situation else f"{source}_{stamp}"
                        doc, shape = to_value(r), None
                        if not raw:
                            doc = normalized(doc, doc_id, published)
                            shape = cut_geometry(doc) if feed in GEOMETRY_FEEDS else None
                        out.append((feed, doc_id, source, k, time, key, _dumped(doc), None if shape is None else _dumped(shape), None))
                except (ValueError, RecursionError) as e:
                    # One record is rejected, with all its documents, and the others go on.
                    del out[before:]
                    out.append((feed, None, source, None, time, key, None, None, str(e) or type(e).__name__))
            yield pd.DataFrame(out, columns=["feed", "doc_id", "source_id", "record_index", "event_time", "row_key", "json", "geometry", "error"]).astype({"record_index": "Int32"})

    t = F.col("publication_time")
    stamp = F.date_format(F.from_utc_timestamp(t, tz), "yyyy-MM-dd'T'HH:mm:ss")
    key = F.col("row_key") if "row_key" in events.columns else F.lit(None).cast("string")
    rows = events.select(F.lower("feed").alias("feed"), "source_id", key.alias("row_key"), stamp.alias("stamp"), F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("published"), t.alias("event_time"), "xml")
    return rows.mapInPandas(run, "feed string, doc_id string, source_id string, record_index int, event_time timestamp, row_key string, json string, geometry string, error string")


def convert_events(events: DataFrame, tz: str = "UTC") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, geometries, rejects) of events(feed, source_id, publication_time, xml); nothing is shuffled.

    Each of the three converts anew; write ``converted`` once where all are needed.
    """
    return parts(converted(events, tz))


def converted(events: DataFrame, tz: str = "UTC") -> DataFrame:
    """One row per document with its geometry, or per event that can't be converted with its error."""
    return _converted(events, tz)


def parts(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs = rows.filter("error is null").select("feed", "doc_id", "source_id", "record_index", "event_time", F.col("event_time").alias("publication_time"), "row_key", "json")
    shapes = rows.filter("geometry is not null").select("feed", "doc_id", "source_id", "event_time", "geometry")
    return docs, shapes, rows.filter("error is not null").select("feed", "source_id", "event_time", "error")


def attach_geometry(docs: DataFrame, geometries: DataFrame) -> DataFrame:
    """Documents with the geometry of their id; feeds without geometries get null."""
    return docs.join(geometries.select("feed", "doc_id", "geometry"), ["feed", "doc_id"], "left")
